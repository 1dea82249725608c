"""Export of gold tables for a dashboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.sources.files import write_json

DOCUMENT_ROWS = 100_000


def table_sizes(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per table, from one job."""
    names = reduce(DataFrame.unionAll, [df.select(F.lit(n).alias("name")) for n, df in tables.items()])
    counted = {r["name"]: r["rows"] for r in names.groupBy("name").agg(F.count(F.lit(1)).alias("rows")).collect()}
    return {n: counted.get(n, 0) for n in tables}


def as_section(name: str, df: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """(section, rows, document): one table as a JSON array, by `order` and then its columns' values."""
    keys = [c.alias(f"key{i}") for i, c in enumerate(order)]
    ranked = F.sort_array(F.collect_list(F.struct(*keys, F.struct(*df.columns).alias("row"))))
    rows = F.to_json(F.transform(ranked, lambda r: r["row"]), {"ignoreNullFields": "false"})
    return df.agg(F.lit(name).alias("section"), F.count(F.lit(1)).alias("rows"), rows.alias("document"))


def export_document(tables: Mapping[str, DataFrame], most: int = DOCUMENT_ROWS,
                    order: Mapping[str, Sequence[Column]] | None = None) -> DataFrame:
    """(section, rows, document) for each table, its rows by the columns that `order` names for it. A document is built in one task, so the sizes are checked first: a
    larger table is refused here, and belongs in `export_tables`."""
    large = {n: rows for n, rows in table_sizes(tables).items() if rows > most}
    if large:
        raise ValueError(f"too large for one document, use export_tables: {large}")
    return reduce(DataFrame.unionAll, [as_section(n, df, (order or {}).get(n, ())) for n, df in tables.items()])


def export_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each table as JSON lines in a folder of its own, whatever its size."""
    for name, df in tables.items():
        write_json(df, f"{path}/{name}")


def full_document(sections: DataFrame) -> DataFrame:
    """All sections as one JSON object in column `document`."""
    entries = F.sort_array(F.collect_list(F.concat(F.to_json(F.array("section")).substr(F.lit(2), F.length(
        F.to_json(F.array("section"))) - 2), F.lit(":"), F.col("document"))))
    return sections.agg(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")).alias("document"))
