"""Helpers the operators share: batches of rows in Python tasks, running sums without a hot task, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.sources import Store

#: What stands between the words of a text, as the contracts define them.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = b" \t\n\x0b\x0c\r"
#: The text as UTF-8 bytes, a null text as an empty one.
TEXT_BYTES = "coalesce(cast(text AS binary), X'')"

Columns = dict[str, list]


def session_of(df: DataFrame) -> SparkSession:
    """The session, told where Python workers find this package when it is not installed."""
    spark = df.sparkSession
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def store_of(df: DataFrame, name: str) -> Store:
    return Store(session_of(df), name)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def lower_bytes(text: bytes) -> bytes:
    """A-Z lower-cased. `bytes.lower` touches nothing else, so UTF-8 stays whole."""
    return text.lower()


def map_columns(df: DataFrame, schema: str, make: Callable[[], Callable[[Columns], Columns]],
                rows: int | None = None) -> DataFrame:
    """`mapInArrow` over columns as Python lists. `make` runs once per task and may set up caches there. With `rows`, a
    batch is turned into lists in slices of so many rows, which bounds the copies held of wide rows."""
    session_of(df)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for first in range(0, batch.num_rows, rows or max(batch.num_rows, 1)):
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_pydict(work(part.to_pydict()), schema=arrow)

    return df.mapInArrow(run, schema)


class Memo(dict):
    """A dictionary that computes what it lacks and forgets everything when full; long keys are not kept."""

    def __init__(self, compute: Callable, limit: int = 100_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def running(df: DataFrame, store: Store, group: list[str], order: list[str], column: str | list[str],
            name: str | list[str]) -> DataFrame:
    """Adds `name`: the sum of `column` over the rows before this one, by `order` within `group`. Lists of columns and
    names give several sums in one pass.

    The rows are ranged by (group, order), so a group that holds most rows is spread over many tasks. Sums per range
    give the offsets: as many rows as ranges, and one more for each border between groups.
    """
    columns, names = ([x] if isinstance(x, str) else x for x in (column, name))
    ranged = df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id())
    kept = store.keep(ranged, f"ranged_{names[0]}")
    keys = [*group, "_range"]
    sums = kept.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for c, n in zip(columns, names)])
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_offset_{n}")
                                   for n in names])
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (kept.join(offsets, keys)
            .withColumns({n: F.col(f"_offset_{n}") + F.coalesce(F.sum(c).over(inner), F.lit(0))
                          for c, n in zip(columns, names)})
            .drop("_range", *[f"_offset_{n}" for n in names]))


def components(links: DataFrame, store: Store, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node that each linked node reaches. `links` has the columns a and b.

    Alternates two steps until nothing changes. Large star: every node ties its larger neighbours to the smallest node
    it sees. Small star: every node ties its smaller neighbours to the smallest of them. Each is one aggregate and one
    join over the links, whose number never grows; a node with very many links is only ever aggregated or joined.
    Rounds grow with the logarithm of the longest path. Every round is a table in the shared folder.
    """
    edges = store.keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        f"{name}_0")
    for k in range(1, most_rounds + 1):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = (tied.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u != v").distinct())
        kept = store.keep(small, f"{name}_{k}")
        many = kept.groupBy("u").count().where("count > 1").limit(1).count()
        hubs = kept.select("v").distinct().join(kept.select("u").distinct(), F.col("v") == F.col("u")).limit(1).count()
        edges = kept
        if not many and not hubs:
            break
    else:
        raise RuntimeError("components did not settle")
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
