"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schema import BRONZE

MALFORMED = "_malformed"


def csv_schema(schema: T.StructType) -> T.StructType:
    """Integers read as doubles: exports write a nullable integer as `100123.0`, which an integer schema nulls."""
    return T.StructType([
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
        for f in schema
    ])


def from_csv_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring the columns read with `csv_schema` to their declared types; NaN becomes NULL."""
    columns = []
    for field in schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.LongType):
            column = _key_number(column)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.try_cast("int")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.when(~F.isnan(column), column)
        columns.append(column.alias(field.name))
    return df.select(*columns, *[c for c in df.columns if c not in schema.fieldNames()])


def text_keys(schema: T.StructType) -> T.StructType:
    """64-bit keys are read as text, since a double holds only 53 bits of them."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.LongType) else f.dataType)
        for f in csv_schema(schema)
    ])


def header_of(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names of the first file, without a leading BOM."""
    first = spark.read.options(header=True, encoding="UTF-8", multiLine=multi_line).csv(path)
    return [c.removeprefix("\ufeff").strip() for c in first.columns]


def _key_number(text: Column) -> Column:
    """A 64-bit number written as text, also as `100123.0`; NULL if it is no number."""
    return F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("bigint")


def read_csv_rows(spark: SparkSession, path: str | list[str], schema: T.StructType = BRONZE, multi_line: bool = False,
                  more: Sequence[Column] = ()) -> DataFrame:
    """Columns found by the names in the header, whatever their order; MALFORMED holds a row that does not parse.

    That is a row with too few or too many fields, with a number that does not parse, or with a key that is no number
    (the record is then written anew from its fields). `more` adds columns of the file, such as `_metadata.file_path`.
    A file whose header differs from the first file's fails the read.
    """
    found = header_of(spark, path, multi_line)
    if missing := [f.name for f in schema if f.name not in found]:
        raise ValueError(f"columns missing from the export: {missing}")
    declared = {f.name: f for f in text_keys(schema)}
    fields = [declared.get(c, T.StructField(c, T.StringType())) for c in found]
    raw = spark.read.schema(T.StructType([*fields, T.StructField(MALFORMED, T.StringType())])).options(
        header=True, encoding="UTF-8", multiLine=multi_line, enforceSchema=False,
        columnNameOfCorruptRecord=MALFORMED).csv(path)
    keys = [F.col(f.name) for f in schema if isinstance(f.dataType, T.LongType)]
    bad = [(F.length(F.trim(k)) > 0) & _key_number(k).isNull() for k in keys]
    unreadable = F.coalesce(F.greatest(*bad, F.lit(False), F.lit(False)), F.lit(False))
    record = F.coalesce(F.col(MALFORMED), F.when(unreadable, F.to_csv(F.struct(*[f.name for f in fields]))))
    # a value is only parsed where its column is read: this reads all, whatever is selected later
    return (raw.where(F.size(F.array(*[F.col(f.name).isNull() for f in fields])) > 0)
            .select(*[f.name for f in fields], record.alias(MALFORMED), *more))


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE, multi_line: bool = False) -> DataFrame:
    """CSV export with a header (a leading BOM is accepted), under a declared schema, columns found by name.

    Rows with too few or too many fields, or with a number or key that does not parse, are left to `read_malformed`.
    `multi_line` accepts line breaks inside quoted values, at the price of one task per file.
    """
    raw = read_csv_rows(spark, path, schema, multi_line).where(F.col(MALFORMED).isNull())
    return from_csv_types(raw.select(*schema.fieldNames()), schema)


def read_malformed(spark: SparkSession, path: str, schema: T.StructType = BRONZE, multi_line: bool = False) -> DataFrame:
    """(record): the text of the rows that `read_bronze` leaves out. Together they are all rows of the export."""
    raw = read_csv_rows(spark, path, schema, multi_line)
    return raw.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("record"))


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_silver(df: DataFrame, path: str, partition: str = "area", fmt: str = "parquet") -> None:
    """One directory per area. REBALANCE evens out file sizes: a large area is split over many tasks."""
    df.hint("rebalance", partition).write.mode("overwrite").format(fmt).partitionBy(partition).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sort: Sequence[str] = ()) -> None:
    """Overwrite a table; `sort` ranges the rows over files and orders them inside each, for min/max skipping."""
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    ranged.write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Spaces at the ends of values are data and are kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, encoding="UTF-8", **keep).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; a NULL is written as such, so that every line has every field."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_metadata(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
