"""Tables placed by the hash of a key: joins and groupings on that key, across tables with as many buckets, move no rows.

A table is a folder with one data folder per load and a list of loads. A load writes its data first and its entry last,
so readers see the table before or after it, and a load that failed or is repeated changes nothing. One load at a time
is assumed; folders of earlier loads stay until they are removed.

Rows without the key share a bucket, and so do all rows of one key: this is for keys with few rows each, such as
versions per person. A key that holds a large share of the rows belongs in `write_table`.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

LOADS = "seq bigint, folder string, key string, buckets int, sort array<string>, columns string"


def _last_load(spark: SparkSession, path: str) -> Row | None:
    try:
        loads = spark.read.schema(LOADS).parquet(f"{path}/loads")
        return loads.agg(F.max(F.struct("*")).alias("last")).first()["last"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _name(folder: str) -> str:
    return f"rollcall_{hashlib.md5(folder.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Write all rows, one file per bucket with rows, and read them back. `sort` orders rows inside a file."""
    spark = df.sparkSession
    last = _last_load(spark, path)
    folder, sort = f"{path}/load-{uuid.uuid4().hex}", list(sort or [key])
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(*sort)
     .option("path", folder).saveAsTable(_name(folder)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    entry = ((last["seq"] if last else 0) + 1, folder, key, buckets, sort, columns)
    spark.createDataFrame([entry], LOADS).coalesce(1).write.mode("append").parquet(f"{path}/loads")
    return spark.table(_name(folder))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The last load, with its placement. A session whose catalog does not know the table yet enters it there."""
    last = _last_load(spark, path)
    if last is None:
        raise FileNotFoundError(f"no load of a table under {path}")
    name = _name(last["folder"])
    if not spark.catalog.tableExists(name):
        sort = ", ".join(f"`{c}`" for c in last["sort"])
        location = last["folder"].replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({last['columns']}) USING parquet CLUSTERED BY (`{last['key']}`) "
                  f"SORTED BY ({sort}) INTO {last['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(name)
