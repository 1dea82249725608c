"""Session settings for a given input size."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 256 * 1024 * 1024
#: Whole employee rows that a task sorts or groups in memory, some 200 MB of them.
PARTITION_ROWS = 250_000
#: Rows that go to a Python worker at once. Spark counts 10,000 rows or 64 MB, of which a task holds several copies on
#: either side.
BATCH_BYTES = 4 * 1024 * 1024
BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def settings(cores: int, input_bytes: int = 0, split_mb: int = 128) -> dict[str, str]:
    """Settings that do not depend on the query.

    Adaptive execution merges small shuffle partitions and splits the skewed ones of joins, but it never raises
    their number, so that starts from the input size.
    """
    wanted = max(cores, -(-input_bytes // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.session.timeZone": "UTC",
    }


def partitions_for(rows: int) -> int:
    """Partitions in which no task holds too many whole rows."""
    return -(-rows // PARTITION_ROWS)


def size_shuffles(spark: SparkSession, rows: int) -> int:
    """Let shuffles start from as many partitions as a table of so many rows needs, where the session has fewer.

    A session that was started for a smaller input would otherwise give each task a fixed share of a growing table,
    which it sorts on disk. Adaptive execution merges the partitions again where they turn out small.
    """
    fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(fixed, partitions_for(rows))
    if wanted > int(spark.conf.get(INITIAL_PARTITIONS, None) or fixed):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return wanted


def size_batches(spark: SparkSession) -> None:
    """Let Python workers take at most BATCH_BYTES of rows at once, unless the session asks for less.

    Batches of wide rows are what most of a worker's memory is, and a worker keeps the memory of its largest.
    """
    now = spark.conf.get(BYTES_PER_BATCH).lower()
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(BYTES_PER_BATCH, str(BATCH_BYTES))


def session(app: str, cores: int, input_bytes: int = 0, master: str | None = None, **more: str) -> SparkSession:
    """A session with these settings. On a cluster, `spark.checkpoint.dir` must name a folder all executors share."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (settings(cores, input_bytes) | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
