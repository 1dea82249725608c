"""Incremental intake of daily exports, with a ledger of files.

Exports land as CSV under `.../export_date=YYYY-MM-DD/`. A stream over the files (their names, not their rows) finds
what has arrived; what was corrected under its old name is found by comparing the folder with the ledger, since a
file stream takes a name only once. Both are read by the same lossless reader: rows that parse go to the history,
the others to a quarantine, each in a partition of its own per export and version of a file.

The ledger has one entry per file taken: path, size, time of change, version, checksum and counts. A version is
derived from path, size and time, so that taking a file again writes the same partition again, and the entry of the
ledger comes last: after a failure the work is repeated without effect. Readers see the newest version of every file
only. Cleaning compares the ledger with the state that each export was cleaned in, so exports that did not change are
neither listed by their rows nor scanned. Medians are taken per export, so they do not depend on batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.dedup import dedup_latest
from rollcall.plans.silver import clean_columns, staged_silver
from rollcall.schema import BRONZE, KEY
from rollcall.sources.files import MALFORMED, from_csv_types, read_csv_rows
from rollcall.sources.store import Store

EXPORT_DATE = "export_date"
#: Partition column of the history and the quarantine: which version of which file a row comes from.
VERSION = "file_version"
#: Files whose names are held at once; a batch reads all of their rows.
FILES_PER_BATCH = 1000

FILE = "path string, modificationTime timestamp, length bigint"
LEDGER = (f"{FILE}, {VERSION} string, {EXPORT_DATE} date, checksum bigint, rows bigint, malformed bigint, seq bigint")
CLEANED = f"{EXPORT_DATE} date, state string, rows bigint, seq bigint"


def quarantine_of(history: str) -> str:
    return f"{history}_quarantine"


def ledger_of(table: str) -> str:
    return f"{table}_ledger"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _newest(entries: DataFrame, key: str) -> DataFrame:
    """The entry of each key that was written last."""
    columns = [c for c in entries.columns if c != key]
    return entries.groupBy(key).agg(F.max(F.struct("seq", *[c for c in columns if c != "seq"])).alias("e")).select(
        key, "e.*")


def ledger(spark: SparkSession, history: str) -> DataFrame:
    """One row per file: the version that counts."""
    return _newest(_read(spark, ledger_of(history), LEDGER), "path")


def _next(spark: SparkSession, path: str, schema: str) -> int:
    return (_read(spark, path, schema).agg(F.max("seq")).first()[0] or 0) + 1


def _listed(spark: SparkSession, landing: str) -> DataFrame:
    """Path, time and size of every file that has landed; no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
            .select("path", "modificationTime", "length"))


def corrected(spark: SparkSession, landing: str, history: str) -> DataFrame:
    """Files of the ledger that look different now."""
    known = ledger(spark, history).select("path", F.col("modificationTime").alias("_time"), F.col("length").alias("_n"))
    return (_listed(spark, landing).join(known, "path")
            .where((F.col("modificationTime") != F.col("_time")) | (F.col("length") != F.col("_n")))
            .select("path", "modificationTime", "length"))


def _plain_path(path: str):
    """Listings differ in the number of slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _uris(spark: SparkSession, paths: list[str]) -> DataFrame:
    """_path, _uri: the escaped name by which rows of a file know it, once per file. No file is opened."""
    return spark.read.format("binaryFile").load(paths).select(
        _plain_path("path").alias("_path"), F.col("_metadata.file_path").alias("_uri"))


def take_files(spark: SparkSession, files: list, history: str) -> None:
    """Rows of the given files (path, modificationTime, length) into history and quarantine, then into the ledger."""
    if not files:
        return
    store = Store(spark, "intake")
    listed = spark.createDataFrame([tuple(f) for f in files], FILE).select(
        _plain_path("path").alias("_path"), "*",
        F.sha2(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime")
                           .cast("string")), 256).substr(1, 24).alias(VERSION),
        F.to_date(F.regexp_extract("path", rf"{EXPORT_DATE}=(\d+-\d+-\d+)", 1)).alias(EXPORT_DATE))
    if lost := [r.path for r in listed.where(F.col(EXPORT_DATE).isNull()).select("path").collect()]:
        raise ValueError(f"not in a folder of an export date: {lost[:3]}")
    # kept, so that the planner knows how small it is and the rows are not shuffled to meet it
    paths = [f.path for f in files]
    listed = store.keep(listed.join(_uris(spark, paths), "_path").drop("_path"), "listed")
    raw = read_csv_rows(spark, paths, more=[F.col("_metadata.file_path").alias("_uri")])
    typed = from_csv_types(raw.select(*BRONZE.fieldNames(), MALFORMED, "_uri"), BRONZE)
    rows = store.keep(typed.join(listed.select("_uri", VERSION, EXPORT_DATE), "_uri").drop("_uri"), "taken")
    good, bad = rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED), rows.where(F.col(MALFORMED).isNotNull())
    record = bad.select(F.col(MALFORMED).alias("record"), VERSION, EXPORT_DATE)
    for table, part in ((history, good), (quarantine_of(history), record)):
        # a task of the read holds rows of a few files only, each a partition of its own, so there is nothing to gather
        (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(EXPORT_DATE, VERSION).parquet(table))
    counted = rows.groupBy(VERSION).agg(
        F.bit_xor(F.xxhash64(*BRONZE.fieldNames(), MALFORMED)).alias("checksum"),
        F.count_if(F.col(MALFORMED).isNull()).alias("rows"), F.count(MALFORMED).alias("malformed"))
    entries = listed.drop("_uri").join(counted, VERSION, "left").withColumn(
        "seq", F.lit(_next(spark, ledger_of(history), LEDGER)))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("checksum", "rows", "malformed")}
    entries.withColumns(zero).select(*[c.split()[0] for c in LEDGER.split(", ")]).coalesce(1).write.mode(
        "append").parquet(ledger_of(history))


def ingest_increment(spark: SparkSession, landing: str, history: str, checkpoint: str,
                     files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take in every file not seen before and every file that has changed since, then stop."""
    arrivals = (spark.readStream.format("binaryFile").schema(f"{FILE}, content binary")
                .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(landing)
                .select("path", "modificationTime", "length"))
    query = (arrivals.writeStream.foreachBatch(lambda batch, _: take_files(spark, batch.collect(), history))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    changed = corrected(spark, landing, history).orderBy("path").collect()
    for k in range(0, len(changed), files_per_batch):
        take_files(spark, changed[k:k + files_per_batch], history)


def _current(spark: SparkSession, table: str, history: str, schema, days: list[dt.date] | None) -> DataFrame:
    found = _read(spark, table, schema)
    if days is not None:
        found = found.where(F.col(EXPORT_DATE).isin(days))
    return found.join(ledger(spark, history).select(VERSION), VERSION, "left_semi").drop(VERSION)


def read_history(spark: SparkSession, history: str, days: list[dt.date] | None = None) -> DataFrame:
    """Rows of the newest version of every file, of some exports or all."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE)
    return _current(spark, history, history, f"{columns}, {EXPORT_DATE} date, {VERSION} string", days)


def read_quarantine(spark: SparkSession, history: str, days: list[dt.date] | None = None) -> DataFrame:
    """(record, export_date): rows that did not parse, in the newest version of every file."""
    return _current(spark, quarantine_of(history), history, f"record string, {EXPORT_DATE} date, {VERSION} string", days)


def clean_exports(history: DataFrame, store: Store | None = None) -> DataFrame:
    """Silver rows of every export: one per key and export date, medians taken inside the export."""
    return clean_columns(staged_silver(history.drop(VERSION), store, [KEY, EXPORT_DATE], [EXPORT_DATE]))


def export_states(spark: SparkSession, history: str) -> DataFrame:
    """export_date, state (of its files' contents), rows: from the ledger alone."""
    content = F.struct("checksum", "rows", "malformed")
    return ledger(spark, history).groupBy(EXPORT_DATE).agg(
        F.sha2(F.to_json(F.sort_array(F.collect_list(content))), 256).alias("state"), F.sum("rows").alias("rows"))


def stale_states(spark: SparkSession, history: str, cleaned: str) -> DataFrame:
    """Exports that are not cleaned in their present state. A file that was only touched leaves its export alone."""
    done = _newest(_read(spark, ledger_of(cleaned), CLEANED), EXPORT_DATE).select(
        EXPORT_DATE, F.col("state").alias("_state"))
    waiting = export_states(spark, history).join(done, EXPORT_DATE, "left")
    return waiting.where(~F.col("state").eqNullSafe(F.col("_state"))).drop("_state")


def stale_exports(spark: SparkSession, history: str, cleaned: str) -> list[dt.date]:
    return sorted(r[EXPORT_DATE] for r in stale_states(spark, history, cleaned).select(EXPORT_DATE).collect())


def refresh_exports(spark: SparkSession, history: str, cleaned: str, store: Store) -> list[dt.date]:
    """Clean the exports that changed and replace their partitions; the others are neither read nor written."""
    stale = store.keep(stale_states(spark, history, cleaned), "stale")
    days = sorted(r[EXPORT_DATE] for r in stale.collect())  # one per day of the calendar
    if days:
        staged = staged_silver(read_history(spark, history, days), store, [KEY, EXPORT_DATE], [EXPORT_DATE])
        staged.hint("rebalance", EXPORT_DATE).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(EXPORT_DATE).parquet(cleaned)
        stale.withColumn("seq", F.lit(_next(spark, ledger_of(cleaned), CLEANED))).select(
            *[c.split()[0] for c in CLEANED.split(", ")]).coalesce(1).write.mode("append").parquet(ledger_of(cleaned))
    return days


def read_exports(spark: SparkSession, cleaned: str) -> DataFrame:
    """Silver rows of all cleaned exports, without those whose files have no row left that parses."""
    filled = _newest(_read(spark, ledger_of(cleaned), CLEANED), EXPORT_DATE).where("rows > 0").select(EXPORT_DATE)
    return clean_columns(spark.read.parquet(cleaned)).join(filled, EXPORT_DATE, "left_semi")


def current_view(exports: DataFrame) -> DataFrame:
    """The newest export of each key. A file that arrives late cannot replace a newer one.

    The view of a view and more exports is the view of all of them, so it can be kept up by
    `current_view(view.unionByName(new_exports))` without reading the history again.
    """
    return dedup_latest(exports, [KEY], [F.col(EXPORT_DATE)])
