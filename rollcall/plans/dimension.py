"""Versioned dimension loaded one snapshot after another.

Rows of a dimension lie in parts: the current versions in `open`, closed ones by the month they were closed in. A
snapshot newer than what a key was seen in meets the current versions only; what it closes is added to the month's part.
A late or corrected snapshot rebuilds the keys for which it changes something, from the history of snapshots, and
replaces only parts closed since its date. Whatever the order of snapshots, the result is that of `scd2` over all of them.

Parts are never overwritten: a load writes new folders and then one list of the folders that count, so readers see the
state before or after a load, and a load that failed or is repeated changes nothing. One load at a time is assumed.
Keys must not be NULL (the intake quarantines such rows); rows without a key or a date are left out. A key that a corrected
snapshot no longer holds keeps its versions until a full rebuild.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.operators.dedup import dedup_latest
from rollcall.sources import Store

OPEN = "open"
LIST = "part string, path string, seq bigint"
#: Late rows whose keys the planner may send to every task. It goes by the size of files, which says little of rows: nine
#: million keys with a date are a few MB of a file's columns, and hundreds of MB in a table that the driver builds to send.
SENT_WHOLE = 100_000
#: Columns that a version adds to the attributes of its first snapshot; `last_seen` is its latest snapshot.
ADDED = ("valid_from", "valid_to", "is_current", "version", "last_seen")


def _list(spark: SparkSession, root: str) -> tuple[int, list[tuple[str, str]]]:
    """Number of the last load, and part and folder of everything that counts: one entry per month and load in it."""
    try:
        entries = spark.read.schema(LIST).parquet(f"{root}/list")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    last = entries.agg(F.max("seq")).first()[0] or 0
    return last, [(r.part, r.path) for r in entries.where(F.col("seq") == last).collect()]


def _met_by_shuffle(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the dimension: both sides are shuffled, whatever size the planner takes it for."""
    return side.hint("merge")


def part_of(valid_to: Column) -> Column:
    return F.coalesce(F.date_format(valid_to, "yyyy-MM"), F.lit(OPEN))


def _read(like: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    paths = [path for _, path in entries]
    return like.sparkSession.read.schema(like.schema).parquet(*paths) if paths else like.where("false")


def read_dimension(spark: SparkSession, root: str, current: bool = False) -> DataFrame:
    """All versions, or the current ones from the open part alone."""
    paths = [path for part, path in _list(spark, root)[1] if part == OPEN or not current]
    return spark.read.parquet(*paths)


def _versions(rows: DataFrame, keys: Sequence[str], date: str, tracked: Sequence[str]) -> DataFrame:
    """Versions from rows with `_seen`, the last snapshot that a row stands for, and `_base`, the versions before it."""
    ordered, whole = Window.partitionBy(*keys).orderBy(date), Window.partitionBy(*keys)
    state, following = F.struct(*tracked), F.lead(date).over(ordered)
    starts = rows.select(
        "*", F.lag(state).over(ordered).alias("_state"), F.lag("_seen").over(ordered).alias("_previous"),
        F.max("_seen").over(whole).alias("_last"), F.max("_base").over(whole).alias("_before"),
    ).where(~state.eqNullSafe(F.col("_state")))
    own = [c for c in rows.columns if c not in (date, "_seen", "_base")]
    return starts.select(
        *own, F.col(date).alias("valid_from"), F.date_sub(following, 1).alias("valid_to"),
        following.isNull().alias("is_current"),
        (F.row_number().over(ordered) + F.col("_before")).cast("int").alias("version"),
        F.coalesce(F.lead("_previous").over(ordered), F.col("_last")).alias("last_seen"))


def build_versions(snapshots: DataFrame, keys: Sequence[str], date: str, tracked: Sequence[str]) -> DataFrame:
    """`scd2` with the column `last_seen`."""
    usable = reduce(lambda df, c: df.where(F.col(c).isNotNull()), [*keys, date], snapshots)
    rows = dedup_latest(usable, [*keys, date], [])
    return _versions(rows.withColumn("_seen", F.col(date)).withColumn("_base", F.lit(0)), keys, date, tracked)


def _changing(late: DataFrame, versions: DataFrame, keys: Sequence[str], date: str, tracked: Sequence[str]) -> DataFrame:
    """Late rows that are neither inside a version of the same state nor the row a version began with."""
    own = [c for c in late.columns if c not in (*keys, date)]
    stored = versions.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "valid_from", "last_seen",
                             F.struct(*tracked).alias("_state"), F.struct(*own).alias("_row"))
    same_key = [late[k] == F.col(f"_k{i}") for i, k in enumerate(keys)]
    inside = ((late[date] > F.col("valid_from")) & (late[date] <= F.col("last_seen"))
              & F.struct(*[late[c] for c in tracked]).eqNullSafe(F.col("_state")))
    first = (late[date] == F.col("valid_from")) & F.struct(*[late[c] for c in own]).eqNullSafe(F.col("_row"))
    return late.join(_met_by_shuffle(stored), [*same_key, inside | first], "left_anti")


def _all_newer(rows: DataFrame, current: DataFrame, date: str) -> bool:
    """Whether all rows come after all that was seen, as in the daily load; two columns tell."""
    first, last = rows.agg(F.min(date)).first()[0], current.agg(F.max("last_seen")).first()[0]
    return first is None or last is None or first > last


def load_snapshots(arrived: DataFrame, history: DataFrame, root: str, keys: Sequence[str], date: str,
                   tracked: Sequence[str]) -> set[str]:
    """Brings rows of one or more snapshots into the dimension under `root`; returns the parts that were replaced.

    `history` holds all clean snapshots, the arrived ones among them. It is read for keys only whose late rows change
    something. Dates of late rows, their number, names of parts, and keys of up to SENT_WHOLE late rows are all that
    reaches the driver.
    """
    spark, keys = arrived.sparkSession, list(keys)
    store = Store(spark, "dimension")
    usable = reduce(lambda df, c: df.where(F.col(c).isNotNull()), [*keys, date], arrived)
    rows = store.keep(dedup_latest(usable, [*keys, date], []), "arrived")
    like = build_versions(rows.where("false"), keys, date, tracked)
    seq, entries = _list(spark, root)
    current = _read(like, [e for e in entries if e[0] == OPEN])
    newer, late, changed, since = rows, None, None, None
    if not _all_newer(rows, current, date):
        until = _met_by_shuffle(current.select(*keys, F.col("last_seen").alias("_until")))
        met = store.keep(rows.join(until, keys, "left"), "met")
        newer = met.where(F.col("_until").isNull() | (F.col(date) > F.col("_until"))).drop("_until")
        late = store.keep(_changing(met.where(F.col(date) <= F.col("_until")).drop("_until"),
                                    _read(like, entries), keys, date, tracked), "late")
        since, n = late.agg(F.min(date), F.count(F.lit(1))).first()
    if since is not None:
        changed = late.select(*keys).distinct()
        changed = changed if n <= SENT_WHOLE else _met_by_shuffle(changed)
        newer, standing = newer.join(changed, keys, "left_anti"), current.join(changed, keys, "left_anti")
    elif newer.isEmpty():
        return set()
    else:
        standing = current
    # a current version that meets nothing newer comes out as it is
    standing = standing.select(
        *[F.col("valid_from").alias(date) if c == date else F.col(c) for c in rows.columns],
        F.col("last_seen").alias("_seen"), (F.col("version") - 1).alias("_base"))
    made = _versions(standing.unionByName(newer.withColumns({"_seen": F.col(date), "_base": F.lit(0)})),
                     keys, date, tracked)
    if since is not None:
        # a version closed earlier is the same before and after
        made = made.unionByName(
            build_versions(history.select(*rows.columns).join(changed, keys, "left_semi"), keys, date, tracked)
            .where(F.col("valid_to").isNull() | (F.col("valid_to") >= since - dt.timedelta(1))))
    replaced = {OPEN}
    if since is not None:
        least = (since - dt.timedelta(1)).strftime("%Y-%m")
        reached = [e for e in entries if e[0] != OPEN and e[0] >= least]
        gone = (_read(like, reached).where(F.col("valid_to") >= since - dt.timedelta(1))
                .join(changed, keys, "left_semi").select(part_of(F.col("valid_to")).alias("part")).distinct())
        replaced |= {r.part for r in gone.collect()}
        older = _read(like, [e for e in reached if e[0] in replaced])
        left = older.where(F.col("valid_to") >= since - dt.timedelta(1)).join(changed, keys, "left_anti")
        made = made.unionByName(left).unionByName(older.where(F.col("valid_to") < since - dt.timedelta(1)))
    folder = f"{root}/load-{uuid.uuid4().hex}"
    made.withColumn("part", part_of(F.col("valid_to"))).write.partitionBy("part").parquet(folder)
    parts = {r.part for r in spark.read.schema("part string").parquet(folder).distinct().collect()}
    counting = [e for e in entries if e[0] not in replaced] + [(p, f"{folder}/part={p}") for p in sorted(parts)]
    spark.createDataFrame([(*e, seq + 1) for e in counting], LIST).coalesce(1).write.mode("append").parquet(f"{root}/list")
    return replaced & {part for part, _ in entries}
