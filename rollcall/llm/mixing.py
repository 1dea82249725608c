"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, -ln(u) / quality weight. Within a source, documents are sorted by key and their
sizes prefix-summed up to the source's token budget. Complete epochs come first: a budget of 1.4 times the source
takes every document once, and only 0.4 of the source is sampled.

Defined cases: a null text has no words and is never taken; a null source is a source of its own, last in order; a null
doc_id draws the key of the word "null". Rows equal in doc_id, source and text are one unit, taken or left together.
Ties of keys go by doc_id, then by a hash of the text. An empty table gives an empty table. Other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BLANKS, running, store_of
from rollcall.sources import Store

SYMBOLS = "#*$%&|<>"
KEY_BITS = 48
UNIT = ["doc_id", "source", "text_hash"]


def quality_weight(words: Column, text: Column) -> Column:
    """Variety of words, lowered by symbols: distinct words / sqrt(words) / (1 + symbols / words)."""
    symbols = F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))
    n = F.size(words)
    return F.size(F.array_distinct(words)) / F.sqrt(n) / (1 + symbols / n)


def words_of(text: Column) -> Column:
    """The words of a text. Splitting leaves one string a word behind; `regexp_extract_all` leaves a match object a word
    too, which made up most of what executors allocated."""
    return F.array_remove(F.split(text, BLANKS), "")


def exponential_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, where u in (0, 1) comes from a hash of doc_id, so that reruns agree."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":" + seed))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("double")
    return -F.log((draw + 0.5) / float(1 << KEY_BITS)) / weight


def units(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, text_hash, size, key and the number of equal rows."""
    text = F.coalesce("text", F.lit(""))
    return (docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), text.alias("text"),
                        words_of(text).alias("words"))
            .withColumn("size", F.size("words").cast("long"))
            .withColumn("weight", F.when(F.col("size") > 0, quality_weight(F.col("words"), F.col("text")))
                        .otherwise(1.0))
            .select(*UNIT, "size", exponential_key(F.col("doc_id"), F.col("weight"), seed).alias("key"))
            .groupBy(*UNIT, "size", "key").agg(F.count(F.lit(1)).alias("copies")))


def source_targets(sizes: DataFrame, store: Store, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """source, source_index, source_size, target. `sizes` has one row per source.

    All targets add up to `share` times all sizes; each is its weight times one level, but `most` times its size at
    most. The capped total is the lower envelope of straight lines in that level, one for each number of capped
    sources in the order they reach their cap, so the level is the largest at which one of them reaches the total.
    """
    sizes = sizes.withColumn("nulls", F.col("source").isNull()).withColumn("one", F.lit(1))
    ranked = running(sizes, store, [], ["nulls", "source"], "one", "source_index").drop("nulls", "one")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = store.keep(ranked.withColumn("weight", F.get(cycle, (F.col("source_index") % len(weights)).cast("int")))
                        .withColumn("cap", F.col("source_size") * most)
                        .withColumn("full_at", F.col("cap") / F.col("weight")), "weighed")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    order = ["full_at", "source_index"]
    lines = running(ranked, store, [], order, ["cap", "weight"], ["capped", "gone"])
    level = lines.agg(F.max((F.lit(share * (total or 0)) - F.col("capped")) / (F.lit(weight or 1) - F.col("gone")))
                      ).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level or 0.0) * F.col("weight"))
    return ranked.select("source", "source_index", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
        seed: str = "mix-1") -> DataFrame:
    """One row per unit of equal rows: doc_id, source, text_hash, size, copies, source_size, target, times.

    `times` is how often the mix takes each of the unit's rows. The unit at the end of a budget is taken if more than
    half of it fits. Only the units and their ranges are written row by row; what is joined to them is one row per source.
    """
    store = store_of(docs, "mixing")
    rows = store.keep(units(docs, seed), "units")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    targets = source_targets(sizes, store, weights, share, most).withColumnRenamed("source", "of")
    rows = (rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("length", F.col("size") * F.col("copies")))
    summed = running(rows, store, ["source_index"], ["key", "doc_id", "text_hash"], "length", "before")
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    rest = F.col("target") - F.col("epochs") * size
    more = (2 * F.col("before") + F.col("length") <= 2 * rest) & (F.col("size") > 0)
    return summed.withColumn("epochs", epochs).withColumn("times", (F.col("epochs") + more.cast("long"))).select(
        *UNIT, "size", "copies", "source_size", "target",
        F.when(F.col("size") > 0, F.col("times")).otherwise(0).alias("times"))


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken, one row per row of `docs`."""
    mixed = mix(docs.select("doc_id", "source", "text"))
    each = mixed.select("*", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("one"))
    return each.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    times = mix(docs.select("doc_id", "source", "text"), **parameters).where("times > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), "times")
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_text_hash"))
    same = (F.col("_row.doc_id").eqNullSafe(F.col("_id")) & F.col("_row.source").eqNullSafe(F.col("_source"))
            & (F.col("_text_hash") == F.col("_hash")))
    return (rows.join(store_of(docs, "mixing").keep(times, "times"), same)
            .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("_one"))
            .select("_row.*"))


SQL = r"""
WITH read AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
sized AS (
    SELECT doc_id, source, text, len(words) AS size,
           CASE WHEN len(words) > 0 THEN len(list_distinct(words)) / sqrt(len(words))
                / (1 + (length(text) - length(translate(text, '#*$%&|<>', ''))) / len(words)) ELSE 1.0 END AS weight
    FROM read),
keyed AS (
    SELECT *, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix-1'), 1, 12) AS BIGINT)
                   + 0.5) / 281474976710656.0) / weight AS key
    FROM sized),
sources AS (
    SELECT source, sum(size) AS source_size,
           [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source),
lines AS (
    SELECT coalesce(sum(2 * source_size) OVER before, 0) AS capped, coalesce(sum(weight) OVER before, 0) AS gone,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM sources
    WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((1.5 * total - capped) / (weights - gone)) AS level FROM lines),
targets AS (
    SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), level * weight) AS target
    FROM sources, level),
summed AS (
    SELECT k.doc_id, k.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
           sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size AS before
    FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size,
       CAST(target AS DOUBLE) AS target,
       CAST(size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size) AND size > 0
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""
