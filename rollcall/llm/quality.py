"""Quality rules with thresholds that the data set: quantile sketches per language and source.

Signals of a document are shares in thousandths, and tenths of characters for the mean word. A sketch counts documents
per cell of values: whole values below 256, then ranges of 1/128 of their value, so any value has a cell, sketches
merge by addition, and a quantile is off by less than 1/128 of itself. The sketch of each language and source is merged
with the one of its whole language, which counts as PRIOR documents at every size: a large source is judged by itself,
a small one by its language, with no border between. A signal's limit lies above the group's median by a multiple of
the distance to an upper quantile (SIGNALS), so what is usual in a language and source passes, wherever that lies. The
only floor is the error of the sketch.

Defined cases: a null text has no words. Null languages and sources are groups of their own. Every row is judged by
itself. An empty table gives an empty table. Columns other than text, lang and source are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.common import TEXT_BYTES, session_of, store_of
from rollcall.sources import Store

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(0x41, 0x5B))
LEAST_WORDS, MOST_REPEATED = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Signal: the upper quantile in percent, and how many times its distance from the median the limit lies above it.
SIGNALS = {"symbol_share": (90, 4), "dup_line_share": (98, 2), "repeat_share": (95, 6), "capital_share": (90, 4),
           "word_tenths": (90, 3)}
#: Documents as which the sketch of the language counts beside the one of a source.
PRIOR = 50
#: Rows that a task measures at once.
SLICE = 1000
#: Bits of a value that its cell keeps.
CELL_BITS = 8


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    a = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(a[:-1] * len(numbers) + a[1:], return_inverse=True)[1]
    _, where, counts = np.unique(pairs[:-1] * len(numbers) + a[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """COUNTS, then lines with a word and ASCII capitals."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode()), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(text) - len(text.translate(None, CAPITALS)))


def measured(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """The columns `keep` and the measures of every text."""
    names = [*COUNTS, "n_lines", "n_capitals"]
    source = docs.select(*[c.alias(k) for k, c in keep.items()], F.expr(TEXT_BYTES).alias("body"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "body")
    schema += "".join(f", {n} long" for n in names)
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    session_of(docs)
    kept_names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                found = zip(*map(measure, part["body"].to_pylist()))
                handed = [part[c].cast(arrow.field(c).type) for c in kept_names]  # never turned into Python objects
                yield pa.RecordBatch.from_arrays([*handed, *[pa.array(c, pa.int64()) for c in found]], schema=arrow)

    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def signals() -> dict[str, Column]:
    """Whole numbers, exact in any engine."""
    def share(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"{scale} * {part} DIV greatest({whole}, 1)")
    return {"symbol_share": share("n_symbols", "word_chars", 1000),
            "dup_line_share": share("n_dup_lines", "n_lines", 1000),
            "repeat_share": share("n_repeat_words", "n_words", 1000),
            "capital_share": share("n_capitals", "word_chars", 1000),
            "word_tenths": share("word_chars", "n_words", 10)}


def cell_of(value: str) -> Column:
    """The least value of the cell: all but the leading CELL_BITS bits are zero."""
    low = f"greatest(length(bin({value})) - {CELL_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {low}), {low})")


def sketches(measures: DataFrame) -> DataFrame:
    """lang, source, signal, cell, n: documents that pass the base rules, counted per cell of each signal."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), v.alias("value")) for s, v in signals().items()]))
    return (measures.where(~base_failed()).select("lang", "source", each.alias("e"))
            .select("lang", "source", "e.signal", cell_of("e.value").alias("cell"))
            .groupBy("lang", "source", "signal", "cell").agg(F.count(F.lit(1)).alias("n")))


def merged_sketches(sketch: DataFrame, store: Store) -> DataFrame:
    """lang, source, signal, cell, weight: each source's sketch with its language's, scaled to PRIOR documents.

    Weights are whole: n of the source times the documents of the language, plus n of the language times PRIOR.
    """
    language = store.keep(sketch.groupBy("lang", "signal", "cell").agg(F.sum("n").alias("shared")).withColumnsRenamed(
        {"lang": "_lang", "signal": "_signal"}), "languages")
    groups = sketch.select("lang", "source", "signal").distinct()
    prior = groups.join(language, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("signal") == F.col("_signal")))
    both = sketch.select("*", F.lit(0).cast("long").alias("shared")).unionByName(
        prior.select("lang", "source", "signal", "cell", F.lit(0).cast("long").alias("n"), "shared"))
    cells = both.groupBy("lang", "source", "signal", "cell").agg(F.sum("n").alias("n"), F.sum("shared").alias("shared"))
    in_language = F.sum("shared").over(Window.partitionBy("lang", "source", "signal")).cast("decimal(18,0)")
    weight = F.col("n").cast("decimal(18,0)") * in_language + F.col("shared").cast("decimal(18,0)") * PRIOR
    return cells.select("lang", "source", "signal", "cell", weight.alias("weight"))


def limits(merged: DataFrame) -> DataFrame:
    """lang, source, signal, limit: the largest value that passes."""
    group = Window.partitionBy("lang", "source", "signal")
    summed = (merged.withColumn("below", F.sum("weight").over(group.orderBy("cell")))
              .withColumn("all", F.sum("weight").over(group)))
    upper, times = (F.create_map(*[F.lit(x) for s, v in SIGNALS.items() for x in (s, v[k])])[F.col("signal")]
                    for k in (0, 1))

    def quantile(percent: Column) -> Column:
        return F.min(F.when(100 * F.col("below") >= percent * F.col("all"), F.col("cell")))

    found = summed.groupBy("lang", "source", "signal").agg(quantile(F.lit(50)).alias("middle"),
                                                           quantile(upper).alias("upper"))
    limit = F.col("middle") + times * (F.col("upper") - F.col("middle"))
    return found.withColumn("_limit", limit).select(
        "lang", "source", "signal", F.expr("_limit + greatest(1, _limit DIV 128)").alias("limit"))


def thresholds(measures: DataFrame, store: Store) -> DataFrame:
    """lang, source and the limit of each signal; no row for a group in which no document passes the base rules."""
    sketch = store.keep(sketches(measures), "sketches")
    per_group = limits(merged_sketches(sketch, store)).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("signal") == s, F.col("limit"))).alias(f"{s}_limit") for s in SIGNALS])
    return store.keep(per_group, "thresholds")


def judged(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """The columns `keep`, COUNTS, base_failed and kept. Measures are stored once; only narrow columns are sketched.

    The documents' side of the join with the limits is not aggregated before, so a source with most documents is
    split among tasks when the limits are too many to be broadcast.
    """
    store = store_of(docs, "quality")
    measures = store.keep(measured(docs, keep | {"lang": F.col("lang"), "source": F.col("source")}), "measures")
    limit = thresholds(measures, store).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measures.join(limit, F.col("lang").eqNullSafe(F.col("_lang"))
                           & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = [F.coalesce(v <= F.col(f"{s}_limit"), F.lit(True)) for s, v in signals().items()]
    kept = ~F.col("base_failed")
    for each in inside:
        kept = kept & each
    return (joined.withColumn("base_failed", base_failed()).withColumn("kept", kept)
            .select(*keep, *COUNTS, "base_failed", "kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged."""
    return judged(docs, {"row": F.struct("*")}).where("kept").select("row.*")


SQL = r"""
WITH read AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
tokens AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM read),
windows AS (
    SELECT doc_id, i, w, lead(w, 1) OVER d AS w1, lead(w, 2) OVER d AS w2
    FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
starts AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2) > 1 AS twice FROM windows WHERE w2 IS NOT NULL),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM starts, (VALUES (0), (1), (2)) AS o(k) WHERE twice GROUP BY doc_id),
texts AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM read),
lined AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM texts WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
    SELECT r.doc_id, lang, source, len(words) AS n_words, length(list_aggregate(words, 'string_agg', '')) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM read r LEFT JOIN lined USING (doc_id) LEFT JOIN covered USING (doc_id)),
based AS (
    SELECT * REPLACE (coalesce(word_chars, 0) AS word_chars),
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
signals AS (
    SELECT doc_id, lang, source, base_failed, unnest([
        {'signal': 'symbol_share', 'value': 1000 * n_symbols // greatest(word_chars, 1), 'up': 90, 'times': 4},
        {'signal': 'dup_line_share', 'value': 1000 * n_dup_lines // greatest(n_lines, 1), 'up': 98, 'times': 2},
        {'signal': 'repeat_share', 'value': 1000 * n_repeat_words // greatest(n_words, 1), 'up': 95, 'times': 6},
        {'signal': 'capital_share', 'value': 1000 * n_capitals // greatest(word_chars, 1), 'up': 90, 'times': 4},
        {'signal': 'word_tenths', 'value': 10 * word_chars // greatest(n_words, 1), 'up': 90, 'times': 3}],
        recursive := true)
    FROM based),
cells AS (
    SELECT *, (value >> greatest(length(bin(value)) - 8, 0)::BIGINT) << greatest(length(bin(value)) - 8, 0)::BIGINT AS cell
    FROM signals),
counted AS (
    SELECT g.lang, g.source, g.signal, c.cell, any_value(c.up) AS up, any_value(c.times) AS times,
           (count(*) FILTER (c.source IS NOT DISTINCT FROM g.source))::HUGEINT AS own, count(*)::HUGEINT AS shared
    FROM (SELECT DISTINCT lang, source, signal FROM cells WHERE NOT base_failed) g
    JOIN cells c ON c.signal = g.signal AND c.lang IS NOT DISTINCT FROM g.lang WHERE NOT c.base_failed GROUP BY ALL),
weighed AS (SELECT *, own * sum(shared) OVER (PARTITION BY lang, source, signal) + shared * 50 AS weight FROM counted),
placed AS (
    SELECT *, sum(weight) OVER (PARTITION BY lang, source, signal ORDER BY cell) AS below,
           sum(weight) OVER (PARTITION BY lang, source, signal) AS every FROM weighed),
quantiles AS (
    SELECT lang, source, signal, any_value(times) AS times, min(cell) FILTER (100 * below >= 50 * every) AS middle,
           min(cell) FILTER (100 * below >= up * every) AS upper FROM placed GROUP BY 1, 2, 3),
limits AS (
    SELECT lang, source, signal, l + greatest(1, l // 128) AS bound
    FROM (SELECT *, middle + times * (upper - middle) AS l FROM quantiles)),
verdicts AS (
    SELECT c.doc_id, bool_and(coalesce(c.value <= s.bound, TRUE)) AS inside
    FROM cells c LEFT JOIN limits s ON s.signal = c.signal AND s.lang IS NOT DISTINCT FROM c.lang
                                   AND s.source IS NOT DISTINCT FROM c.source
    GROUP BY c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND inside AS kept
FROM based JOIN verdicts USING (doc_id)
"""
