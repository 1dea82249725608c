"""Line dedup: a long line that many documents share stays in one of them only.

Lines are exploded with their positions, their keys hashed, documents counted per hash, and what is over the threshold
is dropped; the rest is put together again by position. DataFrame operations only.

Defined cases: a null or empty text is one empty line. Rows with the same doc_id are one document when documents are
counted, and each row is cleaned by itself. A null doc_id counts as one document, smaller than any other. An empty
table gives an empty table. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import store_of

#: White space that is stripped from a line's ends to get its key.
STRIPPED = " \t\n\x0b\x0c\r"
ROW = ["_id", "_text_hash"]


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _stripped(line: Column) -> Column:
    """`btrim` notes the place of every character, so only lines that need it go there."""
    ends = [end for c in STRIPPED for end in (line.startswith(c), line.endswith(c))]
    return F.when(reduce(or_, ends), F.btrim(line, F.lit(STRIPPED))).otherwise(line)


def _folded(line: Column) -> Column:
    """A text that two lines share if and only if they are equal after lower-casing A-Z.

    `translate` would make an object of each character. `lower` does the same to ASCII. Of other lines it is given the
    UTF-8 bytes as Latin-1 characters: it then also maps the first bytes of two-byte characters (C0 to DE) to first bytes
    of longer ones, which stay apart by the number of bytes that follow.
    """
    is_ascii = F.octet_length(line) == F.length(line)
    return F.lower(F.when(is_ascii, line).otherwise(F.decode(line.cast("binary"), "ISO-8859-1")))


def clean_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """`docs` with `n_lines`, `n_dropped` and `kept_text` added; a clashing name in `docs` is replaced.

    A row is known by doc_id and a hash of its text, so equal rows share one decision. Hashes of keys are two 64-bit
    numbers with different seeds. The text moves once, to meet the positions that it loses.
    """
    store = store_of(docs, "line_dedup")
    keys = (docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text_hash"),
                        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
            .withColumn("line", _stripped(F.col("line")))
            .where(F.length("line") >= least_chars)
            .withColumn("key", _folded(F.col("line")))
            .select("_id", "_text_hash", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), F.col("key")).alias("h2")))
    keys = store.keep(keys, "keys")
    shared = (keys.select("h1", "h2", "_id").distinct()
              .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("_id").alias("holder"))
              .where(F.col("n") >= least_docs))
    dropped = (keys.join(store.keep(shared.drop("n"), "shared"), ["h1", "h2"])
               .where(~F.col("_id").eqNullSafe(F.col("holder")))
               .groupBy(*ROW).agg(F.collect_set("pos").alias("_dropped")).toDF("_id2", "_hash2", "_dropped"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"),
                       F.xxhash64("text").alias("_text_hash"))
    # one way at every size: what a broadcast saves on small inputs says nothing about large ones; positions take a small
    # part of what their texts take, so a task holds its positions and lets the texts pass unsorted
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text_hash") == F.col("_hash2"))
    joined = rows.join(dropped.hint("shuffle_hash"), same, "left")
    lines = _lines(F.col("_row.text"))
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped")))
    text = F.when(F.col("_dropped").isNull(), F.coalesce(F.col("_row.text"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    return (joined.withColumn("_lines", lines)
            .select(*[F.col("_row")[c].alias(c) for c in names],
                    F.size("_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    text.alias("kept_text")))


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    cleaned = clean_lines(docs.select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256)
                          .alias("kept_sha256"))


SQL = r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
shared AS (
    SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT k.doc_id, k.line, k.pos, s.holder IS NOT NULL AND s.holder <> k.doc_id AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
