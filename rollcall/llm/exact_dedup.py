"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every partition normalises its texts, fingerprints them and sorts the fingerprints. Rows that share one within the
   partition are suspects already. To each owner, a range of the fingerprint space, it sends its share of the distinct
   fingerprints as gaps in a Golomb-Rice code, so a text that many rows hold is one entry per partition. The number of
   owners follows the number of rows.
2. Owners decode and merge what they got and answer each partition with a bitmap of those that occurred elsewhere too.
3. Suspects alone are shuffled with their texts, and grouped by all their bytes. A bitmap of fixed size over the
   suspects' fingerprints lets the second scan leave the others where they are; when it fills up, more texts move,
   and the result is the same.

Defined cases: a null text counts as empty. Null doc_ids come after all others. Of rows with equal text and the same
smallest doc_id exactly one stays. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import SPACES, TEXT_BYTES, map_columns, session_of, store_of

#: Bits of the filter over suspects' fingerprints that scanning tasks get: 1 MB at any size of the input.
FILTER_BITS = 23
#: Fingerprints that an owner gets on average at most.
OWNED = 2_000_000


def normalised(text: bytes) -> bytes:
    """The text with each run of white space replaced by one space."""
    if not text:
        return text
    lead = b" " if text[0] in SPACES else b""
    words = b" ".join(text.split())
    return lead + words + b" " if words and text[-1] in SPACES else lead + words


def golomb_encode(gaps: np.ndarray, k: int) -> bytes:
    """Quotients by 2**k in unary, then the remainders in k bits each."""
    gaps = gaps.astype(np.uint64)
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, dtype=np.uint8)
    unary[ends] = 1
    rest = np.unpackbits(gaps.astype(">u8").view(np.uint8)).reshape(-1, 64)[:, 64 - k:]
    unary = np.packbits(unary).tobytes()
    return len(unary).to_bytes(8, "big") + unary + np.packbits(rest).tobytes()


def golomb_decode(data: bytes, n: int, k: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "big")
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, 8))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1).astype(np.uint64) - np.uint64(1)
    bits = np.zeros((n, 64), dtype=np.uint8)
    if k:
        bits[:, 64 - k:] = np.unpackbits(np.frombuffer(data, np.uint8, offset=8 + size))[:n * k].reshape(n, k)
    rest = np.packbits(bits).view(">u8").astype(np.uint64)
    return (quotients << np.uint64(k)) | rest


def rice_parameter(span: int, n: int) -> int:
    """The number of remainder bits that suits n values spread evenly over a span."""
    return max(0, min(63, int(span / max(n, 1) * 0.69).bit_length() - 1))


def owners_for(rows: int, least: int) -> int:
    return max(least, -(-rows // OWNED))


def _owner_starts(owners: int) -> list[int]:
    return [-(-(o << 64) // owners) for o in range(owners + 1)]


#: `entry` is the number of a row's fingerprint among the distinct ones of its partition, or the first of a message.
ROWS = ("kind int, part long, pos long, doc_id long, sha binary, entry long, repeated boolean, owner int, n long, k int, "
        "payload binary")


def _fingerprint(owners: int):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ROWS))
    starts = _owner_starts(owners)

    def batch(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns.get(f.name, [None] * n), f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, shas = TaskContext.get().partitionId(), [], []
        for b in batches:
            ids += b.column("doc_id").to_pylist()
            shas += [hashlib.sha256(normalised(t)).digest() for t in b.column("body").to_pylist()]
        prints = np.frombuffer(b"".join(s[:8] for s in shas), dtype=">u8").astype(np.uint64)
        order = np.argsort(prints, kind="stable")
        prints, entries, counts = np.unique(prints[order], return_inverse=True, return_counts=True)
        repeated = counts[entries] > 1
        for lo in range(0, len(order), 50_000):
            some = order[lo:lo + 50_000]
            yield batch(kind=[0] * len(some), part=[part] * len(some), pos=list(range(lo, lo + len(some))),
                        doc_id=[ids[i] for i in some], sha=[shas[i] for i in some],
                        entry=entries[lo:lo + 50_000], repeated=repeated[lo:lo + 50_000])
        cuts = np.searchsorted(prints, np.array(starts[1:-1], dtype=np.uint64)) if owners > 1 else []
        bounds = [0, *map(int, cuts), len(prints)]
        for o in range(owners):
            lo, hi = bounds[o], bounds[o + 1]
            if hi > lo:
                own = prints[lo:hi]
                gaps = np.diff(own, prepend=np.uint64(starts[o]))
                k = rice_parameter(starts[o + 1] - starts[o], hi - lo)
                yield batch(kind=[1], part=[part], entry=[lo], owner=[o], n=[hi - lo], k=[k],
                            payload=[golomb_encode(gaps, k)])

    return run


def _answer(owners: int):
    starts = _owner_starts(owners)

    def run(messages: pd.DataFrame) -> pd.DataFrame:
        start = np.uint64(starts[int(messages["owner"].iloc[0])])
        lists = [start + np.cumsum(golomb_decode(p, n, k))
                 for p, n, k in zip(messages["payload"], messages["n"], messages["k"])]
        seen, where, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        twice = counts[where] > 1
        ends = np.cumsum([len(x) for x in lists])
        bitmaps = [np.packbits(x).tobytes() for x in np.split(twice, ends[:-1])]
        return pd.DataFrame({"part": messages["part"], "entry": messages["entry"], "n": messages["n"], "bitmap": bitmaps})

    return run


def _expand():
    def work(c):
        part, entry = [], []
        for p, lo, n, bits in zip(c["part"], c["entry"], c["n"], c["bitmap"]):
            found = lo + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[:n])
            part += [p] * len(found)
            entry += found.tolist()
        return {"part": part, "entry": entry}
    return work


def _suspect_texts(filter_bits: bytes, bits: int):
    def make():
        mask = np.frombuffer(filter_bits, np.uint8)

        def work(c):
            shas, texts = [], []
            for body in c["body"]:
                text = normalised(body)
                sha = hashlib.sha256(text).digest()
                slot = int.from_bytes(sha[:8], "big") >> (64 - bits)
                if mask[slot >> 3] >> (slot & 7) & 1:
                    shas.append(sha)
                    texts.append(text)
            return {"sha": shas, "body": texts}
        return work
    return make


def find_copies(docs: DataFrame, owners: int | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = session_of(docs)
    store = store_of(docs, "exact_dedup")
    owners = owners or owners_for(docs.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bodies = docs.select("doc_id", F.expr(TEXT_BYTES).alias("body"))
    sent = store.keep(bodies.mapInArrow(_fingerprint(owners), ROWS), "fingerprints")
    read = sent.where("kind = 0").select("part", "pos", "doc_id", "sha", "entry", "repeated")
    rows = read.drop("entry", "repeated")
    answers = (sent.where("kind = 1").select("owner", "part", "entry", "n", "k", "payload")
               .groupBy("owner").applyInPandas(_answer(owners), "part long, entry long, n long, bitmap binary"))
    places = map_columns(answers, "part long, entry long", _expand)
    elsewhere = read.where("NOT repeated").join(places, ["part", "entry"], "left_semi")
    suspects = store.keep(read.where("repeated").unionByName(elsewhere).select(rows.columns), "suspects")

    # the first bits of each suspect's fingerprint, packed: at most 2**(bits - 3) bytes, whatever the input
    slot = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    slot = F.shiftright(slot, 32 - filter_bits)
    packed = (suspects.select(slot.alias("s")).select(F.shiftright("s", 3).alias("byte"),
                                                      F.expr("shiftleft(1, cast(s & 7 AS int))").alias("bit"))
              .groupBy("byte").agg(F.bit_or("bit").alias("bits")))
    mask = np.zeros(1 << (filter_bits - 3), dtype=np.uint8)
    filled = packed.toPandas()
    mask[filled["byte"].to_numpy(dtype=np.int64)] = filled["bits"].to_numpy(dtype=np.uint8)

    texts = map_columns(bodies.select("body"), "sha binary, body binary", _suspect_texts(mask.tobytes(), filter_bits))
    same_bytes = texts.groupBy("sha", "body").agg(F.count(F.lit(1)).alias("n"))
    verified = same_bytes.groupBy("sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "part", "pos")).alias("first")
    groups = (suspects.groupBy("sha").agg(first, F.count(F.lit(1)).alias("group_size"))
              .join(verified, "sha", "left")
              .withColumn("group_size", F.when((F.col("texts") == 1) & (F.col("n") == F.col("group_size")),
                                               F.col("group_size"))
                          .otherwise(F.raise_error(F.lit("texts with one SHA-256 differ")).cast("long")))
              .select("sha", "first", "group_size"))
    alone = F.col("group_size").isNull()
    return (rows.join(store.keep(groups, "groups"), "sha", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce((F.col("first.part") == F.col("part")) & (F.col("first.pos") == F.col("pos")), F.lit(True))
        .alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256")))


SQL = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
"""
