"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters, digits and non-ASCII bytes, case kept; every other visible byte is a word of its own. Single
words and pairs of neighbours are hashed into 2 ** BITS slots (two equal neighbours are one and the same n-gram,
whatever the word), weighed by 1 + ln(count) and scaled to length one. Training keeps two numbers per slot, the
accumulated gradients `z` and their squares `n`; a weight follows from them in closed form and is exactly zero while
|z| stays below L1. The labelled rows are dealt to a fixed number of shards; in each round every shard walks its rows
from the common state, and the changes of all shards are averaged. A text's score is a sparse dot product.

The training texts are a bounded sample: at most SAMPLE of each label, those with the smallest hashes of doc_id. Both
labels weigh the same in all. What the driver holds is the state, 2 ** BITS slots, and the changes of SHARDS shards.

Defined cases: a null or empty text, or one of white space only, has no n-grams and gets the score of the bias. Rows
with a null or other label, or with a null doc_id, are not learnt from. Of several rows of a document its least text is
learnt from, once for each different label. Without rows of both labels there is nothing to learn and every score is
0.5. Every row is scored by itself and whole, whatever its length; an empty table gives an empty table. Other columns
are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import TEXT_BYTES, map_columns, store_of
from rollcall.llm.toxicity import held_out

#: Labelled rows of each label to learn from; shards and rounds.
SAMPLE, SHARDS, ROUNDS = 2000, 8, 6
#: Slots are numbered by so many bits.
BITS = 18
#: Step size, its damping, and the two regularisers.
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.01, 0.001
#: What the bias counts as beside a text of length one.
BIAS = 0.1
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s\x00]")
#: Odd multipliers that spread a hash; the n-gram of two equal words.
SPREAD, FIRST, SECOND, TWICE = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F, 1))


def ngrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a text's n-grams, ascending, and how often each occurs."""
    words = _WORDS.findall(text)
    one = np.fromiter(map(crc32, words), np.uint64, len(words))
    two = np.where(one[1:] == one[:-1], TWICE, one[:-1] * FIRST + one[1:] * SECOND)
    mixed = (np.concatenate([one, two]) * SPREAD) >> np.uint64(64 - BITS)
    slots, counts = np.unique(mixed.astype(np.int32), return_counts=True)
    return slots, counts.astype(np.int32)


def values(counts: np.ndarray) -> np.ndarray:
    """Values of n-grams with these counts; their squares sum to one."""
    raw = 1 + np.log(counts)
    return raw / np.sqrt(max(1.0, float(raw @ raw)))


@dataclass
class Leader:
    """State of the training; the last slot is the bias."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def start(cls) -> Leader:
        return cls(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, slots=slice(None)) -> np.ndarray:
        z = self.z[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[slots])) / ALPHA + L2)

    def learn(self, slots: np.ndarray, x: np.ndarray, label: int, importance: float) -> None:
        """One row: predict, then move the slots that it holds."""
        w = self.weights(slots)
        gradient = importance * (squash(float(w @ x)) - label) * x
        squares = self.n[slots] + gradient ** 2
        self.z[slots] += gradient - (np.sqrt(squares) - np.sqrt(self.n[slots])) / ALPHA * w
        self.n[slots] = squares


def squash(logit: float) -> float:
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, logit))))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, quality and body of the texts to learn from, one row for each doc_id and label."""
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select("doc_id", "quality").distinct())
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [usable.where(F.col("quality") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    ids = store_of(docs, "ngram_quality").keep(picked[0].union(picked[1]), "picked")
    return (docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")).join(ids, "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("body").alias("body")))


def train_rows(texts: DataFrame) -> DataFrame:
    """shard, place (the order inside a shard), label, slots and counts as whole numbers of 32 bits."""
    def make():
        def work(c):
            found = [ngrams(t) for t in c["body"]]
            return {"shard": c["shard"], "place": c["place"], "doc_id": c["doc_id"], "label": c["quality"],
                    "slots": [s.tobytes() for s, _ in found], "counts": [n.tobytes() for _, n in found]}
        return work

    dealt = texts.withColumns({"place": F.xxhash64(F.lit(1), "doc_id"),
                               "shard": F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(SHARDS)).cast("int")})
    return map_columns(dealt, "shard int, place long, doc_id long, label int, slots binary, counts binary", make)


def one_round(rows: DataFrame, leader: Leader, importance: dict[int, float]) -> Leader:
    """The state after every shard has walked its rows once from `leader`."""
    sent = rows.sparkSession.sparkContext.broadcast((leader.z, leader.n))

    def walk(shard: pa.Table) -> pa.Table:
        z, n = sent.value
        own, touched = Leader(z.copy(), n.copy()), []
        for row in shard.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("label", "ascending")]).to_pylist():
            slots = np.frombuffer(row["slots"], np.int32)
            x = np.append(values(np.frombuffer(row["counts"], np.int32)), BIAS)
            slots = np.append(slots, len(z) - 1)
            own.learn(slots, x, row["label"], importance[row["label"]])
            touched.append(slots)
        at = np.unique(np.concatenate(touched))
        return pa.table({"shard": [shard["shard"][0].as_py()], "slots": [at.astype(np.int32).tobytes()],
                         "z": [(own.z[at] - z[at]).tobytes()], "n": [(own.n[at] - n[at]).tobytes()]},
                        schema=pa.schema([("shard", pa.int32()), ("slots", pa.binary()), ("z", pa.binary()),
                                          ("n", pa.binary())]))

    moved = Leader(leader.z.copy(), leader.n.copy())
    changes = rows.groupBy("shard").applyInArrow(walk, "shard int, slots binary, z binary, n binary").collect()
    for change in sorted(changes, key=lambda r: r.shard):  # SHARDS rows; summed in this order, so reruns agree
        at = np.frombuffer(change.slots, np.int32)
        moved.z[at] += np.frombuffer(change.z) / len(changes)
        moved.n[at] += np.frombuffer(change.n) / len(changes)
    sent.destroy()
    return moved


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the slots, the bias last."""
    rows = store_of(docs, "ngram_quality").keep(train_rows(sampled(docs, labels, sample)), "rows")
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    leader = Leader.start()
    if len(counts) == 2:
        importance = {k: sum(counts.values()) / (2 * n) for k, n in counts.items()}
        for _ in range(rounds):
            leader = one_round(rows, leader, importance)
    return leader.weights()


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row."""
    def make():
        def work(c):
            scores = []
            for text in c["body"]:
                slots, counts = ngrams(text)
                scores.append(float(squash(float(np.sum(weights[slots] * values(counts))) + BIAS * weights[-1])))
            return {"doc_id": c["doc_id"], "score": scores}
        return work

    return map_columns(docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")), "doc_id long, score double", make)


def score_documents(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from `cut` on) of every row."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
