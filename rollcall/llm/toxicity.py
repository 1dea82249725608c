"""Toxicity: a logistic classifier over words and character n-grams, regularised by counterfactuals.

Every labelled text that names a group gets a twin in which each group's name is swapped for another's. Of the other
texts a share, chosen by their bytes, is read as a pair: once with one group's name put in, once with another's in the
same place. Besides the log loss, training penalises the squared difference between the scores of the two of a pair, so
that a name by itself moves the score little and neutral mentions are not taken for toxicity.

Features are presences in the whole text: its words, and their 4- and 5-grams with the word's borders, however long a
word is; text without ASCII spaces or punctuation is one word. Those with the strongest association to the label (chi-squared, counted by Spark over the training texts) are kept, at most MOST_KEPT.
The training texts are a bounded sample: at most SAMPLE of each label, those with the smallest hashes of doc_id. Of
several rows with one doc_id the text with the smallest SHA-256 is learnt from.

Defined cases: a null or empty text has no features and gets the score of the bias, which is low. Rows with a null or
other label are not learnt from; equal labels of a document count once, differing ones as a row each. A null doc_id is hashed as the
text "null" and never learnt from. Every row is scored by itself; an empty table gives an empty table. Other columns
are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.common import TEXT_BYTES, Memo, map_columns, session_of, store_of

#: Rows of each label to learn from; features kept; documents a kept feature must occur in, and its chi-squared.
SAMPLE, MOST_KEPT, LEAST_TEXTS, LEAST_CHI = 4000, 4096, 5, 15.0
GRAMS = (4, 5)
#: Features that a task counts before it passes the counts on.
MOST_COUNTED = 500_000
#: Weight of the counterfactual penalty and of the squared weights.
COUNTERFACTUAL, RIDGE, STEPS = 20.0, 1e-4, 400
#: One text in so many that name no group is read with two names put in.
INSERTED = 4
#: Names that are swapped within their row, each for the next, in the languages of the corpus: English, German, French
#: and Spanish. No name stands in two rows.
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "natives", "foreigners"), ("disabled", "deaf", "blind", "elderly", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"), ("behinderte", "gehörlose", "blinde"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    ("immigrés", "réfugiés", "étrangers"), ("handicapés", "sourds", "aveugles"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
    ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    ("inmigrantes", "refugiados", "extranjeros"), ("discapacitados", "sordos", "ciegos"),
)

_WORD_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
                    for b in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(_WORD_BYTES).split())


def walk(word: bytes) -> Iterator[str]:
    """The features of a word, one after the other; some come repeatedly."""
    text = word.decode()
    marked = f"^{text}$"
    yield f"={text}"
    for n in GRAMS:
        for i in range(len(marked) - n + 1):
            yield marked[i:i + n]


def features_of(word: bytes) -> set[str]:
    return set(walk(word))


def swaps(groups=GROUPS) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, (*g[1:], g[0]))}


def twin_of(words: set[bytes], swap: dict[bytes, bytes]) -> set[bytes]:
    return {swap.get(w, w) for w in words}


def pair_of(body: bytes, words: set[bytes], swap: dict[bytes, bytes],
            share: int = INSERTED) -> tuple[set[bytes], set[bytes]] | None:
    """The words of the two texts whose scores should agree; None where no group is named and none is put in."""
    twin = twin_of(words, swap)
    if twin != words:
        return words, twin
    turn, place = divmod(zlib.crc32(body), share)
    if place or not swap:
        return None
    name = list(swap)[turn % len(swap)]
    return words | {name}, words | {swap[name]}


def differing_twins(texts: DataFrame, groups=GROUPS) -> int:
    """Texts whose twin has other words without a name put in. Takes the column body."""
    def make():
        swap = swaps(groups)

        def work(c):
            return {"differs": [int(twin_of(w, swap) != w) for w in map(words_of, c["body"])]}
        return work

    return map_columns(texts.select("body"), "differs int", make).agg(
        F.coalesce(F.sum("differs"), F.lit(0))).first()[0]


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds == fold


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """toxic and body of the texts to learn from. The ids are picked from the labels alone, at most 2 * sample of
    them, so that only their texts move; copies of an id are merged before they do."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [usable.where(F.col("toxic") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    ids = store_of(docs, "toxicity").keep(picked[0].union(picked[1]), "picked")
    texts = (docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")).join(ids.select("doc_id"), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.expr("min_by(body, sha2(body, 256))").alias("body")))
    return ids.join(texts, "doc_id").select("toxic", "body")


def associations(texts: DataFrame) -> DataFrame:
    """feature, pos, neg: training texts of each label that hold it. Counted per task before they are shuffled; a task
    whose texts hold very many features passes its counts on in parts."""
    schema = "feature string, pos long, neg long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    session_of(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, counts = Memo(features_of), [Counter(), Counter()]

        def counted() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            columns = {"feature": names, "pos": [counts[1][n] for n in names], "neg": [counts[0][n] for n in names]}
            for each in counts:
                each.clear()
            return pa.RecordBatch.from_pydict(columns, schema=arrow)

        for batch in batches:
            for label, body in zip(batch["toxic"].to_pylist(), batch["body"].to_pylist()):
                counts[label].update(set().union(*map(cache.__getitem__, words_of(body))))
                if len(counts[0]) + len(counts[1]) > MOST_COUNTED:
                    yield counted()
        yield counted()

    return texts.mapInArrow(run, schema).groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def select_features(texts: DataFrame, most: int, least_texts: int, least_chi: float) -> list[str]:
    totals = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}  # two rows
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    seen, n = F.col("pos") + F.col("neg"), float(n1 + n0)
    expected = seen * (n1 / n)
    chi = (F.col("pos") - expected) ** 2 / (expected * (n0 / n) * (1 - seen / (n + 1)))
    found = (associations(texts).where(seen >= least_texts).withColumn("chi", chi).where(F.col("chi") >= least_chi)
             .orderBy(F.desc("chi"), "feature").limit(most))
    return [r.feature for r in found.collect()]


class Presence:
    """Numbers of the kept features that a text holds."""

    def __init__(self, features: list[str]):
        number = {f: i for i, f in enumerate(features)}
        self.cache = Memo(lambda w: tuple({number[f] for f in walk(w) if f in number}))

    def __call__(self, words: set[bytes]) -> set[int]:
        return set().union(*map(self.cache.__getitem__, words))


def train_rows(texts: DataFrame, features: list[str], groups) -> DataFrame:
    """label and the features of a text; left and right, those of its counterfactual pair, NULL where it has none or
    where no kept feature differs."""
    def make():
        own, swap = Presence(features), swaps(groups)

        def work(c):
            out = {"label": c["toxic"], "held": [], "left": [], "right": []}
            for body in c["body"]:
                words = words_of(body)
                pair = pair_of(body, words, swap)
                left, right = (sorted(own(w)) for w in pair) if pair else (None, None)
                if left == right:
                    left = right = None
                for k, v in zip(("held", "left", "right"), (sorted(own(words)), left, right)):
                    out[k].append(v)
            return out
        return work

    return map_columns(texts, "label int, held array<int>, left array<int>, right array<int>", make)


def fit(labels: np.ndarray, held: list, pairs: list, n_features: int, counterfactual: float = COUNTERFACTUAL,
        ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on all rows: log loss, half the squared weights by `ridge`, and the mean squared
    difference of the two scores (between 0 and 1) of a pair by `counterfactual`.

    Both labels weigh the same. Rows come sorted, so that the result does not depend on their order.
    """
    def sparse(rows):
        return (np.repeat(np.arange(len(rows)), [len(r) for r in rows]),
                np.array([i for r in rows for i in r], dtype=np.int64))

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    n, k = len(labels), len(pairs)
    row, column = sparse(held)
    row_a, column_a = sparse([a for a, _ in pairs])
    row_b, column_b = sparse([b for _, b in pairs])
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / n
    w, b = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        logit = np.bincount(row, w[column], n) + b
        error = weight * (sigmoid(logit) - labels)
        grad, grad_b = np.bincount(column, error[row], n_features) + ridge * w, error.sum()
        if k:
            one = sigmoid(np.bincount(row_a, w[column_a], k) + b)
            other = sigmoid(np.bincount(row_b, w[column_b], k) + b)
            pull = 2 * counterfactual * (one - other) / k
            pull_a, pull_b = pull * one * (1 - one), pull * other * (1 - other)
            grad += np.bincount(column_a, pull_a[row_a], n_features) - np.bincount(column_b, pull_b[row_b], n_features)
            grad_b += pull_a.sum() - pull_b.sum()
        full = np.append(grad, grad_b)
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full ** 2
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, groups=GROUPS,
          counterfactual: float = COUNTERFACTUAL, most: int = MOST_KEPT, least_texts: int = LEAST_TEXTS,
          least_chi: float = LEAST_CHI) -> tuple[list[str], np.ndarray, float]:
    """Features, weights and bias. What is collected is bounded by `sample` and `most`."""
    texts = store_of(docs, "toxicity").keep(sampled(docs, labels, sample), "texts")
    features = select_features(texts, most, least_texts, least_chi)
    if not features:
        return [], np.zeros(0), -1.0
    rows = sorted((r.label, r.held, r.left or [], r.right or []) for r in train_rows(texts, features, groups).collect())
    w, b = fit(np.array([r[0] for r in rows], dtype=float), [r[1] for r in rows],
               [r[2:] for r in rows if r[2] != r[3]], len(features), counterfactual)
    return features, w, b


def score(docs: DataFrame, model: tuple[list[str], np.ndarray, float]) -> DataFrame:
    """doc_id and score of every row."""
    features, w, b = model
    weights = w.tolist()

    def make():
        own = Presence(features)

        def work(c):
            logits = [b + math.fsum(weights[i] for i in own(words_of(t))) for t in c["body"]]
            return {"doc_id": c["doc_id"], "score": [1 / (1 + math.exp(-max(-30, min(30, x)))) for x in logits]}
        return work

    return map_columns(docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")), "doc_id long, score double", make)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
