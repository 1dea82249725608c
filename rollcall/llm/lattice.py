"""LM scoring: the marginal probability of a document over all its splits into pieces of a subword lattice.

A word's lattice holds every way to split it into pieces of an existing vocabulary, whose scores weight the pieces; the
forward recursion sums over all of them, on logarithms where a product could leave the range of doubles. One pass of expectation-maximisation over the training words adds
their expected piece counts to those weights. `score` is the sum of the logarithms of a text's words and its end: since
no piece crosses a word's border, that is the marginal probability of the text over all its segmentations.

`mixture_score` is a second model, in which the marginal is the prior of the words counted over the training documents:
P(word) = (count + types * lattice) / (tokens + types).

Words are counted per batch before they are shuffled. The `frequent` most frequent words, a fixed number, go to every
task; a document's other words are joined with the stored vocabulary, which is never held in one place.

Defined cases: a null or empty text is its end alone. Without training rows every word has its prior. A null doc_id is
hashed as the text "null". Repeated rows are scored each. An empty table gives an empty table. Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import TEXT_BYTES, map_columns, store_of

#: Words that every task is given; a bound on what is broadcast, whatever the corpus.
FREQUENT = 50_000
#: Prior share of a text's end among tokens, and of single bytes among pieces.
END_SHARE, BYTE_SHARE = 1 / 1024, 1 / 1024
#: Pieces that the vocabulary's own scores count for, next to those expected in the training words.
SCORE_PIECES = 1000.0
#: Stands for a character spelled in bytes among expected pieces.
BYTES = ""
WORD_START = "▁"
LN10 = math.log(10)
#: Products stay above exp of this, far from the least double.
LEAST_LOG = -600.0


class Lattice:
    """Pieces with log weights, and the marginal of a word over all its segmentations."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.pieces, self.byte = pieces, byte
        # every beginning of a piece, so that a search stops where no piece goes on
        self.beginnings: dict[str, float | None] = {p[:k]: None for p in pieces for k in range(1, len(p))} | pieces
        # the same as shares, where a mere beginning has none
        self.shares = {p: 0.0 if w is None else math.exp(w) for p, w in self.beginnings.items()}
        self.spelled = [math.exp(byte * n) for n in range(5)]
        #: Bytes of a text up to which its products are not too small; spelling it in bytes is the least of its sums.
        self.longest = int(LEAST_LOG / byte)

    @classmethod
    def from_file(cls, path: str) -> Lattice:
        """Weights from a sentencepiece model. A merge model's score is minus the rank of the piece, so that by
        Zipf's law its weight is 1 / (rank + 2)."""
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(own.get_piece_size())
               if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i) or own.is_unused(i))]
        weights = {own.id_to_piece(i): 1 / (2 - min(own.get_score(i), 0.0)) for i in ids}
        total = math.log(sum(weights.values())) - math.log1p(-BYTE_SHARE)
        return cls({p: math.log(w) - total for p, w in weights.items()}, math.log(BYTE_SHARE / 256))

    def _forward(self, text: str) -> tuple[list[float], list[list[tuple[int, str, float]]]]:
        """Log sums over all segmentations of each prefix; and per end the pieces there: start, piece, log sum."""
        n, get, byte, exp = len(text), self.beginnings.get, self.byte, math.exp
        forward: list[float] = [0.0]
        ending: list[list] = [[] for _ in range(n + 1)]
        for start in range(n):
            if start:
                terms = ending[start]
                if len(terms) == 1:
                    forward.append(terms[0][2])
                else:
                    most = max([t[2] for t in terms])
                    forward.append(most + math.log(sum([exp(t[2] - most) for t in terms])))
            here, end = forward[start], start + 1
            ending[end].append((start, BYTES, here + byte * len(text[start].encode())))
            while end <= n and (weight := get(piece := text[start:end], BYTES)) is not BYTES:
                if weight is not None:
                    ending[end].append((start, piece, here + weight))
                end += 1
        most = max(t[2] for t in ending[n])
        forward.append(most + math.log(sum([exp(t[2] - most) for t in ending[n]])))
        return forward, ending

    def log_marginal(self, word: str) -> float:
        """Natural logarithm of the summed probability of all segmentations. A character may also be its bytes."""
        text = WORD_START + word
        if self._is_long(text):
            return self._log_marginal_long(text)
        get, n = self.shares.get, len(text)
        sums = [0.0] * (n + 1)
        sums[0] = 1.0
        for start, spelled in enumerate(self._spellings(text)):
            here = sums[start]
            sums[start + 1] += here * spelled
            for end in range(start + 1, n + 1):
                share = get(text[start:end])
                if share is None:
                    break
                sums[end] += here * share
        return math.log(sums[n])

    def _is_long(self, text: str) -> bool:
        return 4 * len(text) > self.longest and len(text.encode()) > self.longest

    def _spellings(self, text: str) -> list[float]:
        """Per character, the probability of its bytes."""
        spelled = self.spelled
        return [spelled[1] if c < "\x80" else spelled[len(c.encode())] for c in text]

    def _log_marginal_long(self, text: str) -> float:
        """The recursion of `_forward`, without a record of the pieces."""
        get, byte, exp = self.beginnings.get, self.byte, math.exp
        n = len(text)
        terms: list[list[float]] = [[] for _ in range(n + 1)]
        terms[0].append(0.0)
        for start in range(n + 1):
            here = terms[start]
            if len(here) == 1:
                total = here[0]
            else:
                most = max(here)
                total = most + math.log(sum([exp(t - most) for t in here]))
            if start == n:
                return total
            end = start + 1
            terms[end].append(total + byte * len(text[start].encode()))
            while end <= n and (weight := get(text[start:end], BYTES)) is not BYTES:
                if weight is not None:
                    terms[end].append(total + weight)
                end += 1

    def expect(self, word: str, into: dict[str, float], times: float = 1.0) -> None:
        """Adds the pieces that `times` segmentations, drawn by their probability, are expected to hold."""
        text = WORD_START + word
        if self._is_long(text):
            return self._expect_long(text, into, times)
        get, seen, n = self.shares.get, into.get, len(text)
        sums = [0.0] * (n + 1)
        sums[0] = 1.0
        steps = []
        for start, spelled in enumerate(self._spellings(text)):
            here = sums[start]
            sums[start + 1] += here * spelled
            steps.append((start, start + 1, BYTES, spelled))
            for end in range(start + 1, n + 1):
                share = get(piece := text[start:end])
                if share is None:
                    break
                if share:
                    sums[end] += here * share
                    steps.append((start, end, piece, share))
        # from the end: what follows each place, as a share of the whole
        after = [0.0] * (n + 1)
        after[n] = times / sums[n]
        for start, end, piece, share in reversed(steps):
            part = share * after[end]
            after[start] += part
            part *= sums[start]
            if part > 1e-12:  # what is below adds nothing to counts that are rounded to a millionth
                into[piece] = seen(piece, 0.0) + part

    def _expect_long(self, text: str, into: dict[str, float], times: float) -> None:
        forward, ending = self._forward(text)
        share, exp = [0.0] * len(forward), math.exp
        share[-1] = times
        for end in range(len(forward) - 1, 0, -1):
            whole, total = share[end], forward[end]
            if whole > 1e-9:  # what is below adds nothing to counts that are rounded to a millionth
                for start, piece, term in ending[end]:
                    part = whole * exp(term - total)
                    share[start] += part
                    into[piece] = into.get(piece, 0.0) + part

    def refitted(self, expected: dict[str, float]) -> Lattice:
        """Weights from the expected counts, with the present weights as SCORE_PIECES further pieces."""
        total = sum(expected.values()) + SCORE_PIECES
        # bytes keep at least their present share
        return Lattice({p: math.log((expected.get(p, 0.0) + SCORE_PIECES * math.exp(w)) / total)
                        for p, w in self.pieces.items()}, self.byte)


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice.from_file(path)


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds == fold


def count_words(texts: DataFrame) -> DataFrame:
    """word, count in training rows; a word that only held-out rows have counts 0. Takes held_out and body."""
    def make():
        def work(c):
            counts = Counter()
            for out, body in zip(c["held_out"], c["body"]):
                if not out:
                    counts.update(body.lower().split())
            for out, body in zip(c["held_out"], c["body"]):
                if out:
                    counts.update(dict.fromkeys(body.lower().split(), 0))
            return {"word": list(counts), "count": list(counts.values())}
        return work

    return map_columns(texts.select("held_out", "body"), "word binary, count long", make).groupBy("word").agg(
        F.sum("count").alias("count"))


def refit(counts: DataFrame, path: str) -> Lattice:
    """The lattice after one pass over all training words, each as often as it occurs. One row per piece reaches the
    driver."""
    def make():
        own = lattice(path)

        def work(c):
            into: dict[str, float] = {}
            for word, times in zip(c["word"], c["count"]):
                own.expect(word.decode(), into, times)
            return {"piece": list(into), "times": list(into.values())}
        return work

    words = counts.where("count > 0")
    expected = (map_columns(words, "piece string, times double", make)
                .groupBy("piece").agg(F.sum("times").alias("times")))
    return lattice(path).refitted({r.piece: round(r.times, 6) for r in expected.collect()})


def with_prior(counts: DataFrame, own: Lattice) -> DataFrame:
    """Adds `prior`: the natural logarithm of the lattice marginal, less the share of ends."""
    def make():
        rest = math.log1p(-END_SHARE)

        def work(c):
            return c | {"prior": [own.log_marginal(w.decode()) + rest for w in c["word"]]}
        return work

    return map_columns(counts, "word binary, count long, prior double", make)


def score_texts(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and mixture_score of every row."""
    store = store_of(docs, "lattice")
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.expr(TEXT_BYTES).alias("body"))
    counts = store.keep(count_words(texts), "counts")
    vocabulary = store.keep(with_prior(counts, refit(counts, path)), "vocabulary")
    ends = texts.where("NOT held_out").count()
    words, types = vocabulary.agg(F.coalesce(F.sum("count"), F.lit(0)),
                                  F.count(F.when(F.col("count") > 0, 1))).first()
    tokens, types = words + ends, types + (ends > 0)
    base_rest, model_rest = math.log10(tokens + types + 1), math.log10(tokens + max(types, 1))

    def scores(count: Column, prior: Column) -> list[Column]:
        return [F.log10(count + 1.0) - base_rest,
                F.log10(count + max(types, 1) * F.exp(prior)) - model_rest]

    # a prior too small for a double would be zero; such a word is scored from its logarithm alone
    base, mixture = scores(F.col("count"), F.col("prior"))
    mixture = F.when((F.col("count") == 0) & (F.col("prior") < -600),
                     F.col("prior") / LN10 + math.log10(max(types, 1)) - model_rest).otherwise(mixture)
    vocabulary = vocabulary.select("word", (F.col("count") > 0).cast("long").alias("known"), base.alias("base"),
                                   (F.col("prior") / LN10).alias("marginal"), mixture.alias("mixture"), "count")
    top = vocabulary.orderBy(F.desc("count"), "word").limit(frequent).drop("count").collect()
    # place 0 stands for words that are not there
    places = {bytes(r.word): i for i, r in enumerate(top, 1)}
    values = np.array([(0, 0, 0, 0), *[(r.known, r.base, r.marginal, r.mixture) for r in top]], dtype=np.float64)
    shared = store.spark.sparkContext.broadcast((places, values))
    end_base = math.log10(ends + 1) - base_rest
    end_marginal = math.log10(END_SHARE)
    end_mixture = math.log10(ends + max(types, 1) * END_SHARE) - model_rest

    def make():
        own, worth = shared.value
        place = own.get

        def work(c):
            out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "mixture_score")}
            borders, words_left, times_left = [0], [], []
            for body in c["body"]:
                words = body.lower().split()
                at = np.fromiter(map(place, words, repeat(0)), np.int32, len(words))
                known, base, marginal, mixture = worth[at].sum(axis=0).tolist()
                for k, v in zip(out, (1 + len(words), int(ends > 0) + int(known), end_base + base,
                                      end_marginal + marginal, end_mixture + mixture)):
                    out[k].append(v)
                rare = Counter([words[i] for i in np.flatnonzero(at == 0).tolist()])
                words_left += rare
                times_left += rare.values()
                borders.append(len(words_left))
            rare = pa.StructArray.from_arrays([pa.array(words_left, pa.binary()), pa.array(times_left, pa.int64())],
                                              ["word", "times"])
            out["rare"] = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), rare)
            return {"row": c["row"], "doc_id": c["doc_id"], "held_out": c["held_out"]} | out
        return work

    rows = map_columns(
        texts.withColumn("row", F.monotonically_increasing_id()),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
        "mixture_score double, rare array<struct<word: binary, times: long>>", make)
    rows = store.keep(rows, "rows")
    rare = (rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
            .join(vocabulary.drop("count"), "word")
            .groupBy("row").agg(*[F.sum(F.col("times") * F.col(c)).alias(f"rare_{c}")
                                  for c in ("known", "base", "marginal", "mixture")]))

    def total(column: str, more: str) -> Column:
        # sums of doubles differ in their last digits with the order of rows
        value = F.col(column) + F.coalesce(F.col(more), F.lit(0))
        return (value if column == "n_known" else F.round(value, 6)).alias(column)

    return rows.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", total("n_known", "rare_known"), F.lit(tokens).cast("long")
        .alias("train_tokens"), total("base_score", "rare_base"), total("score", "rare_marginal"),
        total("mixture_score", "rare_mixture"))
