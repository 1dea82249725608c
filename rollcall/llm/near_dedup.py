"""MinHash near-dedup with sequential Bayesian verification.

1. A text becomes the set of its distinct word shingles, as 64-bit hashes. Texts with equal sets are one class; only
   classes go on, so copies are never compared.
2. Classes are put into buckets by bands of their MinHash signature. At similarity 0.85, a pair misses all 20 bands of
   4 hashes with a chance of 4e-7, at 0.8 with 3e-5 (24 bands, the default at 0.8, bring it to 4e-6).
3. In each bucket every class is paired with the bucket's smallest. A pair's signatures are compared batch by batch; it
   is dropped once the posterior chance that its similarity reaches the threshold falls below MISS, given the matches
   so far and a uniform prior. Survivors are verified on their full sets. Components of the links come next.
4. A bucket of three or more that still holds different components is compared whole, in blocks: block pairs are rows
   of their own, a block holds about BLOCK classes, pairs of one component are skipped, the others go through the same
   two tests. Blocks are sorted by set size, and block pairs whose sizes rule out a link are not made; nor are those
   inside the bucket's largest component. So no bucket is cut, and only links that tie components together leave a
   task.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing, not even with another
such text. Repeated rows and rows that share a doc_id are rows of their own; equal sets are linked. A null doc_id comes
after all others; a component without any doc_id has a null component_id and keeps its rows. An empty table gives an
empty table. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import TEXT_BYTES, Memo, components, map_columns, session_of, store_of
from rollcall.sources import Store

ROWS_PER_BAND = 4
#: Rows with texts, signatures or sets that a task takes at once.
SLICE = 500
#: Hashes compared at a time, and the posterior chance of a link below which a pair is dropped.
BATCH, MISS = 8, 1e-9
BLOCK = 512
SEED = 0x9E3779B97F4A7C15
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    for factor in _MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingles(words: list[bytes], width: int, numbers: Memo) -> np.ndarray:
    """Sorted distinct hashes of the shingles; all words as one if they are fewer than `width`."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    a = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    with np.errstate(over="ignore"):
        value = np.full(len(a) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            value = _mixed(value * np.uint64(SEED) + a[k:len(a) - width + 1 + k])
    return np.unique(value)


@lru_cache(maxsize=4)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20260101).integers(0, 1 << 63, size=(2, n), dtype=np.uint64)
    return draw[0][:, None] | np.uint64(1), draw[1][:, None]


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each of n hash functions over the set, 32 bits each."""
    a, b = _multipliers(n)
    out = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for lo in range(0, len(hashes), 1024):
            values = (hashes[None, lo:lo + 1024] * a + b) >> np.uint64(32)
            out = np.minimum(out, values.min(axis=1).astype(np.uint32))
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


@lru_cache(maxsize=8)
def least_matches(percent: int, n: int, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """After each batch of hashes, the fewest matches with which a pair goes on.

    With a uniform prior the posterior of the similarity after m matches of k hashes is Beta(m + 1, k - m + 1); its
    tail above t equals the chance of at most m successes among k + 1 tries with chance t.
    """
    from math import comb

    t, out = percent / 100, []
    for k in range(batch, n + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(k + 1, m) * t ** m * (1 - t) ** (k + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Row numbers of signature pairs (one pair per row) that no batch rules out."""
    left, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, least in enumerate(least_matches(percent, a.shape[1])):
        columns = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + np.count_nonzero(a[left, columns] == b[left, columns], axis=1)
        on = matches >= least
        left, matches = left[on], matches[on]
    return left


def sketched(docs: DataFrame, width: int, n: int, sets: bool) -> DataFrame:
    """doc_id, text_hash, n_shingles, class (16 bytes, null for an empty set), and the signature or, with `sets`, the
    set.

    A class is named by a 128-bit hash of its set.
    """
    def make():
        numbers = Memo(xxhash.xxh3_64_intdigest)

        def work(c):
            out = {"doc_id": c["doc_id"], "text_hash": c["text_hash"], "n_shingles": [], "class": [], "data": []}
            for body in c["body"]:
                found = shingles(body.lower().split(), width, numbers)
                data = found.tobytes()
                out["n_shingles"].append(len(found))
                out["class"].append(hashlib.blake2b(data, digest_size=16).digest() if len(found) else None)
                out["data"].append(data if sets else signature(found, n).tobytes() if len(found) else None)
            return out
        return work

    return map_columns(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.expr(TEXT_BYTES).alias("body")),
                       "doc_id long, text_hash long, n_shingles long, class binary, data binary", make, SLICE)


def _bands(n: int):
    def make():
        def work(c):
            out = {"class": [], "band": [], "bucket": []}
            for name, data in zip(c["class"], c["data"]):
                for band, lo in enumerate(range(0, 4 * n, 4 * ROWS_PER_BAND)):
                    out["class"].append(name)
                    out["band"].append(band)
                    out["bucket"].append(data[lo:lo + 4 * ROWS_PER_BAND])
            return out
        return work
    return make


def _matrix(data, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.uint32).reshape(-1, n)


def _prune(percent: int, n: int):
    def make():
        def work(c):
            on = survivors(_matrix(c["sa"], n), _matrix(c["sb"], n), percent).tolist()
            return {k: [c[k][i] for i in on] for k in ("a", "b")}
        return work
    return make


def _verify(percent: int):
    def make():
        def work(c):
            on = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(c["xa"], c["xb"])]
            return {k: [v for v, good in zip(c[k], on) if good] for k in ("a", "b")}
        return work
    return make


def _with(pairs: DataFrame, data: DataFrame, key: str, name: str) -> DataFrame:
    return pairs.join(data.select(F.col("class").alias(key), F.col("data").alias(name)), key)


def _block_links(percent: int, n: int):
    """Links of one block pair that tie different components together."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, _, cell_a, part_a, cell_b, part_b = key
        names, labels = list(rows["class"]), list(rows["label"])
        sides = rows["side"].to_numpy()
        signatures = _matrix(rows["signature"], n)
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        root = {x: x for x in labels}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        within = (cell_a, part_a) == (cell_b, part_b)
        rights = np.arange(len(names)) if within else np.flatnonzero(sides == 1)
        for i in np.flatnonzero(sides == 0):
            others = rights[rights > i] if within else rights
            others = np.array([j for j in others if find(labels[i]) != find(labels[j])], dtype=np.int64)
            if not len(others):
                continue
            on = survivors(np.broadcast_to(signatures[i], (len(others), n)), signatures[others], percent)
            for j in others[on]:
                if find(labels[i]) != find(labels[j]) and similar(sets[i], sets[j], percent):
                    links.append((names[i], names[j]))
                    root[find(labels[j])] = find(labels[i])
        return pd.DataFrame(links, columns=["a", "b"])
    return run


def _unresolved(members: DataFrame, labels: DataFrame, store: Store) -> DataFrame:
    """Members, with label, of buckets of three or more that hold several components. Of buckets with equal members
    one is left, known by sums over hashes of the members."""
    of = labels.select(F.col("node").alias("class"), "label")
    named = members.join(of, "class", "left").withColumn("label", F.coalesce("label", "class"))
    named = store.keep(named, "named")
    open_ = (named.groupBy("band", "bucket")
             .agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                  F.bit_xor(F.xxhash64("class")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), F.col("class"))).alias("s2"))
             .where("size > 2 AND lo != hi"))
    one = open_.groupBy("size", "s1", "s2").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.*", "size")
    return named.join(store.keep(one, "open"), ["band", "bucket"])


def _blocks(open_members: DataFrame, sizes: DataFrame, percent: int, store: Store) -> DataFrame:
    """One row per member and block pair that it belongs to: band, bucket, ca, pa, cb, pb, side, class, label.

    A bucket of up to BLOCK members is one block. In a larger one a member's level is the logarithm of its set's size,
    in steps that the threshold allows a link to span. Its cell is twice the level, and one more if it is of the
    bucket's largest component; its part is a hash, of as many parts as the cell has times BLOCK members. A block,
    (cell, part), meets every block of its own and of the next level, unless both are of the largest component.
    """
    step = -float(np.log(percent / 100)) * 1.001  # wider than a link can be, whatever the rounding
    ranked = store.keep(open_members.join(sizes, "class"), "ranked")
    span = (ranked.where(F.col("size") > BLOCK).groupBy("band", "bucket", "label")
            .agg(F.count(F.lit(1)).alias("n"), F.min("n_shingles").alias("least"))
            .groupBy("band", "bucket").agg(F.min("least").alias("least"), F.max(F.struct("n", "label")).alias("most"))
            .select("band", "bucket", "least", F.col("most.label").alias("main")))
    span = store.keep(span, "span")  # read anew, so that the join may split a bucket with very many members
    level = F.floor(F.log(F.col("n_shingles") / F.col("least")) / step)
    cell = F.when(F.col("least").isNull(), 0).otherwise(2 * level + (F.col("label") == F.col("main")).cast("int"))
    celled = store.keep(ranked.join(span, ["band", "bucket"], "left").select(
        "band", "bucket", "class", "label", cell.cast("int").alias("cell")), "celled")
    # a bucket has few cells, as many as its sizes span steps
    counts = (celled.groupBy("band", "bucket", "cell").agg(F.count(F.lit(1)).alias("n")).groupBy("band", "bucket")
              .agg(F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("counts")))
    celled = celled.join(store.keep(counts, "counts"), ["band", "bucket"])

    def parts(of: Column) -> Column:
        return F.ceil(F.coalesce(F.try_element_at("counts", of), F.lit(0)) / BLOCK).cast("int")

    def met(other: Column, row) -> Column:
        n = parts(other)
        every = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda q: F.struct(
            *[c.alias(name) for name, c in zip(("ca", "pa", "cb", "pb", "side"), row(q))]))
        return F.slice(every, 1, n)

    here, own = F.col("cell"), F.col("own")
    inside = met(here, lambda q: (here, F.least(own, q), here, F.greatest(own, q),
                                  F.when(own <= q, 0).otherwise(1)))

    def after(k: int) -> Column:
        return met(here + k, lambda q: (here, own, here + k, q, F.lit(0)))

    def before(k: int) -> Column:
        return met(here - k, lambda q: (here - k, q, here, own, F.lit(1)))

    pairs = F.when(here % 2 == 0, F.concat(inside, after(1), after(2), after(3), before(2), before(1))).otherwise(
        F.concat(before(1), after(1), before(3)))
    return (celled.withColumn("own", F.pmod(F.xxhash64("class"), parts(here)).cast("int"))
            .select("band", "bucket", "class", "label", F.explode(pairs).alias("e"))
            .select("band", "bucket", "class", "label", "e.*"))


def link_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int, n: int, store: Store) -> DataFrame:
    """a, b: links between classes whose components are those of all pairs that reach the threshold."""
    banded = map_columns(classes.select("class", "data"), "class binary, band int, bucket binary", _bands(n), SLICE)
    banded = store.keep(banded, "banded")
    buckets = (banded.groupBy("band", "bucket")
               .agg(F.count(F.lit(1)).alias("size"), F.min("class").alias("first")).where("size > 1"))
    members = store.keep(banded.join(buckets, ["band", "bucket"]), "members")

    several = members.select("class").distinct()
    wanted = (several.join(classes.select("class", "first_id"), "class").select(F.col("first_id").alias("doc_id")))
    wanted = store.keep(wanted.distinct(), "wanted").withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = (sketched(texts, width, n, sets=True).where("class IS NOT NULL").select("class", "data")
            .join(several, "class", "left_semi").dropDuplicates(["class"]))
    # with the signatures, so that blocks meet both in one join
    sets = store.keep(sets.join(classes.select("class", F.col("data").alias("signature")), "class"), "sets")

    # the first classes of buckets are few against the members, but one may stand against very many of them
    pairs = (members.where(F.col("class") != F.col("first"))
             .select(F.col("first").alias("a"), F.col("class").alias("b")).distinct())
    near = map_columns(_with(_with(pairs, classes, "a", "sa"), classes, "b", "sb").select("a", "b", "sa", "sb"),
                       "a binary, b binary", _prune(percent, n), SLICE)
    near = store.keep(near, "near")
    checked = map_columns(_with(_with(near, sets, "a", "xa"), sets, "b", "xb").select("a", "b", "xa", "xb"),
                          "a binary, b binary", _verify(percent), SLICE)
    links = store.keep(checked, "links")

    labels = store.keep(components(links, store, "star"), "labels")
    open_members = store.keep(_unresolved(members.drop("size", "first"), labels, store), "open_members")
    if open_members.isEmpty():
        return links
    blocks = _blocks(open_members, classes.select("class", "n_shingles"), percent, store)
    blocks = blocks.join(sets.withColumnRenamed("data", "shingles"), "class")
    more = blocks.groupBy("band", "bucket", "ca", "pa", "cb", "pb").applyInPandas(
        _block_links(percent, n), "a binary, b binary")
    return links.union(store.keep(more, "more_links"))


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, bands: int | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, n_shingles, component (null for an empty set), component_id and
    kept."""
    session_of(docs)
    store = store_of(docs, "near_dedup")
    n = ROWS_PER_BAND * (bands or (20 if percent >= 85 else 24))
    rows = store.keep(sketched(docs, width, n, sets=False), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "data"))
    classes = (rows.where("class IS NOT NULL").groupBy("class", "n_shingles").agg(first.alias("first"))
               .select("class", "n_shingles", F.col("first.doc_id").alias("first_id"), F.col("first.data")))
    classes = store.keep(classes, "classes")
    links = link_classes(docs, classes, width, percent, n, store)
    labels = store.keep(components(links, store, "all"), "components")
    named = (classes.select("class", "first_id").join(labels.withColumnRenamed("node", "class"), "class", "left")
             .select("class", "first_id", F.coalesce("label", "class").alias("component")))
    named = store.keep(named, "classes_named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = store.keep(named.join(least, "component").select("class", "component", "component_id"), "of_class")
    return (rows.drop("data").join(of_class, "class", "left")
            .withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))
                        .otherwise(F.col("component_id")))
            .select("doc_id", "text_hash", "n_shingles", "component", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def kept_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, unchanged, that stay: the smallest doc_id of each component, and all without words.

    Rows are known by doc_id and a hash of the text; rows that repeat both stay or go together.
    """
    stays = near_copies(docs.select("doc_id", "text"), width, percent)
    gone = stays.where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    gone = store_of(docs, "near_dedup").keep(gone, "gone")
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"])
    return docs.join(gone, same, "left_anti")
