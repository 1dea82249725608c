"""Alignment of two tokenizers: which tokens of one cover those of the other, byte by byte.

Both tokenizers cut the same bytes, a space and the text. In every batch the tokens of each side are a frame (document,
start, token); `merge_asof`, keyed by document, finds for each token's start the token of the other side that covers
it. The union of both directions holds exactly the pairs that overlap: of two overlapping tokens the one that starts
later starts inside the other. Pairs that end together are the links; their ends cut a document's tokens into groups.

How often an id pair is linked is counted over all documents. Tokens that end together hold the same last bytes, so
one is a suffix of the other, and the possible id pairs are at most as many as the bytes of both vocabularies, about
half a million. So the counts have a proven bound, whatever the corpus, and are sent whole to the tasks that look up
each document's links.

Defined cases: a null or empty text has no tokens, like one whose tokens of a side do not give back its bytes (a
tokenizer that rewrites characters, or the mark for a space in the text); it has zeros and an empty digest. The strings
of special tokens are plain text. Texts are taken whole, whatever their length; rows one by one, so ties and repeated
rows need no rule, and each of them counts. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.bpe import Codec
from rollcall.llm.common import session_of, store_of

#: Bytes of text whose tokens are aligned at once; a longer text is taken alone.
CHUNK = 1 << 18


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def gathered(strings: pa.Array, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The strings at these places, one behind the other, and where each begins; the end comes last."""
    taken = strings.take(pa.array(at))
    _, starts, data = taken.buffers()
    starts = np.frombuffer(starts, np.int64)[:len(at) + 1] if len(at) else np.zeros(1, np.int64)
    return (data.to_pybytes() if data else b""), starts


class Side:
    """A tokenizer: `ids` of texts, and the bytes of every id."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.lengths = np.array(list(map(len, strings)), np.int64)
        self.held = pa.array(strings, pa.large_binary())

    def whole(self, ids: np.ndarray, counts: np.ndarray, bodies: list[bytes]) -> list[bool]:
        """Whether the tokens of each text give back its bytes."""
        data, starts = gathered(self.held, ids)
        cuts = starts[borders(counts)].tolist()
        return [data[i:j] == body for i, j, body in zip(cuts, cuts[1:], bodies)]


class ByteSide(Side):
    """Byte-level BPE of a tokenizer file. Its merges are numbered in the order of the ids that they make."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = {c: b for b, c in enumerate(Codec._byte_letters())}
        special = {t["id"] for t in data["added_tokens"]}
        ranks = {bytes(letters[c] for c in s): i for s, i in data["model"]["vocab"].items() if i not in special}
        strings = {i: s for s, i in ranks.items()}
        super().__init__([strings.get(i, b"") for i in range(max(strings) + 1)])
        self.own = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.own.encode_ordinary(" " + t) for t in texts]


class PieceSide(Side):
    """Pieces with U+2581 for a space, which the model puts before a text, and single bytes as <0xHH>."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([
            bytes([int(self.own.id_to_piece(i)[3:-1], 16)]) if self.own.is_byte(i)
            else self.own.id_to_piece(i).replace("▁", " ").encode() for i in range(self.own.get_piece_size())])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def sides(byte_path: str, piece_path: str) -> tuple[ByteSide, PieceSide]:
    """Loaded once per Python worker."""
    return ByteSide(byte_path), PieceSide(piece_path)


@lru_cache(maxsize=2)
def group_parts(n_a: int, n_b: int) -> pa.Array:
    """Every id as it stands in the text of groups: of A inside and at the end of its side, then of B."""
    return pa.array([f"{i}{end}".encode() for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)],
                    pa.large_binary())


def joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and how many each has."""
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, counts.sum()), counts


def borders(counts: np.ndarray) -> np.ndarray:
    """Where the tokens of each text begin among all; the end comes last."""
    return np.concatenate([[0], np.cumsum(counts)])


def tokens_of(side: Side, ids: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """doc, id, start, end and the token's number, of documents whose bytes stand one behind the other."""
    lengths = side.lengths[ids]
    ends = np.cumsum(lengths)
    return pd.DataFrame({"doc": np.repeat(np.arange(len(counts)), counts), "start": ends - lengths, "end": ends,
                         "id": ids, "number": np.arange(len(ids))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Numbers a and b of all pairs of tokens that share a byte, each once, in order.

    Both ways find a pair that starts together, so the second gives only those whose B token starts later. Each way
    finds its pairs in order, which leaves two runs to merge.
    """
    left = a[["doc", "start", "number"]].rename(columns={"number": "a"})
    right = b[["doc", "start", "number"]].rename(columns={"number": "b"})
    to_b, to_a = (pd.merge_asof(x, y, on="start", by="doc") for x, y in ((left, right), (right, left)))
    later = to_a["start"].to_numpy() > a["start"].to_numpy()[to_a["a"].to_numpy()]
    code = np.concatenate([each["a"].to_numpy() * (len(b) + 1) + each["b"].to_numpy()
                           for each in (to_b, to_a[later])])
    code.sort(kind="stable")
    return pd.DataFrame({"a": code // (len(b) + 1), "b": code % (len(b) + 1)})


def links_of(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """The overlapping pairs that end together."""
    pairs = overlaps(a, b)
    same = a["end"].to_numpy()[pairs["a"]] == b["end"].to_numpy()[pairs["b"]]
    return pairs[same]


def group_texts(first: ByteSide, second: PieceSide, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray,
                cut_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3;`: the ids of both sides by group, and where each begins. The cuts are the numbers of each
    group's last tokens."""
    before_a, before_b = (np.concatenate([[0], cut + 1])[:-1] for cut in (cut_a, cut_b))
    place_a = np.arange(len(a)) + np.repeat(before_b, cut_a + 1 - before_a)
    place_b = np.arange(len(b)) + np.repeat(cut_a + 1, cut_b + 1 - before_b)
    n_a, n_b = len(first.strings), len(second.strings)
    at = np.empty(len(a) + len(b), np.int64)
    at[place_a], at[place_b] = a, b + 2 * n_a
    at[place_a[cut_a]] += n_a
    at[place_b[cut_b]] += n_b
    return gathered(group_parts(n_a, n_b), at)


def aligned_chunk(first: ByteSide, second: PieceSide, texts: list[str]) -> tuple[list[tuple], list[np.ndarray]]:
    """n_a, n_b, n_groups, n_links and groups_sha256 of every text, and the codes of its links."""
    bodies = [b" " + text.encode() for text in texts]
    found_a, found_b = joined(first.ids(texts)), joined(second.ids(texts))
    good = np.array([*map(bool, texts)]) & first.whole(*found_a, bodies) & second.whole(*found_b, bodies)
    n_a, n_b = (np.where(good, counts, 0) for _, counts in (found_a, found_b))
    a, b = (tokens_of(side, ids[np.repeat(good, counts)], n)
            for side, (ids, counts), n in ((first, found_a, n_a), (second, found_b, n_b)))
    links = links_of(a, b)
    id_a, id_b = a["id"].to_numpy(), b["id"].to_numpy()
    link_a, link_b = links["a"].to_numpy(), links["b"].to_numpy()
    codes = (id_a[link_a] * len(second.strings) + id_b[link_b]).astype(np.int32)
    from_a, from_b = borders(n_a), borders(n_b)
    cut = np.searchsorted(link_a, from_a).tolist()  # links come in the order of their A tokens
    data, starts = group_texts(first, second, id_a, id_b, link_a, link_b)
    ends = starts[from_a + from_b].tolist()
    rows, out = [], []
    for k, (n, m) in enumerate(zip(n_a.tolist(), n_b.tolist())):
        held = cut[k + 1] - cut[k]
        digest = sha256(data[ends[k]:ends[k + 1] - 1]).hexdigest() if held else ""
        rows.append((n, m, held, held, digest))
        out.append(codes[cut[k]:cut[k + 1]])
    return rows, out


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most CHUNK bytes of text, or of one row."""
    first, size = 0, 0
    sizes = batch["size"].to_pylist()
    for k, n in enumerate(sizes):
        if k > first and size + n > CHUNK:
            yield batch.slice(first, k - first)
            first, size = k, 0
        size += n
    if first < len(sizes):
        yield batch.slice(first)


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and links (id of A * vocabulary of B + id of B), per row."""
    session_of(docs)
    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = sides(byte_path, piece_path)
        if len(first.strings) * len(second.strings) >= 2 ** 31:
            raise ValueError("pairs of these vocabularies need more than 31 bits")
        for batch in batches:
            for chunk in chunks(batch):
                rows, links = aligned_chunk(first, second, chunk["text"].to_pylist())
                numbers = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
                offsets = np.concatenate([[0], np.cumsum(list(map(len, links)))])
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(links)))
                yield pa.RecordBatch.from_arrays(
                    [chunk["doc_id"], *numbers, pa.array([r[4] for r in rows]),
                     listed.cast(arrow.field("links").type)], schema=arrow)

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.octet_length(text).alias("size")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """link, count and best (no pair with the same B id counts more), over all documents."""
    counts = aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("link") % n_b))
    return counts.select("link", "count", (F.col("count") == most).alias("best"))


def alignment_digests(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """`align` without the links, but with n_best and count_sum."""
    store = store_of(docs, "alignment")
    aligned = store.keep(align(docs, byte_path, piece_path), "aligned")
    counts = store.keep(pair_counts(aligned, len(sides(byte_path, piece_path)[1].strings)), "counts")
    known = counts.toPandas().sort_values("link")  # bounded by the vocabularies, see above
    session = docs.sparkSession.sparkContext
    sent = session.broadcast((known["link"].to_numpy(np.int32), known["count"].to_numpy(np.int64),
                              known["best"].to_numpy(bool)))
    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, count, best = sent.value
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                lengths = part["links"].value_lengths().to_numpy(zero_copy_only=False)
                at = np.searchsorted(link, part["links"].flatten().to_numpy())
                ends = np.cumsum(lengths)
                sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (best.astype(np.int64), count)]
                n_best, count_sum = (s[ends] - s[ends - lengths] for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                    + [pa.array(n_best), pa.array(count_sum), part["groups_sha256"]], schema=arrow)

    return aligned.mapInArrow(look_up, schema)
