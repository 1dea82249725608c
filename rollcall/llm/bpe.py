"""BPE encoding and decoding with a public vocabulary.

A piece's symbols form a doubly linked list. Adjacent pairs wait in a priority queue by merge rank; a pair that is no
longer there when its turn comes is skipped. Decoding joins the vocabulary strings of the ids with spaces, as a
tokenizer without a decoder does.

Defined cases: a null text is an empty one, without tokens. Texts are encoded whole; a piece of any length takes
n log n steps. Rows are encoded one by one, so ties and repeated rows need no rule. An empty table gives an empty
table. Columns other than the text are handed through or left out by the caller.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import TEXT_BYTES, map_columns

#: White space of the pre-tokenizer's `\s`.
SPACE_CLASS = r"\t\n\x0b\x0c\r \x85\p{Z}"


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merges adjacent symbols, lowest rank first and leftmost among equals, until no pair has a rank.

    A queue entry is rank and place as one whole number. Symbols that were merged into their left neighbour are -1.
    """
    n = len(symbols)
    left, right, bits, rank_of = list(range(-1, n - 1)), list(range(1, n + 1)), n.bit_length(), ranks.get
    found = map(rank_of, zip(symbols, symbols[1:]))
    queue = [f[0] << bits | i for i, f in enumerate(found) if f]
    heapify(queue)
    while queue:
        entry = heappop(queue)
        i = entry & (1 << bits) - 1
        j = right[i]
        found = rank_of((symbols[i], symbols[j])) if j < n else None
        if not found or found[0] != entry >> bits:
            continue  # stale: one of the two has been merged since
        merged = symbols[i] = found[1]
        symbols[j] = -1
        right[i] = after = right[j]
        if after < n:
            left[after] = i
            if found := rank_of((merged, symbols[after])):
                heappush(queue, found[0] << bits | i)
        before = left[i]
        if before >= 0 and (found := rank_of((symbols[before], merged))):
            heappush(queue, found[0] << bits | before)
    return [s for s in symbols if s >= 0]


class Ages(dict):
    """A dictionary that computes what it lacks. When full it forgets what was not asked for since it was half full."""

    def __init__(self, compute: Callable, limit: int = 400_000, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest, self.older = compute, limit // 2, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Vocabulary, merges and pre-tokenizer of a tokenizer file of the kind "BPE with word ends"."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, vocab = data["model"], data["model"]["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = self._byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.strings = [strings[i] for i in range(len(strings))]
        steps = data["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"].replace(r"\s", SPACE_CLASS))
        self.marks = tuple({c.encode()[:2] for c in self.special})
        self.pieces = Ages(self._encode_piece)
        self.chunks = Ages(self._encode_chunk)

    @staticmethod
    def _byte_letters() -> list[str]:
        """The printable letter that stands for each byte: itself where it is visible, else the next free one."""
        visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        spare = iter(range(256, 512))
        return [chr(b if b in visible else next(spare)) for b in range(256)]

    def _encode_piece(self, piece: str) -> bytes:
        data = piece.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        ids = array("I", merge(symbols, self.ranks))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _encode_chunk(self, chunk: bytes) -> bytes:
        """Pieces never hold white space, so what stands between white space is encoded by itself."""
        if chunk.isascii() and not any(m in chunk for m in self.marks):  # no characters to compose, nothing special to set apart
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk.decode().lower())))
        out = []
        for part in self.special_split.split(chunk.decode()):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                # final sigma is lower-cased like any other: a tokenizer looks at one character at a time
                text = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += map(self.pieces.__getitem__, self.pattern.findall(text))
        return b"".join(out)

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per Python worker, whose caches outlive a task."""
    return Codec(path)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), texts: bool = False) -> DataFrame:
    """The columns `keep`, n_tokens, ids (little-endian unsigned 32-bit integers) and, if asked for, decoded text.

    `keep` must not name a column that this adds, nor `body`.
    """
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", n_tokens long, ids binary" + ", decoded string" * texts

    def make():
        own = codec(path)

        def work(c):
            ids = [own.encode(t) for t in c["body"]]
            out = {k: c[k] for k in keep} | {"n_tokens": [len(x) // 4 for x in ids], "ids": ids}
            return out | ({"decoded": [own.decode(x) for x in ids]} if texts else {})
        return work

    return map_columns(docs.select(*keep, F.expr(TEXT_BYTES).alias("body")), schema, make)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    def make():
        own = codec(path)

        def work(c):
            ids = [own.encode(t) for t in c["body"]]
            return {"doc_id": c["doc_id"], "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids]}
        return work

    return map_columns(docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")),
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
