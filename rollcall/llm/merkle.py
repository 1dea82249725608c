"""Merkle manifest of a dataset: hash trees over the rows of each source, and one over the sources.

A tree is cut into aligned subtrees ("blocks") of at most FAN ** HEIGHT leaves. A block is one row, whose nodes lie in
one byte string in van Emde Boas order: a subtree is split at half of its levels, the upper half comes first, then the
lower subtrees one after the other, each laid out in the same way. `address` finds a node from its depth and number, so
construction and the retrieval of siblings need no pointers and touch few places at any size of cache. The roots of a
tier of blocks are the leaves of the next tier, until every tree has one block; each tier is a stored table. Siblings
are fetched from the top tier down, by one join per tier on the block's number.

A leaf hashes doc_id, source, lang, n_chars and text, an inner node the hexadecimal digests of its at most FAN
children. Leaves of a source ascend by doc_id.

Defined cases: a null value counts as "-", so it differs from an empty text. A null source is a tree of its own and the
first. Null doc_ids come first; rows that share a doc_id are ordered by their digests, and equal rows are leaves beside
each other. A tree of one leaf has that leaf as its root, and a proof without siblings. A hot source is spread over
tasks by ranges and blocks. An empty table has no leaves and no root, and gives an empty table. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.common import running, session_of, store_of
from rollcall.sources import Store

#: Children of a node; levels above the leaves that a block covers.
FAN, HEIGHT = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BYTES = 32


# --- layout

def size_of(levels: int) -> int:
    """Nodes of a full tree with so many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, number: int) -> int:
    """Where the layout of a tree with `levels` levels holds the node `number` of the level `depth` below the root."""
    place = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower, below = levels - upper, FAN ** (depth - upper)
        place += size_of(upper) + number // below * size_of(lower)
        levels, depth, number = lower, depth - upper, number % below
    return place


@cache
def places(levels: int) -> list[list[int]]:
    """Byte offsets of the nodes of each depth."""
    return [[BYTES * address(levels, depth, i) for i in range(FAN ** depth)] for depth in range(levels)]


def climbs(block: int, leaves: int, full: int = HEIGHT) -> int:
    """Levels above the leaves that a block covers: all, but for the only block of a small tree."""
    height = 0
    while FAN ** height < leaves:
        height += 1
    return full if block else height


def node(digests: list[bytes]) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def lay_out(block: int, leaves: list[bytes], full: int = HEIGHT) -> bytes:
    """The nodes of a block; what a last block lacks stays zero."""
    height = climbs(block, len(leaves), full)
    at, out, level = places(height + 1), bytearray(BYTES * size_of(height + 1)), leaves
    for depth in range(height, -1, -1):
        for place, digest in zip(at[depth], level):
            out[place:place + BYTES] = digest
        if depth:
            level = [node(level[i:i + FAN]) for i in range(0, len(level), FAN)]
    return bytes(out)


def siblings(nodes: bytes, height: int, leaves: int, number: int) -> bytes:
    """The way up from a leaf: per level a byte (place * 16 + length of the run), then the run's other digests."""
    at, out, width = places(height + 1), [], leaves
    for depth in range(height, 0, -1):
        first = number - number % FAN
        run = range(first, min(first + FAN, width))
        out.append(bytes([(number - first) * 16 + len(run)]))
        out += [nodes[at[depth][i]:at[depth][i] + BYTES] for i in run if i != number]
        number, width = number // FAN, -(-width // FAN)
    return b"".join(out)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place in the run and the others of the run, level by level."""
    at = 0
    while at < len(path):
        place, others = path[at] >> 4, (path[at] & 15) - 1
        yield place, [path[at + 1 + k * BYTES:at + 1 + (k + 1) * BYTES] for k in range(others)]
        at += 1 + others * BYTES


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, others in steps(path):
        leaf = node([*others[:place], leaf, *others[place:]])
    return leaf


def proof_digest(path: bytes) -> str:
    return node([d for _, others in steps(path) for d in others]).hex()


# --- construction

def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column] | None = None) -> Column:
    """Digest of a row as bytes; `columns` replaces some of FIELDS."""
    given = {f: F.col(f) for f in FIELDS} | (columns or {})
    return F.unhex(F.sha2(F.concat(*[field(given[f]) for f in FIELDS]), 256))


def source_key() -> Column:
    """The source as a text that is never null and in the same order, the null source first."""
    return F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))


def blocks(leaves: DataFrame, full: int) -> DataFrame:
    """tree, block, n, nodes and items: from leaves (tree, pos, leaf, item). A group has FAN ** full rows at most."""
    session_of(leaves)
    each = F.sort_array(F.collect_list(F.struct("pos", "leaf", "item")))
    grouped = (leaves.groupBy("tree", F.expr(f"pos DIV {FAN ** full}").alias("block")).agg(each.alias("rows"))
               .select("tree", "block", "rows.leaf", F.col("rows.item").alias("items")))
    schema = ("tree string, block long, n int, nodes binary, items "
              + grouped.schema["items"].dataType.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, block = batch["leaf"].to_pylist(), batch["block"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch["tree"], batch["block"], pa.array(map(len, leaf), pa.int32()),
                 pa.array([lay_out(k, each, full) for k, each in zip(block, leaf)], pa.binary()), batch["items"].cast(arrow.field("items").type)],
                schema=arrow)

    return grouped.mapInArrow(build, schema)


def root_of() -> Column:
    """A layout begins with its root."""
    return F.expr(f"substring(nodes, 1, {BYTES})")


def tiers(leaves: DataFrame, store: Store, name: str, full: int) -> list[DataFrame]:
    """The stored blocks of every tier, from the leaves up; in the last one every tree has one block."""
    out = [store.keep(blocks(leaves, full), f"{name}_0")]
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = out[-1].select("tree", F.col("block").alias("pos"), root_of().alias("leaf"),
                               F.lit(None).cast("int").alias("item"))
        out.append(store.keep(blocks(above, full), f"{name}_{len(out)}"))
    return out


@dataclass
class Manifest:
    """Tiers of the trees of the sources, and of the tree over the sources, whose items are the sources' keys."""

    rows: list[DataFrame]
    sources: list[DataFrame]
    height: int

    def root(self) -> DataFrame:
        """One row with the root as hexadecimal text; none for an empty table."""
        return self.sources[-1].select(F.lower(F.hex(root_of())).alias("root"))


def manifest(leaves: DataFrame, store: Store, height: int = HEIGHT) -> Manifest:
    """Of leaves (source, doc_id, leaf, item), whatever their items are; blocks have FAN ** height leaves."""
    keyed = leaves.select(source_key().alias("tree"), "doc_id", "leaf", "item",
                          F.monotonically_increasing_id().alias("tie"), F.lit(1).alias("one"))
    placed = running(keyed, store, ["tree"], ["doc_id", "leaf", "tie"], "one", "pos")
    rows = tiers(placed.select("tree", "pos", "leaf", "item"), store, "rows", height)
    subroots = rows[-1].select(F.lit("").alias("tree"), F.col("tree").alias("item"), root_of().alias("leaf"),
                               F.lit(1).alias("one"))
    numbered = running(subroots, store, ["tree"], ["item"], "one", "pos")
    return Manifest(rows, tiers(numbered.select("tree", "pos", "leaf", "item"), store, "sources", height), height)


# --- proofs

def descend(tier: DataFrame, above: DataFrame, carried: str, full: int) -> DataFrame:
    """tree, pos, leaf, item, path and what is `carried`, of every leaf of a tier. `above` has tree, block, path and
    what is carried, one row per block."""
    names = [x.split()[0] for x in carried.split(",")]
    item = tier.schema["items"].dataType.elementType.simpleString()
    schema = f"tree string, pos long, leaf binary, item {item}, path binary, {carried}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                tree, block, n, nodes, path = (one[c][0].as_py() for c in ("tree", "block", "n", "nodes", "path"))
                height = climbs(block, n, full)
                low = places(height + 1)[height]
                columns = {
                    "tree": [tree] * n, "pos": range(block * FAN ** full, block * FAN ** full + n),
                    "leaf": [nodes[p:p + BYTES] for p in low[:n]], "item": one["items"].flatten(),
                    "path": [siblings(nodes, height, n, i) + path for i in range(n)]
                } | {c: [one[c][0].as_py()] * n for c in names}
                yield pa.RecordBatch.from_arrays(
                    [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type)
                     for f, v in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return tier.join(above, ["tree", "block"]).mapInArrow(fetch, schema)


def proofs(found: Manifest, store: Store) -> DataFrame:
    """item, leaf, path, subroot and root of every leaf."""
    top = found.sources[-1].select("tree", "block", F.lit(b"").alias("path"), root_of().alias("root"))
    for k in range(len(found.sources) - 1, -1, -1):
        top = descend(found.sources[k], top, "root binary", found.height)
        if k:
            top = store.keep(top.select("tree", F.col("pos").alias("block"), "path", "root"), f"way_sources_{k}")
    carried = "subroot binary, root binary"
    way = store.keep(top.select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("block"), "path",
                                F.col("leaf").alias("subroot"), "root"), "way_sources_0")
    for k in range(len(found.rows) - 1, 0, -1):
        way = store.keep(descend(found.rows[k], way, carried, found.height).select(
            "tree", F.col("pos").alias("block"), "path", "subroot", "root"), f"way_rows_{k}")
    return descend(found.rows[0], way, carried, found.height).select("item", "leaf", "path", "subroot", "root")


def audit(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every row's leaf, proof and the root that its leaf, altered where `tampered`, leads to."""
    store = store_of(docs, "merkle")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = F.when(tampered, leaf_digest({"text": F.translate("text", "\n", "")}))
    leaves = docs.select("doc_id", "source", leaf_digest().alias("leaf"),
                         F.struct("doc_id", altered.alias("altered")).alias("item"))
    found = proofs(manifest(leaves, store, height), store)
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, path, subroot, root = (batch[c].to_pylist() for c in ("leaf", "path", "subroot", "root"))
            folded = [fold(a or own, way) for a, own, way in zip(batch["altered"].to_pylist(), leaf, path)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "leaf": [x.hex() for x in leaf], "subroot": [x.hex() for x in subroot],
                "root": [x.hex() for x in root], "proof_sha256": list(map(proof_digest, path)),
                "folded_root": [x.hex() for x in folded], "verified": [a == b for a, b in zip(folded, root)],
            }, schema=arrow)

    return found.select("item.*", "leaf", "path", "subroot", "root").mapInArrow(check, schema)


SQL = r"""
WITH RECURSIVE
table_of AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)), lambda c, i:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
given AS (
    SELECT row_number() OVER () AS id, doc_id, source, doc_id::VARCHAR AS i, source::VARCHAR AS s, lang::VARCHAR AS l,
           n_chars::VARCHAR AS n, text AS t FROM documents),
fields AS (
    SELECT id, doc_id, source, coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(s) || ':' || s, '-')
           || coalesce(strlen(l) || ':' || l, '-') || coalesce(strlen(n) || ':' || n, '-') AS head, t,
           replace(t, chr(10), '') AS u,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(i, ''),
               lambda c: ascii(c)::BIGINT)), lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 2 = 0 AS tampered
    FROM given, table_of),
leaves AS (
    SELECT *, sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS leaf,
           sha256(head || coalesce(strlen(u) || ':' || u, '-')) AS altered FROM fields),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (
    SELECT source, 0 AS level, pos, leaf AS digest, n FROM placed
    UNION ALL
    SELECT source, any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM low WHERE n > 1 GROUP BY source, pos // 3),
sub AS (
    SELECT source, level AS height, digest AS subroot,
           row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n_sources
    FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, place AS pos, subroot AS digest, n_sources AS n FROM sub
    UNION ALL
    SELECT any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM high WHERE n > 1 GROUP BY pos // 3),
runs AS (
    SELECT source, FALSE AS top, level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM low WHERE n > 1
    GROUP BY ALL
    UNION ALL
    SELECT NULL, TRUE, level, pos // 3, list(digest ORDER BY pos) FROM high WHERE n > 1 GROUP BY ALL),
tops AS (SELECT digest AS root, level AS levels FROM high WHERE n = 1),
way AS (
    SELECT id, source, 0 AS step, pos, CASE WHEN tampered THEN altered ELSE leaf END AS digest, '' AS proof FROM placed
    UNION ALL
    SELECT w.id, w.source, w.step + 1,
           CASE WHEN w.step + 1 = s.height THEN s.place ELSE w.pos // 3 END,
           sha256(array_to_string(list_transform(r.digests, lambda d, k: CASE WHEN k = w.pos % 3 + 1 THEN w.digest
                                                                         ELSE d END), '')),
           w.proof || array_to_string(list_filter(r.digests, lambda d, k: k <> w.pos % 3 + 1), '')
    FROM (SELECT w0.* REPLACE (CASE WHEN w0.step = 0 AND h.height = 0 THEN h.place ELSE w0.pos END AS pos)
          FROM way w0 JOIN sub h ON h.source IS NOT DISTINCT FROM w0.source) w
    JOIN sub s ON s.source IS NOT DISTINCT FROM w.source
    JOIN runs r ON r.run = w.pos // 3 AND (NOT r.top AND w.step < s.height AND r.source IS NOT DISTINCT FROM w.source
                                           AND r.level = w.step OR r.top AND w.step >= s.height
                                           AND r.level = w.step - s.height))
SELECT p.doc_id, p.leaf, s.subroot, t.root, sha256(w.proof) AS proof_sha256, w.digest AS folded_root,
       w.digest = t.root AS verified
FROM placed p JOIN sub s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN tops t
JOIN way w ON w.id = p.id AND w.step = s.height + t.levels
"""
