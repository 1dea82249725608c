"""Plain versions of the operators that SQL does not express, over rows (doc_id, text, lang, source, n_chars)."""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % folds


def components(sets: list[frozenset], percent: int) -> list[int | None]:
    """For each set the first index of its component; None for an empty set. All pairs that share an item are compared."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, items in enumerate(sets):
        shared = Counter(j for x in items for j in holders[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(items) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in items:
            holders[x].append(i)
    return [find(i) if s else None for i, s in enumerate(sets)]


def shingle_set(text: str | None, width: int) -> frozenset:
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near(rows: list[tuple], width: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [shingle_set(r[1], width) for r in rows]
    labels = components(sets, percent)
    least: dict = {}
    for r, label in zip(rows, labels):
        if label is not None and r[0] is not None:
            least[label] = min(r[0], least.get(label, r[0]))
    out = []
    for r, s, label in zip(rows, sets, labels):
        component = r[0] if label is None else least.get(label)
        out.append((r[0], len(s), component, r[0] == component))
    return out


def base_scores(rows: list[tuple]) -> dict:
    """doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = {r[0]: [*WORD.findall(lower(r[1] or "")), None] for r in rows}
    counts = Counter(t for r in rows if fold(r[0], 7) != 2 for t in tokens[r[0]])
    n, v = sum(counts.values()), len(counts)
    return {i: (fold(i, 7) == 2, len(ts), sum(counts[t] > 0 for t in ts), n,
                sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)) for i, ts in tokens.items()}


def splits(text: str, pieces: dict[str, float], byte: float) -> list[tuple[list[str], float]]:
    """Every split of a text into pieces, "" for a character in bytes, with its probability."""
    if not text:
        return [([], 1.0)]
    firsts = [(text[:k], pieces[text[:k]], k) for k in range(1, len(text) + 1) if text[:k] in pieces]
    firsts.append(("", byte ** len(text[0].encode()), 1))
    return [([piece, *rest], p * q) for piece, p, k in firsts for rest, q in splits(text[k:], pieces, byte)]


def lattice_scores(rows: list[tuple], pieces: dict[str, float], byte: float, own: float, end: float) -> dict:
    """doc_id: (score, mixture_score), by writing out all splits of all words. Weights are probabilities."""
    words = {r[0]: WORD.findall(lower(r[1] or "")) for r in rows}
    train = [i for i in words if fold(i, 7) != 2]
    counts = Counter(w for i in train for w in words[i])
    held = Counter()
    for word, times in counts.items():
        ways = splits("\u2581" + word, pieces, byte)
        total = sum(p for _, p in ways)
        for split, p in ways:
            for piece in split:
                held[piece] += times * p / total
    whole = sum(held.values()) + own
    fitted = {x: (held[x] + own * p) / whole for x, p in pieces.items()}
    prior = {w: (1 - end) * sum(p for _, p in splits("\u2581" + w, fitted, byte)) for ws in words.values() for w in ws}
    types, tokens = len(counts) + (len(train) > 0), sum(counts.values()) + len(train)
    return {i: (math.log10(end) + sum(math.log10(prior[w]) for w in ws),
                sum(math.log10((c + max(types, 1) * p) / (tokens + max(types, 1)))
                    for c, p in [(len(train), end), *((counts[w], prior[w]) for w in ws)]))
            for i, ws in words.items()}


def toxicity_loss(labels: list, held: list, pairs: list, w: list, b: float, counterfactual: float, ridge: float) -> float:
    """What the training of the toxicity classifier minimises, row by row."""
    def score(items):
        return 1 / (1 + math.exp(-b - sum(w[i] for i in items)))

    share = {y: labels.count(y) for y in (0, 1)}
    loss = sum(-math.log(score(h) if y else 1 - score(h)) / (2 * share[y]) for y, h in zip(labels, held))
    loss += ridge / 2 * sum(x * x for x in w)
    return loss + counterfactual * sum((score(p) - score(q)) ** 2 for p, q in pairs) / max(len(pairs), 1)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    found = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]


def url_parts(url: str | None) -> tuple[str, str, str | None]:
    """host, path and the text of the longest rule that fits."""
    if url is None or "://" not in url:
        return "", "", None
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    host, path = lower(host), slash + path
    fits = [h + p for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


# --- n-gram classifier

def gram_slots(text: bytes, bits: int) -> Counter:
    """Slots of single words and of pairs, counted one by one."""
    words, mask = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s\x00]", text), (1 << 64) - 1
    hashes = [zlib.crc32(w) for w in words]
    pairs = [1 if a == b else (a * 0x9E3779B97F4A7C55 + b * 0xC2B2AE3D27D4EB4F) & mask
             for a, b in zip(hashes, hashes[1:])]
    return Counter(((h * 0x9E3779B97F4A7C15) & mask) >> (64 - bits) for h in [*hashes, *pairs])


def gram_values(counts: Counter) -> dict:
    raw = {s: 1 + math.log(n) for s, n in counts.items()}
    length = math.sqrt(sum(v * v for v in raw.values())) or 1.0
    return {s: v / length for s, v in raw.items()}


def follow_the_leader(rows: list[tuple[dict, int, float]], alpha, beta, l1, l2) -> dict:
    """Weights after the rows (values by slot, label, importance) in their order; textbook form, slot by slot."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for x, label, importance in rows:
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = importance * (p - label) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    return {i: weight(i) for i in z}


# --- Merkle manifest

def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple, text: str | None) -> str:
    doc_id, _, lang, source, n_chars = row
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The root, and for each leaf its place in the run and the run, level by level."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            ways[k].append((i % 3, level[i - i % 3:i - i % 3 + 3]))
        at = [i // 3 for i in at]
        level = [digest(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], ways


def merkle(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in groups[s]])
    root, tops = tree([trees[s][0] for s in order]) if order else ("", [])
    out = []
    for s, top in zip(order, tops):
        subroot, ways = trees[s]
        for r, way in zip(groups[s], ways):
            way = way + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            own = leaf(r, r[1].replace("\n", "") if tampered and r[1] is not None else r[1])
            for place, run in way:
                own = digest(*run[:place], own, *run[place + 1:])
            proof = digest(*(d for place, run in way for k, d in enumerate(run) if k != place))
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, own, own == root))
    return out


# --- alignment

def aligned(rows: list[tuple], encode_a, encode_b) -> list[tuple]:
    """The columns of the query for each row; the encoders give (id, bytes) of every token."""
    linked, groups = [], []
    for _, text, *_ in rows:
        body = b" " + (text or "").encode()
        a, b = encode_a(text or ""), encode_b(text or "")
        if not text or b"".join(s for _, s in a) != body or b"".join(s for _, s in b) != body:
            linked.append([]), groups.append(([], [], []))
            continue
        ends = []
        for side in (a, b):
            at, own = 0, []
            for _, s in side:
                at += len(s)
                own.append(at)
            ends.append(own)
        pairs = [(i, j) for i, e in enumerate(ends[0]) for j in [bisect.bisect_left(ends[1], e)] if ends[1][j] == e]
        linked.append([(a[i][0], b[j][0]) for i, j in pairs])
        cuts = [(-1, -1), *pairs]
        groups.append((a, b, [",".join(str(x) for x, _ in a[p[0] + 1:q[0] + 1]) + "|"
                              + ",".join(str(x) for x, _ in b[p[1] + 1:q[1] + 1]) for p, q in zip(cuts, pairs)]))
    counts = Counter(x for each in linked for x in each)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(r[0], len(a), len(b), len(g), len(ls), sum(counts[x] == most[x[1]] for x in ls),
             sum(counts[x] for x in ls), digest(";".join(g)) if g else "")
            for r, ls, (a, b, g) in zip(rows, linked, groups)]
