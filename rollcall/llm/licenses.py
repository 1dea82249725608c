"""License scans: an Aho-Corasick automaton over a text's words, and licence expressions of identifier tags.

The automaton finds notice phrases and identifier tags in one pass over the words joined by single spaces. Behind a
tag, the longest well-formed beginning of the rest of its line in the original text is a licence expression; what comes
after it, the end of a comment or prose, is none, but may hold further tags. A shunting-yard parser puts the expression
in postfix order (with binds closest, then and, then or), and its value says how freely the text may be used.

Defined cases: a null text is an empty one. Texts of any length are read whole; all places count, overlapping ones and
repeats too. A tag without a well-formed expression behind it adds the known identifiers up to where none can become
of it, but no value. Rows are judged one by one; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import TEXT_BYTES, map_columns

#: Phrases that every scan reports, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notice phrases.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc",
    "boost software license": "bsl", "creative commons zero": "cc0", "cc0": "cc0", "public domain": "public-domain",
    "unlicense": "unlicense", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: How freely a text under a licence may be used; identifiers are known by their longest prefix here.
FREEDOM = {
    "apache": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "cc-by": 0.9, "cc0": 1.0, "public-domain": 1.0,
    "unlicense": 1.0, "lgpl": 0.6, "mpl": 0.6, "epl": 0.6, "gpl": 0.3, "agpl": 0.2, "cc-by-sa": 0.4, "cc-by-nc": 0.1,
    "cc-by-nd": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
BINDS = {"or": 1, "and": 2, "with": 3}

#: ASCII letters and digits and everything beyond ASCII belong to words; the rest separates them.
_WORD_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
                    for b in range(256))
_TAG = re.compile(r"(?<![a-z0-9])spdx[^a-z0-9]+license[^a-z0-9]+identifier(?![a-z0-9])[^a-z0-9(\n<>/]*")
_TOKEN = re.compile(r"[a-z0-9][a-z0-9.+_-]*|[()]|\S")
#: A token behind a tag, on the same line. No identifier ends in a dot or dash: these end a sentence or begin "-->".
_NEXT = re.compile(r"[^\S\n]*([a-z0-9](?:[a-z0-9._+-]*[a-z0-9+])?|[()])")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def label_of(identifier: str) -> str | None:
    known = [k for k in FREEDOM if identifier == k or re.match(re.escape(k) + r"[-+.0-9]", identifier)]
    return max(known, key=len, default=None)


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in postfix order, or None if the expression is malformed."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        if token in BINDS:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if operand_next or not stack:
                return None
            stack.pop()
        elif token[0].isalnum():
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
        else:
            return None
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out if out and not operand_next else None


def leading(text: str, at: int, end: int) -> tuple[list[str], int]:
    """The tokens from `at` on that can begin an expression, and how many of them are the longest well-formed one."""
    tokens: list[str] = []
    whole = depth = 0
    operand_next = True
    while found := _NEXT.match(text, at, end):
        token = found.group(1)
        if token in BINDS or token == ")":
            if operand_next or (token == ")" and not depth):
                break
            depth -= token == ")"
            operand_next = token in BINDS
        elif operand_next:
            depth += token == "("
            operand_next = token == "("
        else:
            break
        tokens.append(token)
        at = found.end()
        if not depth and not operand_next:
            whole = len(tokens)
    return tokens, whole


def freedom(items: list[str]) -> float:
    """Value of a postfix expression: the freer of two choices, the stricter of two duties, an exception halfway up."""
    stack: list[float] = []
    for item in items:
        if item not in BINDS:
            stack.append(FREEDOM.get(label_of(item) or "", UNKNOWN))
            continue
        b, a = stack.pop(), stack.pop()
        stack.append({"or": max(a, b), "and": min(a, b), "with": (a + 1) / 2}[item])
    return stack[0]


def automaton():
    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: bytes, automaton) -> tuple:
    """n_words, places of base phrases (ascending word indexes), base labels, all labels, score."""
    words = words_of(text)
    joined = f" {b' '.join(words).decode()} "
    places, base, labels, values, at, seen, tagged = [], set(), set(), [], 0, 0, False
    for end, phrase in automaton.iter(joined):
        seen += joined.count(" ", at, end)  # words up to the end of this phrase
        at = end
        if phrase == TAG:
            tagged = True
            continue
        label = BASE.get(phrase) or NOTICES[phrase]
        if phrase in BASE:
            places.append(seen - phrase.count(" ") - 1)
            base.add(label)
        labels.add(label)
    values += [FREEDOM[x] for x in labels]
    if tagged:
        lowered = text.lower().decode()
        tags = [m.span() for m in _TAG.finditer(lowered)]
        for (_, begin), (end, _) in zip(tags, [*tags[1:], (len(lowered), 0)]):
            tokens, whole = leading(lowered, begin, end)
            if whole:
                tokens = tokens[:whole]
                values.append(freedom(postfix(" ".join(tokens))))
            labels |= {x for t in tokens if t not in BINDS and (x := label_of(t))}
    return len(words), sorted(places), base, labels, min(values, default=UNKNOWN)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places, base_labels, labels (arrays) and score of every row."""
    def make():
        own = automaton()

        def work(c):
            rows = [scan(t, own) for t in c["body"]]
            n, places, base, labels, score = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            return {"doc_id": c["doc_id"], "n_words": n, "places": places, "base_labels": [sorted(x) for x in base],
                    "labels": [sorted(x) for x in labels], "score": score}
        return work

    return map_columns(docs.select("doc_id", F.expr(TEXT_BYTES).alias("body")),
                       "doc_id long, n_words long, places array<long>, base_labels array<string>, "
                       "labels array<string>, score double", make)


def license_digests(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0)).alias("first_word"), F.get("places", F.size("places") - 1).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
