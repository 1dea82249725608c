"""Shared by the tests of the training-data operators."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ("kept", "size", "row", "body", "class", "data", "label", "_id", "_hash", "_row", "n_words", "key", "part",
            "pos", "line", "kept_text", "n_lines", "n_dropped", "times", "component_id", "host", "tokens")


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choice("aeioustrnlm") for _ in range(draw.randint(2, 7))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def table(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
