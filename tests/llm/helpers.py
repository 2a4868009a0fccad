"""Tables for the tests of the text operators."""

from __future__ import annotations

import random

# names that an operator might use itself; they must pass through or do no harm
CLASHING = ["row", "text_key", "class", "n", "h", "hits", "kept", "spans", "gone", "words", "component", "length", "path"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING)


def documents(spark, texts, ids=None, sources=None):
    """A documents table with clashing extra columns; ``texts`` may hold nulls."""
    rows = []
    for k, t in enumerate(texts):
        key = k if ids is None else ids[k]
        rows.append((key, t, None if k % 3 == 0 else "en", "s" if sources is None else sources[k],
                     None if t is None else len(t), *[f"{c}{k}" for c in CLASHING]))
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    out = []
    for k in range(words):
        w = rng.randrange(vocabulary)
        out.append("w" + "abcdefghij"[w % 10] + str(w))
        if k % 9 == 8:
            out.append("\n")
    return " ".join(out).replace(" \n ", "\n")


EDGE_TEXTS = [None, "", " ", "\n\n", "one", "two words", "é ﬀ 日本語 👍", "a" * 3000, "x\x00y", "\r\n\t\x0b\x0c"]
