import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ferret.llm import suffix_dedup
from ferret.llm.suffix_array import suffix_array

from llm.helpers import EDGE_TEXTS, documents, prose


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_equals_sorted_suffixes(symbols):
    s = [*symbols, 0]
    assert list(suffix_array(np.array(s))) == sorted(range(len(s)), key=lambda k: s[k:])


def test_suffix_array_of_long_periods():
    s = [1, 2, 1] * 200 + [2, 1] * 100 + [0]
    assert list(suffix_array(np.array(s))) == sorted(range(len(s)), key=lambda k: s[k:])


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def case(rng):
    base = [prose(rng, rng.randrange(5, 120), 60) for _ in range(8)]
    texts = [*EDGE_TEXTS, *base, base[0], base[1] + base[2], "ab" * 90, "x" + "ab" * 70, "é" * 100]
    for _ in range(14):  # shared passages of many lengths, edited copies
        src = rng.choice(base)
        a = rng.randrange(len(src))
        texts.append(prose(rng, 6) + src[a:a + rng.randrange(20, 140)] + prose(rng, 6))
        k = rng.randrange(len(src))
        texts.append(src[:k] + rng.choice("XYZ") + src[k + 1:])
    return texts


def check(spark, texts, **options):
    docs = documents(spark, texts)
    got = {r["doc_id"]: tuple(r)[1:5] + (bytes(r["kept"]),) for r in suffix_dedup.remove_repeats(docs, **options).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, options["length"])


def test_against_brute_force(spark):
    check(spark, case(random.Random(5)), length=40, gram=8)


def test_large_groups_take_the_counting_way(spark):
    check(spark, case(random.Random(6)), length=40, gram=8, group_limit=2)


def test_many_copies_and_blocks(spark, monkeypatch):
    rng = random.Random(7)
    src = prose(rng, 60, 50)
    texts = [src] * 5 + [src[:k] + "#" + src[k:] for k in range(0, 300, 7)]
    check(spark, texts, length=50, gram=16)


def test_blocks_of_a_long_text_lose_no_window(monkeypatch):
    rng = random.Random(8)
    data = prose(rng, 400).encode()
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 100)
    starts = [k for lo, hi, *_ in suffix_dedup.regions(data, 40, 8) for k in range(lo, hi + 1)]
    assert starts == list(range(len(data) - 39))


def test_empty_table_and_null_ids(spark):
    docs = documents(spark, ["a" * 500, "b", "b"], ids=[None, None, 1])
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    got = sorted((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == [(False, 1, 0), (True, 1, 0), (True, 500, 500)]
