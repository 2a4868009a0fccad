import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferret.llm import packing
from ferret.llm.encoder import Encoder

from llm.helpers import EDGE_TEXTS, documents, prose

SF = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [t for t in EDGE_TEXTS if t is not None] + [
    "a  b", "\n\n a\t b\n", "İstanbul ΣΑΣ é x́y", "don't DON'T 'S", "x́y ½ 2² 123,456",
    "<|endoftext|> a <|startoftext|>", "a\r\nb\x1cc\x85d", "ﬁ Å K", "a b​c", "The\n\nfoo  \n bar   baz ", "'ll 're",
    "_foo_bar__", "ß ẞ SS ǅ"]


@pytest.mark.parametrize("path,rule", [(WORD, "word_ends"), (BYTE, "byte_level"), (BYTE, None)])
def test_chunked_ids_equal_whole_texts(spark, path, rule):
    texts = ODD + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    enc = Encoder(path, rule)
    assert enc.encode(texts) == want
    assert enc.encode(texts[::-1]) == want[::-1]  # from the cache


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZé' \n\t1½_.,́İΣ 日"), max_size=30))
def test_chunked_ids_of_any_text(text):
    for path, rule in ((WORD, "word_ends"), (BYTE, "byte_level")):
        enc = ENCODERS.setdefault(path, Encoder(path, rule))
        assert enc.encode([text]) == [enc._ids(text).tobytes()]


ENCODERS: dict = {}


def replay(histogram, capacity):
    rows, n = packing.plan_sequences(histogram, capacity)
    bins = [[] for _ in range(n)]
    seen = dict.fromkeys(histogram, 0)
    for size, lo, hi, sequence, offset, each in rows:
        assert lo == seen[size]
        seen[size] = hi
        for r in range(lo, hi):
            bins[sequence + (r - lo) // each].append((offset + (r - lo) % each * size, size))
    assert seen == histogram
    return bins


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece_gaplessly(histogram):
    capacity = 60
    bins = replay(histogram, capacity)
    for b in bins:
        at = 0
        for offset, size in sorted(b):
            assert offset == at
            at += size
        assert 0 < at <= capacity
        assert sum(3 * size > capacity for _, size in b) <= 2
    total = sum(s * n for s, n in histogram.items())
    assert len(bins) >= -(-total // capacity)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_equals_piece_by_piece_matching_and_best_fit(sizes):
    capacity = 40
    left, gaps = sorted(s for s in sizes if 3 * s > capacity), []
    while left:
        a = left.pop()
        fits = [s for s in left if a + s <= capacity]
        if fits:
            left.remove(max(fits))
        gaps.append(capacity - a - max(fits, default=0))
    for s in sorted((s for s in sizes if 3 * s <= capacity), reverse=True):
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(capacity - s)
    histogram = {s: sizes.count(s) for s in sizes}
    assert sorted(capacity - sum(s for _, s in b) for b in replay(histogram, capacity)) == sorted(gaps)


def check_packed(rows, expected, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, ids in expected.items():
        want = [(k, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
                for k, at in enumerate(range(0, len(ids), capacity))]
        assert sorted(by_doc[key]) == want
    assert set(by_doc) == set(expected)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = Tokenizer.from_file(WORD)
    ids = {r["doc_id"]: plain.encode(r["text"], add_special_tokens=False).ids + [1] for r in docs.collect()}
    n = check_packed(packing.pack_documents(docs, WORD).collect(), ids, 4096)
    total = sum(map(len, ids.values()))
    assert n <= -(-total // 4096) + 2


def test_packing_edges(spark):
    rng = random.Random(3)
    docs = documents(spark, [*EDGE_TEXTS, prose(rng, 200), prose(rng, 50)])
    plain = Tokenizer.from_file(WORD)
    plain.encode_special_tokens = True
    ids = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    packed = packing.pack_documents(docs, WORD, capacity=64, with_ids=True)
    check_packed(packed.collect(), ids, 64)
    made = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert made[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]].tolist() == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0
    twice = packing.pack_documents(docs.union(docs), WORD, capacity=64)
    assert twice.count() == 2 * packed.count()
    null_ids = documents(spark, ["a b", "c"], ids=[None, None])
    assert [r["doc_id"] for r in packing.pack_documents(null_ids, WORD).collect()] == [None, None]
