import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ferret.llm import periodic_runs, piece_codec, queries, vector_codes
from ferret.llm.vector_codes import closest, moved, next_b, reassigned

from llm.helpers import EDGE_TEXTS, documents, prose

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# vector codes

def brute_codes(rows, parts=8, entries=16, rounds=6):
    keep = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    keep.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    q = [[[math.floor(4096 * x) for x in v[p * len(v) // parts:(p + 1) * len(v) // parts]] for p in range(parts)] for _, v, _ in keep]
    books = [[list(r[p]) for r in q[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for r in q:
                mine.setdefault(nearest(p, r[p])[1], []).append(r[p])
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for (key, _, label), r in zip(keep, q):
        found = [nearest(p, r[p]) for p in range(parts)]
        out.append((key, label, bytes(k for _, k in found).hex(), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def vector_rows(rng, n, width=16):
    centres = [[rng.uniform(-2, 2) for _ in range(width)] for _ in range(7)]
    return [(k, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for k in range(n)]


SCHEMA = "vec_id long, embedding array<double>, label int, error string, key string, code string, near string, tally int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", 3) for r in rows], SCHEMA)


def codes_of(spark, rows, **options):
    codes = vector_codes.compress(frame(spark, rows), **options)
    got = [tuple(r) for r in codes.rows.collect()]
    return sorted(got, key=str), codes


def test_codes_equal_brute_force(spark):
    rng = random.Random(4)
    rows = vector_rows(rng, 300)
    rows += [(900, None, 1), (901, [1.0, None] + [0.0] * 14, 1), (902, [float("nan")] * 16, 2), (903, [float("inf")] + [0.0] * 15, None)]
    rows += [(904, rows[5][1], 2), (904, rows[5][1], 2), (None, rows[6][1], None), (905, [0.0] * 16, 1), (906, [-0.00001] * 16, 1)]
    got, codes = codes_of(spark, rows)
    want, digest = brute_codes(rows)
    assert got == sorted(want, key=str)
    assert codes.digest() == digest
    label = {}
    for _, lab, _, error in want:
        label[lab] = label.get(lab, 0) + error
    for r in vector_codes.with_label_error(codes.rows).collect():
        assert r["label_error"] == label[r["label"]]


def test_codes_of_few_equal_and_no_rows(spark):
    rows = [(k, [float(k % 3)] * 8, 1) for k in range(9)]  # ties everywhere: equal entries
    got, codes = codes_of(spark, rows)
    want, digest = brute_codes(rows)
    assert got == sorted(want, key=str) and codes.digest() == digest
    assert codes_of(spark, [(1, None, 1)])[0] == []
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 7, 1)]):
        with pytest.raises(Exception, match="length|divide"):
            codes_of(spark, bad)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 9))
def test_bounds_never_change_an_assignment(seed, entries):
    rng = np.random.default_rng(seed)
    x = rng.integers(-6, 6, (40, 2))
    book, b = rng.integers(-6, 6, (entries, 2)), min(3, entries - 1)
    state = closest(x, book, b)
    for _ in range(4):
        new = book + rng.integers(-1, 2, book.shape)
        fewer = int(rng.integers(min(1, b), b + 1))
        state, reached = reassigned(x, new, moved(book, new), state, fewer)
        book, b = new, fewer
        d2 = ((x[:, None] - book[None]) ** 2).sum(-1)
        assert (state.near[:, 0] == d2.argmin(1)).all() and reached.sum() == len(x)
        own = d2[np.arange(len(x)), state.near[:, 0]]
        assert (state.limits[:, 0] ** 2 >= own).all()
        for j in range(b):  # lower bounds hold, in order
            assert (np.maximum(state.limits[:, 1 + j], 0) ** 2 <= d2[np.arange(len(x)), state.near[:, 1 + j]]).all()
        assert (np.diff(state.limits[:, 1:], axis=1) >= 0).all()


def test_bounds_spare_distances_and_lists_get_shorter(spark):
    codes = vector_codes.compress(frame(spark, vector_rows(random.Random(8), 400)))
    kept, own, compared = codes.reached[-1][0], codes.reached[-1][1], sum(codes.reached[-1][2:])
    assert kept + own > 3 * compared  # close groups: most parts never meet another entry
    assert next_b(4, 16, [90, 5, 5, 0, 0, 0, 0]) == 2 and next_b(4, 16, [0, 0, 0, 0, 0, 90, 10]) == 4


# pieces

def test_pieces_equal_the_library(spark):
    rng = random.Random(2)
    alphabet = list("ab  \n\t▁▁éß日本👍12<s>0x41\x00\r  The the ﬁ 　ه")
    texts = [*EDGE_TEXTS, "<s>", "▁", "<0x41>", "the " * 3000, "x" * 5000, prose(rng, 4000)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)]
    docs = documents(spark, [*texts, texts[-1]], ids=[*range(len(texts)), len(texts) - 1])
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoded = piece_codec.encode_documents(docs, MODEL)
    rows = {r["doc_id"]: r for r in encoded.collect()}
    back = {r["doc_id"]: r["text"] for r in piece_codec.decode_documents(encoded, MODEL).collect()}
    digests = {r["doc_id"]: r for r in piece_codec.describe_codes(docs, MODEL).collect()}
    assert encoded.count() == len(texts) + 1
    for k, text in enumerate(texts):
        text, r = text or "", rows[k]
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert r["ids"] == ids
        spans = list(zip(r["starts"], r["ends"]))
        assert spans[1:-1] == [(p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces]
        data = text.encode()
        assert b"".join(data[a:b] for a, b in spans) == data and spans[0] == (0, 0) and spans[-1] == (len(data), len(data))
        assert back[k] == sp.decode(ids)
        d = digests[k]
        assert d["n_tokens"] == len(ids) and d["source_bytes"] == len(data)
        assert d["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert piece_codec.describe_codes(docs.limit(0), MODEL).count() == 0


def test_forgetting_segments_changes_nothing():
    c = piece_codec.Codec(MODEL)
    texts = ["one two three", "two\n\nthree four", "", "\n"]
    want = [i.tolist() for i, _ in c.encode(texts)]
    c.forget()
    assert [c.encode([t])[0][0].tolist() for t in texts] == want


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normalising_by_the_compiled_map_equals_the_library(rule, prefix, squeeze):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
    spec = b"".join(v for k, v in piece_codec._fields(lib.serialized_model_proto()) if k == 3)
    mine = piece_codec.Normaliser(spec)
    rng = random.Random(7)
    alphabet = list("ab  \n\t▁éß日本👍12　 ﬁ½ÅABCŁ가각①㍿ｶﾞ́e​…")
    for _ in range(500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(25)))
        normal, offsets = lib.normalize(text, with_offsets=True)
        got, source = mine(text)
        assert got == normal
        assert [len(text.encode()[:s].decode()) for s in source.tolist()] == list(offsets)


# periodic runs

def brute_runs(x, least=12):
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b, q) for (a, b), q in out.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequence(rng, deep=True):
    kind, n = rng.randrange(7 if deep else 6), rng.randrange(260)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        return [v for _ in range(n // 20 + 1) for v in [rng.randrange(2)] * rng.randrange(1, 60)]
    if kind == 3:
        u = [rng.randrange(50) for _ in range(rng.randrange(1, 60))]
        return [7] * rng.randrange(9) + u * rng.randrange(2, 6) + u[:rng.randrange(len(u) + 1)] + [rng.randrange(50) for _ in range(30)]
    if kind == 4:
        return fibonacci(n)
    if kind == 5:
        return [0, 1] * rng.randrange(80) + [0] * rng.randrange(3) + [0, 1] * rng.randrange(80) + [0, 1, 2] * rng.randrange(30)
    return (sequence(rng, False)[:50] + [rng.randrange(3) for _ in range(rng.randrange(40))]) * rng.randrange(1, 5)


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        x = sequence(rng)
        start, end, period = periodic_runs.find_runs(np.array(x, np.int64), len(x))
        assert sorted(zip(start.tolist(), end.tolist(), period.tolist())) == brute_runs(x)


def test_long_periods_and_many_runs():
    rng = random.Random(3)
    u = [rng.randrange(400) for _ in range(3000)]
    start, end, period = periodic_runs.find_runs(np.array(u * 3 + u[:100]), 9100)
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [9100], [3000])
    x = [0, 1] * 400 + [0] + [0, 1] * 400 + [0]
    assert sorted(zip(*(c.tolist() for c in periodic_runs.find_runs(np.array(x), len(x))))) == brute_runs(x)
    assert [len(c) for c in periodic_runs.find_runs(np.zeros(100_000, np.int64), 100_000)] == [1, 1, 1]


def expected_row(doc_id, text, plant):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for a, b, q in runs for k in range(a + q, b)}
    best = min(((-(b - a), a, q) for a, b, q in runs), default=None)
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()), runs, kept


def test_runs_of_documents(spark):
    rng = random.Random(6)
    texts = [*EDGE_TEXTS, "la " * 40, "a b c\n" * 30 + "end", prose(rng, 300, 5), prose(rng, 40), "é 日本 " * 25 + "x"]
    texts += [" ".join(map(str, sequence(rng))) for _ in range(60)]
    ids = [*range(len(texts))] + [3, None]
    texts += [texts[3], texts[11]]
    docs = documents(spark, texts, ids=ids)
    for plant in (False, True):
        got = sorted(map(tuple, periodic_runs.describe_runs(docs, plant).collect()), key=str)
        assert got == sorted((expected_row(k, t, plant)[0] for k, t in zip(ids, texts)), key=str)
    listed = sorted((r["doc_id"], r["start"], r["start"] + r["length"], r["period"]) for r in periodic_runs.list_runs(docs.where("doc_id > 3")).collect())
    assert listed == sorted((k, *run) for k, t in zip(ids, texts) if k is not None and k > 3 for run in expected_row(k, t, False)[1])
    collapsed = periodic_runs.collapse_runs(docs)
    assert collapsed.columns == docs.columns
    for r in collapsed.where("doc_id > 3").collect():
        _, runs, kept = expected_row(r["doc_id"], texts[r["doc_id"]], False)
        assert r["text"] == (kept if runs else texts[r["doc_id"]])
    assert periodic_runs.describe_runs(docs.limit(0)).count() == 0 and periodic_runs.list_runs(docs.limit(0)).count() == 0


# the queries on a given table

def test_queries_on_a_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_periodic_runs"](spark, SF).collect()))
    want = {k: expected_row(k, t, True)[0] for k, t in rows if len((t or "").split()) < 1500}
    assert len(got) == len(rows) and [r for r in got if r[0] in want] == [want[k] for k in sorted(want)]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = {r["doc_id"]: r["ids_sha256"] for r in queries.QUERIES["op12_piece_codec"](spark, SF).collect()}
    assert coded == {k: hashlib.sha256(np.array(sp.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest() for k, t in rows}
    vectors = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"])
               for r in spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 400").collect()]
    codes = vector_codes.compress(spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 400"))
    want, digest = brute_codes(vectors)
    assert sorted(map(tuple, codes.rows.collect())) == sorted(want) and codes.digest() == digest
