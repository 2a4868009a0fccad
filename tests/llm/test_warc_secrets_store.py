import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferret.llm import id_store, secret_scan, warc
from ferret.llm.common import scratch

from llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")


# ---- operator 4 -----------------------------------------------------------

def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def test_chunked_framing_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 7, 8, 9, 100):
        body = bytes(rng.choice(b"\r\n0a;") for _ in range(n))
        assert warc.dechunked(warc.chunked(body, 8)) == body
    for broken in (b"", b"5\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_archives_round_trip_with_segments_and_revisits(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (9, None, big), (3, "u", "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (None, "u", big + "n"), (8, "u", "\r\n\r\n"), (7, "u", "0" * 5000), (7, "u", "0" * 5000)]
    path = scratch(spark, "test-warc")
    warc.write_archives(pages_table(spark, rows), path, segment_bytes=300, records_per_file=7)
    got = warc.read_pages(spark, path).collect()
    assert len(got) == len(rows) and all(r["problem"] is None for r in got)
    want = {(p, hashlib.sha1((h or "").encode()).hexdigest(), len((h or "").encode()),
             "revisit" if h == big and p != 9 else "response", 9 if h == big and p != 9 else None) for p, _, h in rows}
    assert {(r["page_id"], r["payload_digest"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got} == want
    by_id = {p: h or "" for p, _, h in rows}
    assert all(bytes(r["payload"]).decode() == by_id[r["page_id"]] for r in got)


def test_archives_are_standard_records(spark):
    path = scratch(spark, "test-warc")
    warc.write_archives(pages_table(spark, [(1, "http://a/", "x" * 2000)]), path, segment_bytes=500)
    data = b"".join(gzip.decompress(bytes(r["content"])) for r in spark.read.format("binaryFile").load(path).collect())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert data.count(b"WARC-Type: continuation") == data.count(b"WARC-Segment-Origin-ID: <urn:page:1:") >= 3
    assert data.count(b"WARC-Segment-Total-Length: ") == 1 and data.endswith(b"\r\n\r\n")


def test_broken_segments_are_reported():
    import pandas as pd

    digest = hashlib.sha1(b"abc").hexdigest()
    block = warc.HTTP_HEAD + warc.chunked(b"abc", 2)
    rows = [{"record_id": "r", "told_digest": digest if k == 1 else None, "segment": k,
             "total": len(block) if k == 3 else None, "block": b} for k, b in ((3, block[20:]), (1, block[:10]), (2, block[10:20]))]
    good = warc.join_segments(pd.DataFrame(rows)).iloc[0]
    assert good["payload"] == b"abc" and good["problem"] is None
    assert warc.join_segments(pd.DataFrame(rows[:2])).iloc[0]["problem"] == "a segment is missing"
    rows[0]["total"] += 1
    assert "total length" in warc.join_segments(pd.DataFrame(rows)).iloc[0]["problem"]


def test_empty_pages(spark):
    assert warc.write_and_read(pages_table(spark, [(1, "u", "x")]).limit(0)).count() == 0


# ---- operator 7 -----------------------------------------------------------

BASE = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile(r"[0-9a-f]+"), 0, 24)}


def brute_spans(text):
    out = []
    for k, (kind, (pattern, g, least)) in enumerate(BASE.items()):
        out += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text) if len(m[g]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def github(body):
    return "ghp_" + body + secret_scan.checksum62(body.encode()).decode()


def secret_texts():
    rng = random.Random(4)
    parts = ["password", "PassWD", "secret", "ſecret", "toKen", "api_key", "apikey", "AKIA", "akia", '"', "'", " ", "  ", ":", "=", "\n",
             "é", "👍", "abcdef", "0123456789abcdef", "deadbeef" * 3, "ABCDEFGHIJKLMNOP", "x", "A1B2C3", "/+_.-", "ghp_", "token=secret=abcdef"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)]


def test_base_spans_equal_brute_force(spark):
    texts = [*EDGE_TEXTS, *secret_texts()] + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    got = {r["doc_id"]: r for r in secret_scan.find_secrets(documents(spark, texts)).collect()}
    for k, t in enumerate(texts):
        want = brute_spans(t or "")
        assert [s for s in got[k]["spans"].split(",") if s and s.split(":")[0] in BASE] == want, t
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[k][f"n_{kind}"] for kind in BASE] == [sum(s.startswith(kind + ":") for s in want) for kind in BASE]
    assert sum(bool(brute_spans(t or "")) for t in texts) > 100


def test_checksummed_tokens():
    good = github("aZ" * 15)
    assert secret_scan.scan_text(f"é {good}!") == [(2, 2 + len(good), "github")]
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    assert secret_scan.scan_text(bad) == [] and secret_scan.scan_text(good + "x") == []
    npm = "npm_" + good[4:]
    assert secret_scan.scan_text(npm) == [(0, len(npm), "npm")]


def test_redaction_and_edges(spark):
    docs = documents(spark, ["x password=abcdef12 y", None, "clean"], ids=[None, 2, 2])
    assert sorted((r["text"] or "") for r in secret_scan.redact(docs).collect()) == ["", "clean", "x <assign> y"]
    assert secret_scan.redact(docs).columns == docs.columns
    assert secret_scan.find_secrets(docs).count() == 3
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


# ---- operator 8 -----------------------------------------------------------

def expected_ids(rows):
    plain = Tokenizer.from_file(BYTE)
    plain.encode_special_tokens = True
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_store_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = id_store.store_and_read(docs, BYTE, shard_text_bytes=50_000, keys_per_bucket=30).collect()
    assert sorted(map(tuple, got)) == expected_ids([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_store_edges(spark):
    texts = [*EDGE_TEXTS, "!" * 20, "same", "same", "null id"]
    ids = [100 - 3 * k for k in range(len(texts) - 3)] + [50, 50, None]
    ids[0] = -5
    docs = documents(spark, texts, ids=ids)
    rows = list(zip(ids, texts))
    got = sorted(map(tuple, id_store.store_and_read(docs, BYTE, shard_text_bytes=40, keys_per_bucket=3).collect()),
                 key=lambda r: (r[0] is not None, r))
    assert got == expected_ids(rows) and got[0][0] is None
    assert id_store.store_and_read(docs.limit(0), BYTE).count() == 0


def test_keyed_access(spark):
    docs = documents(spark, [f"text number {k} !" for k in range(60)], ids=[7 * k for k in range(60)])
    path, index_path = scratch(spark, "test-ids"), scratch(spark, "test-index")
    id_store.write_ids(docs, path, BYTE, shard_text_bytes=200)
    id_store.build_index(id_store.read_directory(spark, path), index_path, keys_per_bucket=9)
    index = spark.read.parquet(index_path)
    keys = spark.createDataFrame([(k,) for k in (0, 14, 15, 413, -1, None)], "key long")
    got = {r["key"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in id_store.fetch(keys, index, path).collect()}
    plain = Tokenizer.from_file(BYTE)
    assert got == {k: [*plain.encode(f"text number {k // 7} !").ids, 0] for k in (0, 14, 413)}


@pytest.mark.parametrize("n", [0, 1, 2, 50, 5000])
def test_perfect_hash_is_minimal_and_survives_dumping(n):
    keys = np.random.default_rng(n).choice(1 << 60, n, replace=False).astype(np.int64)
    mph = id_store.PerfectHash.load(id_store.PerfectHash.build(keys).dump())
    assert sorted(mph.slots(keys).tolist()) == list(range(n))
    strangers = mph.slots(keys + 1)
    assert ((strangers >= -1) & (strangers < max(1, n))).all()
