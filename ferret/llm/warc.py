"""Operator 4: WARC archives of pages, written and read back, with segment reassembly.

Writing: every page is a response whose HTTP body is in chunked transfer
framing.  Of pages with equal payloads of at least ``revisit_bytes`` bytes, that
with the largest id is the response and the others are revisit records that
refer to it.  Blocks above ``segment_bytes`` are cut: the first record has
segment number 1, continuation records carry the origin's identifier and their
number, and the last one the total length.  A record ends with two line breaks,
which is the record separator given to Spark's text writer, so archives (gzip)
are written by Spark's committer to any file system, with a bounded number of
records each.

Reading: archives are parsed record by record as a stream.  Records in one piece
are decoded where they are read; segments are grouped by origin, ordered by
number, checked against the total length and then decoded.

Cases: a null html is an empty payload; repeated rows are written each (their
identifiers agree, so a group may hold several copies of each segment); a null
page_id is kept; a record that can't be put together keeps its row, with the
reason in ``problem`` and null payload columns; an empty table gives an empty
result.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.llm.common import scratch, stored

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4000
DATE = "2024-01-01T00:00:00Z"
# fixed values: names and forms of the public WARC 1.1 standard
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD_END = "\r\n\r\n"

RECORDS = ("record_id string, record_type string, refers_to string, told_digest string, segment int, total long, "
           "block binary, payload binary, payload_bytes long, payload_digest string, problem string")
PAYLOAD = "record_id string, payload binary, payload_bytes long, payload_digest string, problem string"


# ---- framing --------------------------------------------------------------

def chunked(payload: bytes, size: int) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out.append(b"%x\r\n%b\r\n" % (len(part), part))
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        part = body[at:at + size]
        if len(part) < size or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(part)
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response, without its transfer framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the HTTP head")
    fields = [x.partition(b":") for x in head.lower().split(b"\r\n")[1:]]
    framed = any(k.strip() == b"transfer-encoding" and b"chunked" in v for k, _, v in fields)
    return dechunked(body) if framed else body


def decoded(block: bytes, told: str | None) -> tuple:
    """payload, its length and SHA-1, and what is wrong with it (else null)."""
    try:
        payload = http_payload(block)
    except ValueError as e:
        return None, None, None, str(e)
    digest = hashlib.sha1(payload).hexdigest()
    if told and told != digest:
        return None, None, None, "the payload's digest differs from the header's"
    return payload, len(payload), digest, None


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the line breaks behind it."""
    lines = [VERSION, *(f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode() for k, v in fields),
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_records(page_id, url, payload: bytes, digest: str, refers_to, segment_bytes: int, date: str) -> list[bytes]:
    name = record_id(page_id, digest)
    common = [("WARC-Date", date), ("WARC-Target-URI", url or "about:blank")]
    told = ("WARC-Payload-Digest", f"sha1:{digest}")
    kind = ("Content-Type", "application/http;msgtype=response")
    if refers_to is not None:
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, told, kind,
                        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload, CHUNK_BYTES)
    cuts = range(0, len(block), segment_bytes)
    out = []
    for k, at in enumerate(cuts, 1):
        if k == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, told, kind]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), *common,
                      ("WARC-Segment-Origin-ID", name)]
        if len(cuts) > 1:
            fields.append(("WARC-Segment-Number", k))
            if k == len(cuts):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(record(fields, block[at:at + segment_bytes]))
    return out


# ---- archives -------------------------------------------------------------

def write_archives(pages: DataFrame, path: str, *, segment_bytes: int = SEGMENT_BYTES, date: str = DATE,
                   revisit_bytes: int = REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         html.alias("payload"))
            .select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")))
    first = (rows.where(F.col("n") >= revisit_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
             .where("copies > 1").select("digest", "first"))
    # the side of pages may be dealt anew here, where a hot payload is split by the skew join
    rows = rows.join(first, "digest", "left")
    is_revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", F.when(~is_revisit, F.col("payload")).alias("payload"), "digest",
                       F.when(is_revisit, F.col("first")).alias("refers_to"))

    def render(batches):
        info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:warcinfo>"), ("WARC-Date", date),
                       ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        started = False
        for batch in batches:
            out = [] if started else [info]
            started = True
            for r in batch.to_pylist():
                out += page_records(r["page_id"], r["url"], r["payload"] or b"", r["digest"], r["refers_to"],
                                    segment_bytes, date)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["raw"])

    (rows.mapInArrow(render, "raw binary").select(F.col("raw").cast("string").alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(stream) -> list:
    """Yields (fields, block) of an archive's records; field names in lower case."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, stream.read(int(fields["content-length"]))


def read_records(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per response, revisit or segment; records in one piece are decoded, segments keep their block."""
    def read(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                size = 0
                for fields, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data.as_py())))):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    told = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    segment = fields.get("warc-segment-number")
                    row = {"record_id": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
                           "record_type": kind, "refers_to": fields.get("warc-refers-to"), "told_digest": told,
                           "segment": segment and int(segment), "block": block if segment else None,
                           "total": int(x) if (x := fields.get("warc-segment-total-length")) else None}
                    if kind == "response" and not segment:
                        payload, n, digest, problem = decoded(block, told)
                        row |= {"payload": payload if with_payload else None, "payload_bytes": n,
                                "payload_digest": digest, "problem": problem}
                    rows.append(row)
                    size += len(block)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=types)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=types)

    types = pa.schema([(f.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(),
                                       "binary": pa.binary()}[f.split()[1]]) for f in RECORDS.split(", ")])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, RECORDS)


def join_segments(pdf: pd.DataFrame, with_payload: bool = True) -> pd.DataFrame:
    """The copies of one segmented record, put together; all copies of an identifier have the same content."""
    copies = max(1, int((pdf["segment"] == 1).sum()))
    pdf = pdf.sort_values("segment", kind="stable")
    name, told = pdf["record_id"].iloc[0], next((x for x in pdf["told_digest"] if x), None)
    one = pdf.drop_duplicates("segment")
    total = next((int(x) for x in one["total"] if x == x and x is not None), None)
    block = b"".join(one["block"])
    if one["segment"].tolist() != list(range(1, len(one) + 1)):
        got = (None, None, None, "a segment is missing")
    elif total is None or total != len(block):
        got = (None, None, None, "the segments' total length differs from the header's")
    else:
        got = decoded(block, told)
    row = dict(zip(("payload", "payload_bytes", "payload_digest", "problem"), got, strict=True))
    row["payload"] = row["payload"] if with_payload else None
    return pd.DataFrame([{"record_id": name, **row}] * copies).astype({"payload_bytes": "Int64"})


def read_pages(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per page of the archives: page_id, payload columns, record_type, refers_to, problem.

    A revisit takes its payload columns from the response that it refers to.
    """
    records = stored(read_records(spark, path, with_payload=with_payload), "warc-records")
    parts = records.where("segment IS NOT NULL").select("record_id", "told_digest", "segment", "total", "block")
    whole = records.where("record_type = 'response' AND segment IS NULL")
    cols = ["record_id", "payload", "payload_bytes", "payload_digest", "problem"]
    joined = parts.groupBy("record_id").applyInPandas(lambda pdf: join_segments(pdf, with_payload), PAYLOAD)
    responses = whole.select(*cols).union(joined.select(*cols))
    by_id = responses.groupBy("record_id").agg(*[F.max(c).alias(c) for c in cols[1:4]])
    revisits = records.where("record_type = 'revisit'").select("record_id", "told_digest", "refers_to")
    found = revisits.join(by_id.withColumnRenamed("record_id", "origin"), F.col("refers_to") == F.col("origin"), "left")
    agrees = F.col("payload_digest").eqNullSafe(F.col("told_digest"))
    found = found.select("record_id", *[F.when(agrees, F.col(c)).alias(c) for c in cols[1:4]],
                         F.when(~agrees, F.lit("the response is missing or differs")).alias("problem"),
                         F.lit("revisit").alias("record_type"), "refers_to")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*):", 1).try_cast("long")
    out = responses.select(*cols, F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
    return out.unionByName(found).select(
        page("record_id").alias("page_id"), "payload", "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"), "problem")


def write_and_read(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the archives back, without the payloads."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_pages(pages.sparkSession, path, with_payload=False)
