"""Operator 8: token ids in binary shards with a minimal perfect hash index.

Shard files: the packed ids of its documents in ascending key order and nothing
between them (unsigned 16-bit if the vocabulary allows, else 32-bit; the end id
0 closes every document), then a directory (keys and token counts), its length,
and one more end id that closes the file.  The end id is a run of zero bytes
and so is the record separator of Spark's text writer: each row carries a
document without its end id and the writer adds it.  Thus shards are written by
Spark's own committer, row by row, to any file system it knows.

Index: keys are hashed into buckets; each bucket holds a minimal perfect hash
(levels of bit arrays: a key that is alone on its position stays there, the
others go on to the next level) whose slots store a fingerprint of the key, the
shard, the ordinal there, how many documents share the key, the offset of the
first in ids and its length.  A lookup costs a fixed number of probes.

Cases: a null or empty text is the end id alone; a null key sorts first, is
stored, and can't be looked up; repeated keys are stored one after another and
a lookup finds all of them; an empty table gives an empty store.
"""

from __future__ import annotations

import math
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferret.llm.common import scratch, stored, text_of
from ferret.llm.encoder import batches, encoder, id_width

NO_KEY = -(1 << 63)  # stands for a null key in a directory
SHARD_TEXT_BYTES = 16 << 20
KEYS_PER_BUCKET = 100_000
DIRECTORY = "shard int, ordinal int, key long, at long, n long, ids_crc32 long"
ENTRY = "shard int, ordinal int, n_docs int, at long, n long"


def write_ids(docs: DataFrame, path: str, tokenizer: str, *, rule: str | None = "byte_level",
              shard_text_bytes: int = SHARD_TEXT_BYTES) -> None:
    """Encode every document and write the shards; range-partitioned by key, sorted within."""
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_text_bytes))
    width = id_width(tokenizer)

    def encode(rows):
        enc, keys, counts, any_row = encoder(tokenizer, rule, width), [], [], False

        def row(raw):
            return pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["raw"])

        for batch in rows:
            any_row = any_row or batch.num_rows > 0
            keys += [NO_KEY if k is None else k for k in batch.column(0).to_pylist()]
            for part in batches(batch.column(1).to_pylist()):
                out = enc.encode(part)
                counts += [len(raw) // width + 1 for raw in out]  # with the end id
                yield row(out)
        if any_row:
            directory = np.array(keys, "<i8").tobytes() + np.array(counts, "<i8").tobytes()
            yield row([directory + struct.pack("<qq", len(keys), width)])

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
     .repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(encode, "raw binary").select(F.col("raw").cast("string").alias("value"))
     .write.option("lineSep", "\0" * width).text(path))


def _open_shard(data: bytes):
    """Directory and payload of a shard's bytes: keys, token counts, packed ids."""
    for width in (2, 4):  # the closing end id is as wide as an id
        n, told = struct.unpack_from("<qq", data, len(data) - width - 16)
        if told == width and 0 <= n <= len(data) // 16:
            break
    else:
        raise ValueError("not a shard of token ids")
    at = len(data) - width - 16 - 16 * n
    keys, counts = np.frombuffer(data, "<i8", n, at), np.frombuffer(data, "<i8", n, at + 8 * n)
    if int(counts.sum()) * width != at:
        raise ValueError("a shard's directory and payload disagree")
    return keys, counts, np.frombuffer(data, f"<u{width}", at // width)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, in shard and ordinal order within a file, with the CRC-32 of its 32-bit ids."""
    def read(rows):
        for batch in rows:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                if not data:
                    continue
                shard = int(re.search(r"part-(\d+)", name)[1])
                keys, counts, ids = _open_shard(data)
                at = np.concatenate([[0], np.cumsum(counts)])
                crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), shard, np.int32)), pa.array(np.arange(len(keys), dtype=np.int32)),
                     pa.array(keys, mask=keys == NO_KEY), pa.array(at[:-1]), pa.array(counts), pa.array(crc, pa.int64())],
                    ["shard", "ordinal", "key", "at", "n", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(read, DIRECTORY)


# ---- minimal perfect hash -------------------------------------------------

def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys (a multiply-and-shift finalizer); different for each seed."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


FINGERPRINT_SEED = 1 << 20


class PerfectHash:
    """Levels of bit arrays over distinct keys; a key's slot is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.ranks = [np.cumsum(x) - x for x in levels]  # set bits before each position

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 2.0) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, int(spread * len(left)))
            place = mix(left, len(levels)) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has it; a foreign key may get any slot."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            place = (mix(keys[todo], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[todo[hit]] = self.before[k] + self.ranks[k][place[hit]]
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return sizes + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(raw, "<i8", n, 8).tolist(), 8 + 8 * n, []
        for size in sizes:
            m = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, m, at), count=size).astype(np.int64))
            at += m
        return cls([x.astype(bool) for x in levels])


SLOT_TYPES = {"shard": "<i4", "ordinal": "<i4", "n_docs": "<i4", "at": "<i8", "n": "<i8"}


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def build_index(directory: DataFrame, path: str, *, keys_per_bucket: int = KEYS_PER_BUCKET) -> None:
    """Write the index of a stored directory: one row per bucket of keys."""
    entries = (directory.where(F.col("key").isNotNull()).groupBy("key")
               .agg(F.min(F.struct("shard", "ordinal", "at", "n")).alias("e"), F.count("*").cast("int").alias("n_docs"))
               .select("key", "e.*", "n_docs"))
    buckets = max(1, math.ceil(directory.count() / keys_per_bucket))

    def build(pdf):
        keys = pdf["key"].to_numpy()
        mph = PerfectHash.build(keys)
        order = np.argsort(mph.slots(keys))
        row = {"bucket": int(pdf["bucket"].iloc[0]), "n_keys": len(keys), "hash": mph.dump(),
               "fingerprints": mix(keys[order], FINGERPRINT_SEED).astype("<u8").astype("<u4").tobytes()}
        return pd.DataFrame([row | {c: pdf[c].to_numpy()[order].astype(t).tobytes() for c, t in SLOT_TYPES.items()}])

    schema = "bucket int, n_keys long, hash binary, fingerprints binary, " + ", ".join(f"{c} binary" for c in SLOT_TYPES)
    (entries.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(build, schema)
     .withColumn("buckets", F.lit(buckets)).write.parquet(path))


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Where the documents of ``keys`` (column key) lie: key plus the slot's entry; absent keys give no row."""
    first = index.select("buckets").first()
    schema = f"key long, {ENTRY}"
    if first is None:
        return keys.sparkSession.createDataFrame([], schema)

    def probe(asked, blob):
        if not len(blob) or not len(asked):
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        b, k = blob.iloc[0], asked["key"].to_numpy()
        slots = PerfectHash.load(b["hash"]).slots(k)
        prints = np.frombuffer(b["fingerprints"], "<u4")
        ok = slots >= 0
        ok[ok] = prints[slots[ok]] == mix(k[ok], FINGERPRINT_SEED).astype("<u4")
        return pd.DataFrame({"key": k[ok]} | {c: np.frombuffer(b[c], t)[slots[ok]] for c, t in SLOT_TYPES.items()})

    asked = keys.where(F.col("key").isNotNull()).select("key").distinct().withColumn("bucket", _bucket(first[0]))
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, schema)


def fetch(keys: DataFrame, index: DataFrame, path: str) -> DataFrame:
    """Keyed access: key and packed 32-bit ids of each stored document, reading the hit shards only."""
    spark = keys.sparkSession
    where = look_up(keys, index).groupBy("shard").agg(F.collect_list(F.struct("key", "at", "n", "n_docs", "ordinal")).alias("want"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .withColumn("shard", F.regexp_extract("path", r"part-(\d+)", 1).cast("int")))

    def cut(rows):
        for batch in rows:
            keys_out, ids_out = [], []
            for r in batch.to_pylist():
                _, counts, ids = _open_shard(r["content"])
                at = np.concatenate([[0], np.cumsum(counts)])
                for w in r["want"]:
                    for k in range(w["ordinal"], w["ordinal"] + w["n_docs"]):
                        keys_out.append(w["key"])
                        ids_out.append(ids[at[k]:at[k + 1]].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys_out, pa.int64()), pa.array(ids_out, pa.binary())], ["key", "ids"])

    return files.join(where, "shard").select("content", "want").mapInArrow(cut, "key long, ids binary")


def store_and_read(docs: DataFrame, tokenizer: str, *, rule: str | None = "byte_level",
                   shard_text_bytes: int = SHARD_TEXT_BYTES, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """Write the store of ``docs``, look every key up in its index and digest what the shards hold there."""
    spark = docs.sparkSession
    path, index_path = scratch(spark, "ids"), scratch(spark, "id-index")
    write_ids(docs, path, tokenizer, rule=rule, shard_text_bytes=shard_text_bytes)
    directory = stored(read_directory(spark, path), "id-directory")
    build_index(directory, index_path, keys_per_bucket=keys_per_bucket)
    found = look_up(docs.select(F.col("doc_id").cast("long").alias("key")), spark.read.parquet(index_path))
    one = F.explode(F.sequence(F.lit(0), F.col("n_docs") - 1))
    places = found.select("key", "shard", "ordinal", "n_docs", one.alias("k")).select(
        F.col("key").alias("doc_id"), "shard", (F.col("ordinal") + F.col("k")).alias("ordinal"))
    # rows without an id have no key; their places are those of the directory
    places = places.unionByName(directory.where("key IS NULL").select(F.col("key").alias("doc_id"), "shard", "ordinal"))
    # one row per shard: the prefix sum over them is small
    bases = directory.groupBy("shard").agg(F.sum("n").alias("ids")).withColumn(
        "base", F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).select("shard", "base")
    return (places.join(directory, ["shard", "ordinal"]).join(bases, "shard")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32"))
