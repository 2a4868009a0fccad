"""Operator 1: best-fit packing of token sequences.

Documents are encoded, closed with an end id and cut into pieces of at most
``capacity`` tokens.  Packing decides on the histogram of piece lengths, which
has at most ``capacity`` rows however large the corpus: pieces of equal length
are interchangeable.

* Pieces above a third of the capacity fit at most twice into a sequence: from
  the longest down, each length is matched with the longest length that still
  fits (greedy matching, whole classes at a time).
* Shorter pieces, from the longest down, go to the tightest remaining gap.

The plan is a small table of placements: which ranks within a length go to
which run of sequences, at which offset.  Its size is bounded: a gap that takes
pieces of length s keeps less than half of itself, so it is used at most
log2(capacity) times, and every length opens at most two new gap classes; with a
capacity of 4096 that is below 200,000 rows whatever the input.  Pieces get a
rank within their length (salted, so that one hot length is many tasks) and
look up their placement with a broadcast join.

Cases: a null or empty text is the end id alone; repeated rows are packed each;
a null id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferret.llm.common import stored, text_of
from ferret.llm.encoder import batches, encoder
from ferret.llm.words import give_back

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encode_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1,
                  rule: str | None = "word_ends", with_ids: bool = False, forget: bool = False) -> DataFrame:
    """One row per piece of every document; ``ids`` (packed 32-bit) only when asked for.

    ``forget`` drops the encoder after each task: slower, but nothing stays in worker processes that later stages reuse.
    """
    end = end_id.to_bytes(4, "little")
    schema = PIECES + (", ids binary" if with_ids else "")

    def encode(rows):
        try:
            yield from pieces(rows, encoder(tokenizer, rule))
        finally:
            if forget:
                encoder.cache_clear()
                give_back()

    def pieces(rows, enc):
        for batch in rows:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cols = ([], [], [], [], [], [])
            for key, raw in zip(keys, chain.from_iterable(map(enc.encode, batches(texts))), strict=True):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[at:at + 4 * capacity]
                    for col, v in zip(cols, (key, k, at // 4, len(ids) // 4, zlib.crc32(ids), ids), strict=True):
                        col.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            n = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types[:n], strict=True)], names[:n])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(encode, schema)


def plan_sequences(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Placements (length, lo, hi, sequence, offset, per_sequence) and the number of sequences.

    The piece of rank r (lo <= r < hi) of that length goes to sequence
    ``sequence + (r - lo) // per_sequence`` at ``offset + (r - lo) % per_sequence * length``.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    rank = dict.fromkeys(left, 0)
    rows: list[tuple] = []
    gaps: list[int] = []  # sorted sizes of gaps
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, how many)
    n_sequences = 0

    def put(size, sequence, count, offset, each=1):
        rows.append((size, rank[size], rank[size] + count * each, sequence, offset, each))
        rank[size] += count * each
        left[size] -= count * each

    def leave(gap, sequence, count):
        if gap and count:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((sequence, count))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        k = bisect_left(large, capacity - a + 1) - 1  # the longest that fits beside a
        if k >= 0 and large[k] == a and left[a] < 2:
            k -= 1
        b = large[k] if k >= 0 else None
        count = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        put(a, n_sequences, count, 0)
        if b is not None:
            put(b, n_sequences, count, a)
        leave(capacity - a - (b or 0), n_sequences, count)
        n_sequences += count
        large = [s for s in large if left[s]]
    for s in sorted((s for s in left if left[s]), reverse=True):
        while left[s]:
            k = bisect_left(gaps, s)
            if k == len(gaps):  # no gap takes it: open sequences
                each = min(capacity // s, left[s])
                leave(capacity, n_sequences, left[s] // each)
                n_sequences += left[s] // each
                continue
            gap = gaps[k]
            first, count = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], gaps[k]
            each = min(gap // s, left[s])
            used = min(count, left[s] // each)
            put(s, first, used, capacity - gap, each)
            leave(gap - each * s, first, used)
            leave(gap, first + used, count - used)
    return rows, n_sequences


def assign_sequences(pieces: DataFrame, *, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) plus sequence_id and offset.

    ``pieces`` is read twice, so it should be a stored table.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, _ = plan_sequences(histogram, capacity)
    schema = "length long, lo long, hi long, sequence long, place long, each long"
    plan = spark.createDataFrame(rows, schema)
    # ranks: about as many salts as rows under one salt of the most frequent length
    salts = max(1, math.isqrt(max(histogram.values(), default=0)))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    bases = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
             .withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
             .select("length", "salt", "base"))
    ranked = (salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
        .join(bases, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base")))
    at = F.col("rank") - F.col("lo")
    return (ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"])
                        & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select(*[pieces[c] for c in pieces.columns],
                    (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("place") + at % F.col("each") * pieces["length"]).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1,
                   rule: str | None = "word_ends", with_ids: bool = False, forget: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = encode_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, rule=rule, with_ids=with_ids, forget=forget)
    return assign_sequences(stored(pieces, "pieces"), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack_documents(..., with_ids=True)``: at most ``capacity`` ids each."""
    def join(key, pdf):
        pdf = pdf.sort_values("offset")
        pdf = pdf.iloc[:1].assign(ids=b"".join(pdf["ids"]), n_pieces=len(pdf))
        return pdf[["sequence_id", "n_pieces", "ids"]]

    return packed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, n_pieces long, ids binary")
