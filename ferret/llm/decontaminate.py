"""Operator 3: benchmark decontamination with spaced seeds.

Words are runs of letters and digits, lower-cased.  Fixed masks look at 6 of up to
11 words in a row, so a substituted word spoils only the seeds that look at it.
Every overlap that the verification accepts by default has a seed: a stretch with
24 equal words or more splits into two of which one is accepted too, what is left
has at most 5 mismatches, and the masks were chosen to hit all of those (the tests
try each).  Seeds of benchmark items and of documents are joined by their
hash; a hit fixes a diagonal (document position minus item position), and there
the overlap is verified over all stretches: one must hold at least ``least_matched``
equal words, at least ``least_ratio`` of its length.

A document has a seed hash per word and mask, far too many to shuffle.  The
benchmark's seeds set bits in a filter of fixed size (2 MB, whatever the benchmark;
a larger one only lets more false candidates through to the join), and only
document seeds that pass it, with the word hashes of their document, go on.

Items with fewer than ``least_matched`` words can't reach it.  With ``short_items``
they match where all their words stand in a row, found by one hash of the whole
item; without, they match nothing.

Cases: null and empty texts and items have no seeds; a hit at a
document's edge is verified over the words that exist; repeated rows give one
result; rows with a null doc_id are reported under null; empty tables give an
empty result.
"""

from __future__ import annotations

import re
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.bits import build_filter, passing
from ferret.llm.common import stored, text_of
from ferret.llm.encoder import batches
from ferret.llm.words import KNOWN, combined, forgetting

# 1: the word counts, 0: it is ignored
MASKS = ("111111", "1111011", "11001000111", "11010100011")
LEAST_MATCHED = 12
LEAST_RATIO = 0.8
WHOLE = 1000  # seeds of whole items of n words are numbered from here

FIND = re.compile(r"[^\W_]+").findall


def word_hashes(text: str) -> np.ndarray:
    words = FIND(text.lower())
    return KNOWN.of(words, len(words))


def seeds_of(hashes: np.ndarray, masks=MASKS, lengths=()):
    """Per mask, and per length of a whole short item, its span and the seed at each start."""
    for seed, m in enumerate(masks):
        yield len(m), combined(hashes, [k for k, c in enumerate(m) if c == "1"], seed)[:max(0, len(hashes) - len(m) + 1)]
    for n in lengths:
        yield n, combined(hashes, list(range(n)), WHOLE + n)


def seed_hits(texts: list[str], flags: np.ndarray, lengths=()):
    """Yields (number of the text, its word hashes, passing seeds and where they start) for texts that have any.

    The texts' words stand in one array, so the arithmetic is done for all at once.
    """
    words = [FIND(t.lower()) for t in texts]
    sizes = np.array([len(w) for w in words])
    end = np.cumsum(sizes)
    hashes = KNOWN.of(chain.from_iterable(words), int(end[-1]) if len(end) else 0)
    at, of, seeds = [], [], []
    for span, found in seeds_of(hashes, lengths=lengths):
        hit = passing(flags, found)
        text = np.searchsorted(end, hit, "right")
        inside = hit + span <= end[text]
        at.append(hit[inside])
        of.append(text[inside])
        seeds.append(found[hit[inside]])
    at, of, seeds = np.concatenate(at), np.concatenate(of), np.concatenate(seeds).view(np.int64)
    for k in np.unique(of).tolist():
        mine, begin = of == k, int(end[k] - sizes[k])
        yield k, hashes[begin:int(end[k])], seeds[mine].tolist(), (at[mine] - begin).tolist()


def best_overlap(a: np.ndarray, b: np.ndarray, least_ratio: float = LEAST_RATIO) -> tuple[int, int]:
    """Equal words and length of the stretch of two aligned word sequences with most equal words among
    all stretches in which they are at least ``least_ratio`` of the length."""
    ratio = Fraction(str(least_ratio))
    found = np.concatenate([[0], np.cumsum(a == b)])
    # a stretch qualifies if its score is no smaller at its end than at its start
    score = ratio.denominator * found - ratio.numerator * np.arange(len(found))
    start = np.searchsorted(-np.minimum.accumulate(score), -score)  # the first place with no larger score
    end = int(np.argmax(found - found[start]))
    first = found[start[end]]
    begin = int(np.searchsorted(found, first, "right")) - 1 if found[end] > first else end  # no mismatch leads
    return int(found[end] - first), end - begin


def benchmark_seeds(benchmark: DataFrame, whole_below: int = 0) -> DataFrame:
    """item_id, the item's word hashes (packed), seed, and where the seed starts.

    Items with fewer than ``whole_below`` words have one seed, of all their words.
    """
    def make(rows):
        for batch in rows:
            cols = ([], [], [], [])
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = word_hashes(text)
                whole = 0 < len(hashes) < whole_below
                for _, seeds in seeds_of(hashes, () if whole else MASKS, (len(hashes),) if whole else ()):
                    for pos, s in enumerate(seeds.view(np.int64).tolist()):
                        for col, v in zip(cols, (item, hashes.tobytes(), s, pos), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int32()), strict=True)],
                ["item_id", "item_words", "seed", "item_pos"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    return items.mapInArrow(forgetting(make), "item_id long, item_words binary, seed long, item_pos int")


def candidates(docs: DataFrame, flags: np.ndarray, lengths=()) -> DataFrame:
    """Documents with a seed that passes the filter: id, text key, word hashes, and the passing seeds."""
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def scan(rows):
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("pos", pa.int32()), ("seed", pa.int64())])))
        for batch in rows:
            docs_, keys, texts = (c.to_pylist() for c in batch.columns)
            out, first = [], 0
            for part in batches(texts):
                for k, hashes, seeds, at in seed_hits(part, shared.value, lengths):
                    hits = [{"pos": p, "seed": s} for p, s in zip(at, seeds, strict=True)]
                    out.append((docs_[first + k], keys[first + k], hashes.tobytes(), hits))
                first += len(part)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)],
                                             ["doc_id", "text_key", "words", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"),
                       text_of().alias("text"))
    return rows.mapInArrow(forgetting(scan), "doc_id long, text_key long, words binary, hits array<struct<pos:int,seed:bigint>>")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, least_matched: int = LEAST_MATCHED,
                  least_ratio: float = LEAST_RATIO, short_items: bool = True) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, text_key, item_id, n_matched, n_span, item_words, doc_pos."""
    seeds = stored(benchmark_seeds(benchmark, least_matched if short_items else 0), "benchmark-seeds")
    n_words = F.expr("octet_length(item_words) div 8").cast("int")
    lengths = [r[0] for r in seeds.select(n_words.alias("n")).where(F.col("n") < least_matched).distinct().collect()] if short_items else []
    found = stored(candidates(docs, build_filter(seeds, "seed"), lengths), "seed-hits")
    hits = found.select("doc_id", "text_key", F.explode(F.array_distinct("hits")).alias("hit")).select("doc_id", "text_key", "hit.*")
    where = (hits.join(seeds.select("seed", "item_id", "item_pos"), "seed")
             .groupBy("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(F.count("*").alias("n_seeds")))
    items = seeds.select("item_id", "item_words").distinct()
    texts = found.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "words").dropDuplicates(["d", "k"])
    lined = where.join(items, "item_id").join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    first = F.greatest(F.col("diagonal"), F.lit(0))
    skip = first - F.col("diagonal")  # words of the item before the document begins
    lined = lined.select(
        "doc_id", "text_key", "item_id", first.alias("doc_pos"), F.expr("octet_length(item_words) div 8").alias("n_item"),
        F.substring("item_words", skip * 8 + 1, F.octet_length("item_words")).alias("a"),
        F.substring("words", first * 8 + 1, F.octet_length("item_words") - skip * 8).alias("b"))

    @F.pandas_udf("n_matched int, n_span int")
    def verify(a, b):
        import pandas as pd

        out = []
        for x, y in zip(a, b, strict=True):
            n = min(len(x), len(y)) // 8
            out.append(best_overlap(np.frombuffer(x, np.uint64, n), np.frombuffer(y, np.uint64, n), least_ratio))
        return pd.DataFrame(out, columns=["n_matched", "n_span"])

    verify = verify.asNondeterministic()  # else a filter on its result would run it twice
    checked = lined.select("doc_id", "text_key", "item_id", "n_item", "doc_pos", verify("a", "b").alias("v"))
    checked = checked.select("doc_id", "text_key", "item_id", "n_item", "doc_pos", "v.*")
    needed = F.least(F.lit(least_matched), F.col("n_item")) if short_items else F.lit(least_matched)
    ok = F.col("n_matched") >= needed
    best = F.max(F.struct("n_matched", (-F.col("doc_pos")).alias("neg"), "n_span")).alias("best")
    return (checked.where(ok).groupBy("doc_id", "text_key", "item_id").agg(F.max("n_item").alias("item_words"), best)
            .select("doc_id", "text_key", "item_id", F.col("best.n_matched").cast("long").alias("n_matched"),
                    F.col("best.n_span").cast("long").alias("n_span"), F.col("item_words").cast("long").alias("item_words"),
                    (-F.col("best.neg")).cast("long").alias("doc_pos")))


def overlapping_documents(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_matched, n_span, item_words, doc_pos."""
    out = find_overlaps(docs, benchmark, **limits)
    cols = ["n_matched", "n_span", "item_words", "doc_pos"]
    return (out.groupBy("doc_id", "item_id").agg(F.max(F.struct(*cols)).alias("best"))
            .select("doc_id", "item_id", "best.*"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    bad = find_overlaps(docs, benchmark, **limits).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(text_of()).alias("own_key"))
    kept = rows.join(bad, F.col("own_id").eqNullSafe(F.col("bad_id")) & (F.col("own_key") == F.col("bad_key")), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
