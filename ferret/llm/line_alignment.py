"""Operator 6: line dedup by pairwise alignment.

Lines are normalised (letters lower-cased, white space collapsed) and hashed.
Exact copies of a text are represented by the copy with the smallest id.  Texts
are paired by what they share; every later holder of it with its owner, the earliest,
so a thing in n documents gives n - 1 pairs, never all.  With ``every_run`` (the default) the
things are runs of lines with at least ``least_words`` words that follow each other:
the shortest from each line on, and up to each line.  Any common block holds some,
and none is too frequent to link.  Without it they are the rare lines, which at least
two and at most ``rare_share`` of the distinct texts (at least ``rare_least``) hold;
blocks of frequent lines only, or of lines owned by several texts, can then be missed.

Each pair is aligned with patience diff over the line hashes of both documents;
runs of aligned lines that are consecutive in both, with at least ``least_words``
words, are common blocks and are deleted from the later document (that with the
larger id).  What is left of it is aligned again, which reaches passages held twice or moved;
runs without any line that is unique in both are looked up.  A copy
is aligned with the first as a whole.

Cases: null and empty texts have no lines; lines without words neither link
nor match, and stay unless the whole text goes; repeated rows (equal id and
text) are one document, so none of them is later; rows with a null doc_id are left as they are;
an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import WORD_SPACE, free_name, stored, text_of
from ferret.llm.words import forgetting, mixed

RARE_SHARE = 0.05
RARE_LEAST = 20
LEAST_WORDS = 10
LINK_WORDS = 3
ROUNDS = 16  # alignments of one pair; what they leave is looked up
PAIRS = 256  # pairs of one owner that meet in one copy of its row
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _longest_rising(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience sorting)."""
    tops, at, back = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(at[k - 1] if k else -1)
        tops[k:k + 1], at[k:k + 1] = [v], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned (index in a, index in b) of equal lines, rising in both; None never matches."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] is not None and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] is not None and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if x is not None and in_b[x] == 1 and in_a[x] == 1}
        both = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if x in place]
        anchors = [both[k] for k in _longest_rising([j for _, j in both])]
        if not anchors:
            continue
        # the stretches between anchors; each begins with an anchor, which its prefix rule takes
        edges = [(a0, b0), *anchors, (a1, b1)]
        todo += [(i, i2, j, j2) for (i, j), (i2, j2) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


def _shortest_runs(keys: list, words: list[int], least_words: int) -> list[tuple[int, int]]:
    """(begin, end) of the shortest run with enough words from each line on, and up to each line."""
    out, end, total = set(), 0, 0
    for k in range(len(keys)):
        while end < len(keys) and total < least_words:
            total, end = total + words[end], end + 1
        if total >= least_words:
            out.add((k, end))
        total -= words[k]
    begin, total = 0, 0
    for k in range(len(keys)):
        total += words[k]
        while total - words[begin] >= least_words:
            total, begin = total - words[begin], begin + 1
        if total >= least_words:
            out.add((begin, k + 1))
    return sorted(out)


def _parts(keys: list, keep) -> list[list[int]]:
    """The maximal stretches of indices that ``keep`` holds."""
    parts: list[list[int]] = [[]]
    for k in range(len(keys)):
        if keep(k):
            parts[-1].append(k)
        elif parts[-1]:
            parts.append([])
    return parts


def common_blocks(a: list, b: list, words: list[int], least_words: int) -> list[int]:
    """Lines of ``b`` in runs that follow each other in both documents and have enough words.

    Lines without a word (None) between two lines don't end a run.  ``a`` is aligned with
    ``b``; each aligned stretch is extended along its diagonal to the whole common run.  A run
    with enough words goes; a line that is unique in both and whose run is too short is
    settled, since it has no other.  What is left of ``b`` is aligned again (second copies and
    moved blocks become unique or rising then) until a round settles nothing.  Lines
    that are still repeated in one of the two have no alignment; the common runs among them
    and the deleted lines are looked up.  So every common run goes, and only those.
    """
    xs = [x for x in a if x is not None]
    at_b = [j for j, x in enumerate(b) if x is not None]
    ys, size = [b[j] for j in at_b], [words[j] for j in at_b]
    in_a = Counter(xs)
    left = [y in in_a for y in ys]
    gone: set[int] = set()
    for k in range(ROUNDS):
        in_b = Counter(y for y, more in zip(ys, left, strict=True) if more)
        settled, i0, j0 = False, -1, -1
        # after the first round by lines that are unique in both alone: each has one partner, so a round settles some
        for i, j in patience(xs, [y if more and (k == 0 or in_a[y] == in_b[y] == 1) else None for y, more in zip(ys, left, strict=True)]):
            if i - j != i0 - j0 or j >= j0:  # not on the run of the pair before
                lo = hi = 0
                while i - lo and j - lo and xs[i - lo - 1] == ys[j - lo - 1]:
                    lo += 1
                while i + hi < len(xs) and j + hi < len(ys) and xs[i + hi] == ys[j + hi]:
                    hi += 1
                i0, j0 = i + hi, j + hi
                if sum(size[j - lo:j0]) >= least_words:
                    gone.update(range(j - lo, j0))
            if j in gone or in_a[ys[j]] == in_b[ys[j]] == 1:
                settled, left[j] = True, False
        for j in gone:
            left[j] = False
        if not settled and k:
            break
    else:
        in_b = Counter()  # the rest of many rounds is looked up, unique or not
    if any(left):
        free = [j in gone or (left[j] and (in_a[y] > 1 or in_b[y] != 1)) for j, y in enumerate(ys)]
        length = dict(zip(ys, size, strict=True))  # equal lines have equally many words
        held = set()
        for part in _parts(xs, lambda k: xs[k] in length):
            held.update(tuple(xs[k] for k in part[i:j]) for i, j in _shortest_runs(part, [length[xs[k]] for k in part], least_words))
        for part in _parts(ys, lambda k: free[k]):
            for i, j in _shortest_runs(part, [size[k] for k in part], least_words):
                if any(left[k] for k in part[i:j]) and tuple(ys[k] for k in part[i:j]) in held:
                    gone.update(part[i:j])
    return sorted(at_b[j] for j in gone)


def _runs_of(of: np.ndarray, keys: np.ndarray, words: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of lines of many texts (``of`` numbers the texts): per shortest run, its text and its hash.

    The runs are those of ``_shortest_runs``; a line has a word at least, so a run has at most ``least_words`` lines.
    """
    n = len(keys)
    size = np.zeros((2, n), np.int64)
    hashes = np.zeros(n, np.uint64)
    for way in (0, 1):  # from each line on, up to each line
        total = np.zeros(n, np.int64)
        live = np.arange(n)
        for k in range(least_words):
            at = live - k if way else live + k
            inside = (at >= 0) & (at < n)
            live, at = live[inside], at[inside]
            same = of[at] == of[live]
            live, at = live[same], at[same]
            if way == 0:
                hashes[live] = mixed(hashes[live] * np.uint64(0x9E3779B97F4A7C15) + keys[at])
            total[live] += words[at]
            full = total[live] >= least_words
            size[way, live[full]] = k + 1
            live = live[~full]
            if not len(live):
                break
    ahead = np.flatnonzero(size[0])
    # a run up to a line that isn't the shortest from its own first line on
    back = np.flatnonzero(size[1])
    begin = back - size[1, back] + 1
    extra = size[0, begin] != size[1, back]
    back, begin = back[extra], begin[extra]
    h = np.zeros(len(back), np.uint64)
    for k in range(int(size[1, back].max()) if len(back) else 0):
        more = np.flatnonzero(size[1, back] > k)
        h[more] = mixed(h[more] * np.uint64(0x9E3779B97F4A7C15) + keys[begin[more] + k])
    return np.concatenate([of[ahead], of[back]]), np.concatenate([hashes[ahead], h])


def run_table(lines: DataFrame, least_words: int) -> DataFrame:
    """doc_id, text_key and the hash of each distinct shortest run of a text with enough words."""
    def make(batches):
        for batch in batches:
            keys, words = batch.column(2), batch.column(3)
            of = np.repeat(np.arange(batch.num_rows), pa.compute.fill_null(pa.compute.list_value_length(keys), 0).to_numpy(zero_copy_only=False))
            flat = pa.compute.list_flatten(keys)
            real = flat.is_valid().to_numpy(zero_copy_only=False)
            flat = flat.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)[real]
            texts, hashes = _runs_of(of[real], flat, pa.compute.list_flatten(words).to_numpy(zero_copy_only=False)[real], least_words)
            rows = np.unique(np.stack([texts.astype(np.int64), hashes.view(np.int64)], axis=1), axis=0)
            at = pa.array(rows[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(rows[:, 1])],
                                             ["doc_id", "text_key", "key"])

    return lines.select("doc_id", "text_key", "keys", "words").mapInArrow(forgetting(make), "doc_id long, text_key long, key long")


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), WORD_SPACE, " "))


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, hash per line (null without a word), words per line."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.transform(F.split("text", "\n"), lambda x: _normalised(x)).alias("lines"))
    has = lambda x: x.rlike(_HAS_WORD)
    return rows.select("doc_id", "text_key", F.transform("lines", lambda x: F.when(has(x), F.xxhash64(x))).alias("keys"),
                       F.transform("lines", lambda x: F.when(has(x), F.size(F.split(x, " "))).otherwise(0)).alias("words"))


def removed_lines(docs: DataFrame, *, every_run: bool = True, rare_share: float = RARE_SHARE, rare_least: int = RARE_LEAST,
                  least_words: int = LEAST_WORDS, link_words: int = LINK_WORDS) -> DataFrame:
    """doc_id, text_key, the sorted indices of lines to delete and the number of documents they were aligned with."""
    lines = stored(line_table(docs).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text_key"]), "lines")
    firsts = lines.groupBy("text_key").agg(F.min("doc_id").alias("first"))
    firsts = stored(firsts, "first-texts")
    rows = lines.join(firsts, "text_key")
    # runs or lines of distinct texts link; of the lines only the longer ones
    if every_run:
        held, most = run_table(rows.where("doc_id = first"), least_words), F.lit(True)
    else:
        held = (rows.where("doc_id = first")
                .select("doc_id", "text_key", F.explode(F.array_distinct(F.arrays_zip("keys", "words"))).alias("x"))
                .where((F.col("x.words") >= link_words)).select("doc_id", "text_key", F.col("x.keys").alias("key")))
        most = F.col("n") <= max(rare_least, rare_share * firsts.count())
    shared = (held.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key")).alias("owner"))
              .where((F.col("n") > 1) & most).select("key", "owner"))
    pairs = (held.join(shared, "key").where(F.col("doc_id") > F.col("owner.doc_id"))
             .select("doc_id", "text_key", F.col("owner.doc_id").alias("own_id"), F.col("owner.text_key").alias("own_key")).distinct())
    pairs = stored(pairs, "pairs")
    # an owner of many pairs is dealt out: its row is copied once for every PAIRS of them
    copies = pairs.groupBy("own_id", "own_key").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("copies"))
    earlier = (lines.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), F.col("keys").alias("own_keys"))
               .join(copies, ["own_id", "own_key"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies"))
    dealt = (pairs.join(copies, ["own_id", "own_key"])
             .withColumn("copy", F.pmod(F.xxhash64("doc_id", "text_key"), F.col("copies")).cast("int")).drop("copies"))
    lined = dealt.join(earlier, ["own_id", "own_key", "copy"]).join(lines, ["doc_id", "text_key"])

    @F.pandas_udf("array<int>")
    def align(own, keys, words):
        import pandas as pd

        def listed(x):  # a null in a list of longs arrives as NaN among floats: those lists are sent as strings instead
            return [None if v is None else v for v in x]

        return pd.Series([common_blocks(listed(a), listed(b), list(w), least_words)
                          for a, b, w in zip(own, keys, words, strict=True)])

    align = align.asNondeterministic()  # else a filter on its result would run it twice
    text = lambda c: F.transform(c, lambda k: k.cast("string"))
    aligned = lined.select("doc_id", "text_key", align(text("own_keys"), text("keys"), "words").alias("gone"))
    whole = (rows.where("doc_id > first").select("doc_id", "text_key", F.transform(
        F.filter(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))), lambda x: x["k"].isNotNull()),
        lambda x: x["i"]).alias("gone"), "words"))
    whole = whole.where(F.aggregate("words", F.lit(0), lambda s, w: s + w) >= least_words).select("doc_id", "text_key", "gone")
    return (aligned.unionByName(whole).where(F.size("gone") > 0).groupBy("doc_id", "text_key")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"),
                 F.count("*").alias("n_aligned")))


def delete_blocks(docs: DataFrame, **limits) -> DataFrame:
    """The documents with their columns, without the deleted lines, plus ``line_report`` (n_lines, n_removed, n_aligned).

    An input column of that name stays; the report is then ``line_report_2`` (or the next free number).  A text whose lines with words are all deleted becomes empty.
    """
    report = free_name("line_report", docs.columns)
    gone = removed_lines(docs, **limits).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone", "n_aligned")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(text_of()).alias("own_key"))
    rows = rows.join(gone, (F.col("own_id") == F.col("gone_id")) & (F.col("own_key") == F.col("gone_key")), "left")
    old = F.col("row")["text"].cast("string")
    lines = F.split(F.coalesce(old, F.lit("")), "\n")
    rows = rows.select("row", "gone", "n_aligned", F.size(lines).cast("long").alias("n_lines"), F.when(
        F.col("gone").isNotNull(), F.filter(lines, lambda x, i: ~F.array_contains("gone", i))).alias("left"))
    some = F.exists("left", lambda x: x.rlike(_HAS_WORD))
    text = F.when(F.col("gone").isNull(), old).when(some, F.array_join("left", "\n")).otherwise(F.lit(""))
    rows = rows.select("row", "gone", text.alias("text"), F.struct(
        "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_aligned", F.lit(0).cast("long")).alias("n_aligned")).alias("report"))

    def column(c):
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return (F.when(F.col("gone").isNull(), F.col("row")[c])
                    .otherwise(F.char_length("text").cast(docs.schema[c].dataType)).alias(c))
        return F.col("row")[c].alias(c)

    return rows.select(*[column(c) for c in docs.columns], F.col("report").alias(report))
