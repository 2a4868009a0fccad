"""Operator 13: maximal periodic runs of words, and their collapse.

A run is a stretch of words with smallest period ``q`` and a length of at least
``max(least, 2 q)`` that no neighbouring word extends.  Two searches find all of
them (a stretch found by both, or with a multiple of its period, counts once,
with its smallest period):

* Direct lag scans for periods below ``SHORT``: words equal to the word ``q``
  places on, in stretches.
* Multi-scale minimizers for the others.  At scale ``s`` the grams have ``k =
  2^(s-1)`` words and a window holds ``k + 1`` grams, ``2^s`` words in all.  A run
  with ``2^s <= q < 2^(s+1)`` holds its first window again ``q`` words on, so both
  select the same place: two equal minimizers at distance ``q``.  Their pairs at
  such a distance seed an extension to both sides.

Equal grams at most ``k / 2`` apart lie in a stretch with a shorter period.  They
form one cluster (first place, last place, step).  Lags within a cluster belong to
that shorter run and seed nothing; between two clusters every lag gets one seed,
since all pairs of one lag lie in the same stretch.  Clusters of one gram are over
``k / 2`` apart, so a cluster meets at most nine others, and the seeds of a scale stay
proportional to its minimizers: ``a a a a`` makes no pairs at all.

Words are numbered, so equal numbers are equal words.  Grams and extensions
compare 64-bit hashes built by doubling.  Documents of a batch are scanned together:
one word of its own ends each, which no run can cross.  Memory is 8 bytes a word
and level (logarithm of the longest text); a batch is cut at ``BATCH_WORDS`` words.

Cases: null and empty texts have no words and no runs; repeated rows are
answered each; an empty table gives an empty result; a null doc_id counts as its
text without planted repetition.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import small_batches, text_of
from ferret.llm.words import mixed

LEAST = 12  # words of a run
SHORT_SCALE = 4
SHORT = 1 << SHORT_SCALE  # periods below it are scanned for directly
BATCH_WORDS = 300_000

RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def split_words(text: str) -> list[bytes]:
    """bytes.split() cuts at exactly the six ASCII characters of the word rule."""
    return text.encode("utf-8", "surrogatepass").split()


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends (exclusive) of the stretches of True."""
    edge = np.flatnonzero(same[1:] != same[:-1]) + 1
    if len(same) and same[0]:
        edge = np.append(0, edge)
    if len(same) and same[-1]:
        edge = np.append(edge, len(same))
    return edge[::2], edge[1::2]


def short_runs(x: np.ndarray, least: int):
    """(start, end, period) of all stretches with a period below ``SHORT``."""
    for q in range(1, min(SHORT, len(x) // 2 + 1)):
        a, b = stretches(x[:-q] == x[q:])
        long = b - a + q >= max(least, 2 * q)
        yield a[long], b[long] + q, np.full(int(long.sum()), q, np.int64)


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Places that are the leftmost minimum of some ``w`` consecutive values."""
    value, at, span = h, np.arange(len(h)), 1
    while span < w:
        step = min(span, w - span)
        n = len(value) - step
        if n <= 0:
            return np.empty(0, np.int64)
        right = value[step:] < value[:n]  # ties stay left
        at = np.where(right, at[step:], at[:n])
        value = np.where(right, value[step:], value[:n])
        span += step
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    return at[new]


def doubled(level: np.ndarray, k: int) -> np.ndarray:
    """Hashes of 2k words from those of k words."""
    n = max(0, len(level) - k)
    return mixed(level[:n] * np.uint64(0x9E3779B97F4A7C15) + (level[k:] ^ np.uint64(0xD6E8FEB86659FD93)))


def clusters(places: np.ndarray, grams: np.ndarray, k: int):
    """Equal grams at most k / 2 apart, together: (gram, first, last, step); step 0 for a single place."""
    order = np.lexsort((places, grams))
    p, g = places[order], grams[order]
    gap = p[1:] - p[:-1]
    joined = (g[1:] == g[:-1]) & (2 * gap <= k)
    head = np.flatnonzero(np.append(True, ~joined)) if len(p) else np.empty(0, np.int64)
    last = np.append(head[1:], len(p)) - 1
    step = np.zeros(len(p), np.int64)
    step[1:][joined] = gap[joined]
    step = np.gcd.reduceat(step, head) if len(p) else step
    return g[head], p[head], p[last], step


def seed_lags(first, last, gram, step, low: int):
    """One (place, lag) for each lag in [low, 2 low) between two clusters of a gram."""
    out_at, out_lag = [], []
    for apart in range(1, len(first)):
        a, b = np.arange(len(first) - apart), np.arange(apart, len(first))
        near = (gram[a] == gram[b]) & (first[b] - last[a] < 2 * low)
        if not near.any():
            break
        a, b = a[near], b[near]
        g = np.gcd(step[a], step[b])
        unit = np.maximum(g, 1)
        base = first[b] - first[a]
        lo, hi = np.maximum(first[b] - last[a], low), np.minimum(last[b] - first[a], 2 * low - 1)
        lo = base - (base - lo) // unit * unit  # the least lag from lo on that is congruent to base
        n = np.where(hi >= lo, (hi - lo) // unit + 1, 0)
        n = np.where(g == 0, np.minimum(n, (lo == base)), n)
        pair = np.repeat(np.arange(len(n)), n)
        lag = lo[pair] + (np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)) * unit[pair]
        out_at.append(np.maximum(first[a][pair], first[b][pair] - lag))
        out_lag.append(lag)
    if not out_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_at), np.concatenate(out_lag)


def extended(levels: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The whole stretch with that lag around each seed: (start, end).

    The highest level is over half of the longest text, so each level fits once at most.
    """
    right, left = at.copy(), at.copy()  # places below left and from right on are still open
    for j in range(len(levels) - 1, -1, -1):
        level, k = levels[j], 1 << j
        inside = right + lag < len(level)
        i = np.where(inside, right, 0)
        right = right + np.where(inside & (level[i] == level[np.minimum(i + lag, len(level) - 1)]), k, 0)
        inside = (left >= k) & (left - k + lag < len(level))
        i = np.where(inside, left - k, 0)
        left = left - np.where(inside & (level[i] == level[np.minimum(i + lag, len(level) - 1)]), k, 0)
    return left, right + lag


def find_runs(x: np.ndarray, longest: int, least: int = LEAST, sizes: np.ndarray | None = None):
    """All runs of a sequence of word numbers, as sorted arrays (start, end, period).

    ``longest`` bounds a run's length (the longest document).  ``sizes``: lengths of the
    documents in ``x`` with their end words, not ascending; a scale looks at those that can hold its runs.
    """
    found = list(short_runs(x, least))
    levels = [mixed(x.astype(np.uint64) + np.uint64(1))]
    while 2 << len(levels) <= 2 * longest:
        levels.append(doubled(levels[-1], 1 << (len(levels) - 1)))
    ends = None if sizes is None else np.cumsum(sizes)
    scale = SHORT_SCALE
    while 2 << scale <= longest:
        low, k = 1 << scale, 1 << (scale - 1)
        n = len(x) if ends is None else int(np.append(0, ends)[int((sizes > 2 * low).sum())])
        grams = levels[scale - 1][:max(0, n - k + 1)]
        places = window_minima(grams, k + 1)
        gram, first, last, step = clusters(places, grams[places], k)
        at, lag = seed_lags(first, last, gram, step, low)
        if len(at):
            start, end = extended(levels, at, lag)
            long = end - start >= np.maximum(least, 2 * lag)
            found.append((start[long], end[long], lag[long]))
        scale += 1
    if not found:
        return np.empty((3, 0), np.int64)
    start, end, period = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)  # of one stretch the smallest period is its period
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def planted(doc_id, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a document chosen for a planted repetition."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def runs_of_texts(keys: list, texts: list[str], plant: bool, least: int = LEAST):
    """Per text: (its words, its runs as (start, end, period) arrays)."""
    numbers: dict[bytes, int] = {}
    words, ids = [], []
    for key, text in zip(keys, texts, strict=True):
        w = split_words(text)
        if plant and (source := planted(key, len(w))) is not None:
            w = [w[j] for j in source.tolist()]
        words.append(w)
        ids.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in w), np.int64, len(w)))
    order = sorted(range(len(ids)), key=lambda j: -len(ids[j]))
    sizes = np.array([len(ids[j]) + 1 for j in order], np.int64)
    begin = np.cumsum(sizes) - sizes
    x = np.concatenate([part for k, j in enumerate(order) for part in (ids[j], [len(numbers) + k])]) if ids else np.empty(0, np.int64)
    start, end, period = find_runs(x, int(sizes[0]) - 1 if len(sizes) else 0, least, sizes)
    cut = np.searchsorted(start, np.append(begin, len(x)))
    out = [None] * len(ids)
    for k, j in enumerate(order):
        s = slice(cut[k], cut[k + 1])
        out[j] = (words[j], (start[s] - begin[k], end[s] - begin[k], period[s]))
    return out


def kept_words(n: int, start, end, period) -> np.ndarray:
    """Which of ``n`` words stay: those in no run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:n]) == 0


def parts(rows):
    """The rows of each batch in slices of bounded length (a longer text stands alone)."""
    for batch in rows:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        a = size = 0
        for k, t in enumerate(texts):
            if k > a and size + len(t) > 6 * BATCH_WORDS:
                yield keys[a:k], texts[a:k]
                a, size = k, 0
            size += len(t)
        if a < len(texts):
            yield keys[a:], texts[a:]


def collapse(words: list[bytes], runs) -> bytes:
    keep = kept_words(len(words), *runs)
    return b" ".join([words[j] for j in np.flatnonzero(keep).tolist()]) if len(runs[0]) else b" ".join(words)


def describe_runs(docs: DataFrame, plant: bool = False, least: int = LEAST) -> DataFrame:
    """Per document: its number of runs, the longest one, and digests of all runs and of the collapsed text."""
    def describe(rows):
        for keys, texts in parts(rows):
            out = []
            for key, (words, runs) in zip(keys, runs_of_texts(keys, texts, plant, least), strict=True):
                start, end, period = runs
                best = (None,) * 4
                if len(start):
                    k = int(np.lexsort((period, start, start - end))[0])
                    n, q = int(end[k] - start[k]), int(period[k])
                    best = (int(start[k]), n, q, 1000 * n // q)
                listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in zip(*(c.tolist() for c in runs), strict=True))
                out.append((key, len(start), *best, hashlib.sha256(listed.encode()).hexdigest(),
                            hashlib.sha256(collapse(words, runs)).hexdigest()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.string()] * 2, strict=True)],
                                             [f.split()[0] for f in RESULT.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(describe, RESULT)


def list_runs(docs: DataFrame, plant: bool = False, least: int = LEAST) -> DataFrame:
    """One row (doc_id, start, length, period, words: of the first period) for every run."""
    schema = "doc_id long, start long, length long, period long, words string"

    def listed(rows):
        for keys, texts in parts(rows):
            out = [(key, a, b - a, q, b" ".join(words[a:a + q]).decode("utf-8", "surrogatepass"))
                   for key, (words, runs) in zip(keys, runs_of_texts(keys, texts, plant, least), strict=True)
                   for a, b, q in zip(*(c.tolist() for c in runs), strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)],
                                             [f.split()[0] for f in schema.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(listed, schema)


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents with every run cut to its first period; texts without runs, and other columns, are unchanged."""
    @F.pandas_udf("string")
    def collapsed(texts):
        out = [collapse(words, runs).decode("utf-8", "surrogatepass") if len(runs[0]) else t
               for t, (words, runs) in zip(texts, runs_of_texts([None] * len(texts), list(texts), False, least), strict=True)]
        return texts.__class__(out, index=texts.index, dtype=object)

    small_batches(docs.sparkSession)
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), collapsed(text_of())))
