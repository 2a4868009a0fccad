"""Operator 9: exact Jaccard join on word shingles with signature trees.

A document's set holds its distinct shingles of 4 words (ASCII letters
lower-cased) as 64-bit hashes.  Documents link when the Jaccard similarity of
their sets is at least ``percent``; linked documents form components.

1. Documents with equal sets are one class (a 128-bit digest of the set).
2. A class that links misses at most n - ceil(percent * n) of its n shingles in
   the other one, so of its shingles with a hash in the lowest part of the range all
   but so many are in a second class.  One aggregate over that part of all sets
   says which are; classes with too few of them link with nothing and go on no further.
3. In any fixed order of shingles, two sets that link share one among their
   first n - ceil(percent * n) + 1.  Those prefixes are the buckets; the order
   is by hash, with the frequent shingles (a bounded list) behind all others, so common passages
   make no buckets.  Shingles that only one class has in its prefix drop out by
   an aggregate.
4. Classes are first compared with two others: the first and the last bucket owner with
   which they share most prefix shingles, if those are many.  Verified links are contracted to components, so a group of
   thousands of near copies is one component after about one comparison each.
5. Buckets that still hold several components are joined by a signature tree: a
   node holds the size range of its members and the OR of their token bitmaps,
   and a pair of nodes is dropped when its largest possible overlap is too
   small or all its members are connected already.  A pair counts only where the
   bucket's shingle stands early enough to be the first that a linked pair shares.  Buckets of a leaf's size are
   compared many at once.  Bitmaps go only to rows that have a partner by sizes and
   places.  Of the pairs that pass, those remain whose 16-bit marks of all
   shingles agree far enough.  Large buckets are dealt out as pairs of blocks, so no task holds
   more than two blocks, and every pair of members meets in one of them.
6. Pairs of classes that remain are verified on the whole sets, in two rounds.  In
   the first a task gives a pair only if no others of its pairs connect the two, so fewer pairs than
   it has members, and the links found are contracted.  Where one of them doesn't link, the second gives
   every pair of classes that are still apart, which are few, as nearly all pairs that pass the marks link.

No step has a chance of losing a link; hashes of 64 bits stand for shingles.

Cases: null and empty texts have an empty set and link with nothing; a text of
fewer than 4 words is one shingle; repeated rows are one class and each keeps its row; rows with
a null doc_id link with nothing and have a null component; an empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.bits import build_filter, passing
from ferret.llm.common import stored, text_of
from ferret.llm.encoder import batches
from ferret.llm.graph import connected_components
from ferret.llm.words import WordHashes, combined, forgetting

SHINGLE = 4
PERCENT = 85
LEAST_BITS, MOST_BITS = 64, 4096
FAN_OUT = 16
LEAF = 64  # a bucket with no more members is one leaf
BLOCK = 2048
OFTEN = 256
MOST_FREQUENT = 1 << 20
STAR_SHARE = 0.3  # of a prefix, shared with one owner, to be compared with it first
SPARE = 10  # percent of all hashes that are counted beside those that a linked set may miss
TOO_FULL = 0.5  # of the filter's bits: from here on classes are chosen by a join, as the filter passes too many others
CHUNK = 1 << 12  # pairs whose marks are compared at once
MOST_MARKS = 512  # shingles of a set that has marks; larger sets have their bitmaps only


class ByteHashes(WordHashes):
    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


KNOWN = ByteHashes()


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (unsigned 64-bit) of each text; the hashing is done for all texts at once."""
    # bytes.lower() changes A-Z only, and bytes.split() cuts at exactly the six ASCII space characters
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = [len(w) for w in words]
    hashes = KNOWN.of(chain.from_iterable(words), sum(counts))
    shingles = combined(hashes, list(range(size)), size)
    out, at = [], 0
    for n in counts:
        if n >= size:
            out.append(np.unique(shingles[at:at + n - size + 1]))
        else:
            out.append(combined(hashes[at:at + n], list(range(n)), n) if n else np.zeros(0, np.uint64))
        at += n
    return out


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Token bitmap as 64-bit words, as wide as the set asks for (a power of two), in two planes.

    The first has the positions with a token, the second those with two or more,
    so tokens that share a position hardly loosen the bound on an overlap.
    """
    width = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(hashes) - 1).bit_length()))
    counts = np.bincount(((hashes >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits(np.concatenate([counts > 0, counts > 1]), bitorder="little").view(np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(hashes: np.ndarray, percent: int, last: np.ndarray | None = None) -> np.ndarray:
    """The first shingles of a sorted set: those in ``last`` (sorted) come after all others."""
    n = prefix_length(len(hashes), percent)
    if last is None or not len(last):
        return hashes[:n]
    late = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
    return hashes[:n] if not late[:n].any() else np.concatenate([hashes[~late], hashes[late]])[:n]


def marks(hashes: np.ndarray) -> bytes | None:
    """A 16-bit mark of each shingle, sorted; none for large sets.  The bitmap follows from it."""
    if len(hashes) > MOST_MARKS:
        return None
    return np.sort((hashes >> np.uint64(20) & np.uint64(0xFFFF)).astype(np.uint16)).tobytes()


def bitmap_of_marks(marks: bytes) -> bytes:
    return bitmap(np.frombuffer(marks, np.uint16).astype(np.uint64) << np.uint64(20)).tobytes()


SETS = "doc_id long, n int, class long, sample array<bigint>"


def class_of(hashes: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_128_digest(hashes.tobytes())[:8], "little", signed=True)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def sample_limit(percent: int) -> np.uint64:
    """Hashes up to this one are the sample: the same shingles in every set."""
    return np.uint64(min(100, 100 - percent + SPARE) * ((1 << 64) - 1) // 100)


def document_sets(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Size, class and sampled shingles of every document's set."""
    limit = sample_limit(percent)

    def make(rows):
        for batch in rows:
            first = 0
            keys = batch.column(0)
            for part in batches(batch.column(1).to_pylist()):
                sets = shingle_sets(part, size)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, len(part)), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                     _lists([s[:np.searchsorted(s, limit, "right")] for s in sets])], ["doc_id", "n", "class", "sample"])
                first += len(part)

    return _texts(docs).mapInArrow(forgetting(make, KNOWN), SETS)


def frequent_shingles(shared: DataFrame, *, often: int = OFTEN, most: int = MOST_FREQUENT) -> np.ndarray:
    """The hashes in ``shared`` (h, n) that more than ``often`` documents have, sorted.

    The limit rises with the corpus so that never more than ``most`` hashes
    come to the driver: what n rows hold more than n / most times is at most that many.
    """
    counts = shared.where(F.col("n") > often)
    rows = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") > rows / most).select("h").toPandas()["h"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def linkable_classes(usable: DataFrame, shared: DataFrame, flags: np.ndarray, percent: int) -> DataFrame:
    """The classes of which so much of the sample is in ``shared`` that they may link with another one.

    ``flags`` is the filter of ``shared``; what it passes beside members lets a
    class pass, never fail.  Where it is too full to tell, the hashes are joined.
    """
    sent = usable.sparkSession.sparkContext.broadcast(flags)

    def sift(rows):
        for batch in rows:
            parts, n = batch.column(2), batch.column(1).to_numpy().astype(np.int64)
            values, sizes = parts.flatten().to_numpy(), parts.value_lengths().to_numpy().astype(np.int64)
            keep = passing(sent.value, values.view(np.uint64))
            hits = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[keep], minlength=len(sizes))
            need = sizes - (n + -percent * n // 100)
            ok = np.flatnonzero(hits >= need)
            ends = np.cumsum(hits) - hits
            found = [values[keep[ends[k]:ends[k] + hits[k]]].view(np.uint64) for k in ok.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ok)), pa.array(need[ok], pa.int64()), _lists(found)],
                                             ["class", "need", "found"])

    rows = usable.select("class", "n", "sample").mapInArrow(forgetting(sift), "class long, need long, found array<bigint>")
    if np.bitwise_count(flags).sum() <= TOO_FULL * 64 * len(flags):
        return rows.select("class").distinct()
    rows = stored(rows.dropDuplicates(["class"]), "sifted-classes")
    hits = (rows.select("class", F.explode("found").alias("h")).join(shared.select("h"), "h", "left_semi")
            .groupBy("class").agg(F.count("*").alias("hits")))
    return rows.select("class", "need").join(hits, "class", "left").where(F.coalesce("hits", F.lit(0)) >= F.col("need")).select("class")


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """class, n and the whole set of each class in ``wanted`` (class, first: a document of it).

    The sets are made anew from the texts of one document a class: a filter of
    fixed size picks them in the scan, so texts are not shuffled.
    """
    flags = docs.sparkSession.sparkContext.broadcast(build_filter(wanted.select(F.xxhash64("first").alias("h")), "h"))

    def make(rows):
        for batch in rows:
            keep = passing(flags.value, batch.column(1).to_numpy().view(np.uint64))
            picked = batch.take(pa.array(keep))
            first = 0
            for part in batches(picked.column(2).to_pylist()):
                sets = shingle_sets(part, size)
                yield pa.RecordBatch.from_arrays(
                    [picked.column(0).slice(first, len(part)), pa.array([class_of(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc_id", "class", "n", "set"])
                first += len(part)

    rows = _texts(docs).where(F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", F.xxhash64("doc_id").alias("h"), "text").mapInArrow(forgetting(make, KNOWN), "doc_id long, class long, n int, set binary")
    # dealt by class alone, which then serves to drop repeated rows too
    return (rows.join(wanted, "class").where(F.col("doc_id").bitwiseXOR(F.col("first")) == 0)
            .dropDuplicates(["class"]).select("class", "n", "set"))


def prefixes(sets: DataFrame, frequent: np.ndarray, flags: np.ndarray, percent: int) -> DataFrame:
    """class, n, h and place of the prefix shingles of ``sets``; those in the sample that ``flags`` show to be in one class only are left out."""
    sent, limit = sets.sparkSession.sparkContext.broadcast((frequent, flags)), sample_limit(percent)

    def make(rows):
        last, shared = sent.value
        for batch in rows:
            parts = [prefix(np.frombuffer(s, np.uint64), percent, last) for s in batch.column(2).to_pylist()]
            sizes = np.array([len(p) for p in parts], np.int64)
            values = np.concatenate([*parts, np.zeros(0, np.uint64)])
            may = values > limit
            may[passing(shared, values)] = True
            keep = np.flatnonzero(may)
            owner = np.repeat(np.arange(len(sizes)), sizes)[keep]
            place = keep - (np.cumsum(sizes) - sizes)[owner]
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(values[keep].view(np.int64)),
                                              pa.array(place.astype(np.int32))], ["class", "n", "h", "place"])

    return sets.select("class", "n", "set").mapInArrow(forgetting(make), "class long, n int, h long, place int")


# ---- signature trees ------------------------------------------------------

class Tree:
    """Levels of nodes over members; level 0 are the members themselves."""

    def __init__(self, sizes, bits, group):
        spare = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)  # tokens that share a bit with others
        self.levels = [(sizes, sizes, bits, spare, group, group)]
        while len(self.levels[-1][0]) > FAN_OUT:
            low, high, bits, spare, g0, g1 = self.levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.bitwise_or.reduceat(bits, at, axis=0), np.maximum.reduceat(spare, at),
                                np.minimum.reduceat(g0, at), np.maximum.reduceat(g1, at)))


def _survive(x, y, i, j, percent):
    """Which node pairs may hold a link between different groups."""
    low_x, high_x, bits_x, spare_x, g0x, g1x = (c[i] for c in x)
    low_y, high_y, bits_y, spare_y, g0y, g1y = (c[j] for c in y)
    ok = (100 * high_x >= percent * low_y) & (100 * high_y >= percent * low_x)
    ok &= ~((g0x == g1x) & (g0y == g1y) & (g0x == g0y))
    k = np.flatnonzero(ok)
    common = np.bitwise_count(bits_x[k] & bits_y[k]).sum(axis=1).astype(np.int64)
    most = np.minimum(common + np.minimum(spare_x[k], spare_y[k]), np.minimum(high_x[k], high_y[k]))
    # overlap o of sizes a and b links when (100 + percent) * o >= percent * (a + b)
    return k[(100 + percent) * most >= percent * (low_x[k] + low_y[k])]


def dual_traversal(a: Tree, b: Tree, percent: int, same: bool, step: int = 1 << 14):
    """Pairs (i, j) of members that no bound excludes; with ``same`` only i < j."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[la][0])), np.arange(len(b.levels[lb][0])), indexing="ij"))
    todo, found = [(la, lb, i, j)], []
    while todo:
        la, lb, i, j = todo.pop()
        if len(i) > step:
            todo += [(la, lb, i[k:k + step], j[k:k + step]) for k in range(0, len(i), step)]
            continue
        if same and la == lb:
            keep = i <= j if la else i < j
            i, j = i[keep], j[keep]
        k = _survive(a.levels[la], b.levels[lb], i, j, percent)
        i, j = i[k], j[k]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            found.append(np.stack([i, j], axis=1))
            continue
        if la >= lb:  # go down in the higher tree, in both when level
            i, j = np.repeat(i, FAN_OUT) * FAN_OUT + np.tile(np.arange(FAN_OUT), len(i)), np.repeat(j, FAN_OUT)
            keep = i < len(a.levels[la - 1][0])
            i, j, down_a = i[keep], j[keep], la - 1
        else:
            down_a = la
        if lb >= la:
            i, j = np.repeat(i, FAN_OUT), np.repeat(j, FAN_OUT) * FAN_OUT + np.tile(np.arange(FAN_OUT), len(j))
            keep = j < len(b.levels[lb - 1][0])
            i, j, down_b = i[keep], j[keep], lb - 1
        else:
            down_b = lb
        todo.append((down_a, down_b, i, j))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


class Members:
    """Columns of the rows of some buckets, row by row; bitmaps and marks where they are there."""

    def __init__(self, batch):
        col = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        self.classes, self.groups, self.sizes, self.side = col("class"), col("component"), col("n"), col("own")
        self.across = col("block_a") != col("block_b")
        signed = lambda c: batch.column(c).to_pylist() if c in batch.schema.names else [None] * len(self.classes)
        self.marks = signed("marks")
        self.bits = [bitmap_of_marks(x) if x is not None else b for x, b in zip(self.marks, signed("bits"), strict=True)]
        self.place = col("place")
        self.widths = np.array([4 * len(b or b"") for b in self.bits], np.int64)
        keys = np.stack([col("h"), col("block_a"), col("block_b")])
        self.starts = np.flatnonzero(np.concatenate([[True], (np.diff(keys) != 0).any(axis=0)])) if len(self.bits) else np.zeros(0, np.int64)

    def early(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Where the bucket's shingle stands early enough in both sets to be the first that a linked pair shares."""
        need = percent * (self.sizes[i] + self.sizes[j])
        return ((100 + percent) * (self.sizes[i] - self.place[i]) >= need) & ((100 + percent) * (self.sizes[j] - self.place[j]) >= need)

    def folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        return _folded([self.bits[k] for k in rows.tolist()], self.widths[rows], width)


def _folded(bits: list[bytes], widths: np.ndarray, width: int) -> np.ndarray:
    """Both planes as rows of ``width`` bits each; in wider ones positions are put together, as counts would be."""
    out = np.zeros((len(bits), 2, width // 64), np.uint64)
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        flat = np.frombuffer(b"".join([bits[k] for k in rows.tolist()]), np.uint64).reshape(len(rows), 2, w // width, width // 64)
        one, two = flat[:, 0, 0].copy(), flat[:, 1, 0].copy()
        for k in range(1, w // width):
            two |= flat[:, 1, k] | (one & flat[:, 0, k])
            one |= flat[:, 0, k]
        out[rows, 0], out[rows, 1] = one, two
    return out.reshape(len(bits), -1)


def _leaf_pairs(m: Members, starts: np.ndarray, sizes: np.ndarray, percent: int, step: int = 1 << 20):
    """Yields the pairs of rows of buckets that are one leaf each; all buckets of a size at once."""
    for g in np.unique(sizes).tolist():
        first, second = np.triu_indices(g, 1)
        at = starts[sizes == g]
        for k in range(0, len(at), max(1, step // len(first))) if g > 1 else ():
            part = at[k:k + max(1, step // len(first)), None]
            i, j = (part + first).ravel(), (part + second).ravel()
            ok = (m.groups[i] != m.groups[j]) & (~m.across[i] | (m.side[i] != m.side[j]))
            i, j = i[ok], j[ok]
            small, large = np.minimum(m.sizes[i], m.sizes[j]), np.maximum(m.sizes[i], m.sizes[j])
            ok = (100 * small >= percent * large) & m.early(i, j, percent)
            yield i[ok], j[ok]


def _possible(m: Members, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows may link by their bitmaps (both planes in one row)."""
    ok = np.zeros(len(i), bool)
    width = np.minimum(m.widths[i], m.widths[j])
    for w in np.unique(width).tolist():
        k = np.flatnonzero(width == w)
        rows, inverse = np.unique(np.concatenate([i[k], j[k]]), return_inverse=True)
        bits = m.folded(rows, w)
        spare = m.sizes[rows] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        a, b = inverse[:len(k)], inverse[len(k):]
        for c in range(0, len(k), 1 << 17):
            x, y, q = a[c:c + (1 << 17)], b[c:c + (1 << 17)], k[c:c + (1 << 17)]
            common = np.bitwise_count(bits[x] & bits[y]).sum(axis=1).astype(np.int64)
            most = np.minimum(common + np.minimum(spare[x], spare[y]), np.minimum(m.sizes[i[q]], m.sizes[j[q]]))
            ok[q] = (100 + percent) * most >= percent * (m.sizes[i[q]] + m.sizes[j[q]])
    return ok


def _agreeing(m: Members, i: np.ndarray, j: np.ndarray, percent: int, step: int = CHUNK) -> np.ndarray:
    """Which pairs of rows may link by their marks; those without marks may."""
    marked = np.array([x is not None for x in m.marks], bool)
    ok = np.ones(len(i), bool)
    both = np.flatnonzero(marked[i] & marked[j])
    rows, inverse = np.unique(np.concatenate([i[both], j[both]]), return_inverse=True)
    if not len(rows):
        return ok
    sizes = m.sizes[rows]
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join([m.marks[k] for k in rows.tolist()]), np.uint16).astype(np.int64)
    # equal marks of a set get numbers, so that each counts once
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[ends - sizes] = True
    starts = np.flatnonzero(new)
    number = np.arange(len(flat)) - np.repeat(starts, np.diff(np.append(starts, len(flat))))
    value = flat << 16 | number
    keys = np.repeat(np.arange(len(rows)), sizes) << 32 | value
    a, b = inverse[:len(both)], inverse[len(both):]
    a, b = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
    for c in range(0, len(both), step):
        x, y = a[c:c + step], b[c:c + step]
        n = sizes[x]
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(ends[x] - n, n)
        look = np.repeat(y, n) << 32 | value[at]
        hit = keys[np.minimum(np.searchsorted(keys, look), len(keys) - 1)] == look
        most = np.add.reduceat(hit, first, dtype=np.int64)
        ok[both[c:c + step]] = (100 + percent) * most >= percent * (n + sizes[y])
    return ok


def bucket_pairs(m: Members, percent: int, forest: bool = False) -> np.ndarray:
    """Pairs of classes that share a bucket, may link and belong to different components.

    With ``forest`` only so many that they connect what all of them would.
    """
    sizes = np.diff(np.append(m.starts, len(m.bits)))
    out = [np.zeros((0, 2), np.int64)]
    leaf = sizes <= LEAF
    for i, j in _leaf_pairs(m, m.starts[leaf], sizes[leaf], percent):
        ok = _possible(m, i, j, percent)
        out.append(np.stack([i[ok], j[ok]], axis=1))
    for start, n in zip(m.starts[~leaf].tolist(), sizes[~leaf].tolist(), strict=True):
        out.append(_tree_pairs(m, np.arange(start, start + n), percent))
    rows = np.concatenate(out)
    # a pair of classes that share several buckets counts once
    _, once = np.unique(np.sort(m.classes[rows], axis=1), axis=0, return_index=True)
    rows = rows[once]
    if not forest:
        return m.classes[rows[_agreeing(m, rows[:, 0], rows[:, 1], percent)]]
    root: dict[int, int] = {}

    def find(x):
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    kept = [np.zeros((0, 2), np.int64)]
    for k in range(0, len(rows), CHUNK):
        part = rows[k:k + CHUNK]
        apart = [find(a) != find(b) for a, b in m.groups[part].tolist()]
        part = part[apart]
        part = part[_agreeing(m, part[:, 0], part[:, 1], percent)]
        tree = []
        for at, (a, b) in enumerate(m.groups[part].tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[a] = b
                tree.append(at)
        kept.append(part[np.array(tree, np.int64)])
    return m.classes[np.concatenate(kept)]


def with_partner(m: Members, percent: int) -> np.ndarray:
    """Which rows have another one in their bucket that may link by sizes and places; all rows of buckets above a leaf's size."""
    sizes = np.diff(np.append(m.starts, len(m.classes)))
    leaf = sizes <= LEAF
    out = np.repeat(~leaf, sizes)
    for i, j in _leaf_pairs(m, m.starts[leaf], sizes[leaf], percent):
        out[i] = out[j] = True
    return out


def _tree_pairs(m: Members, rows: np.ndarray, percent: int) -> np.ndarray:
    """The same for one bucket, or one pair of blocks of it, by signature trees."""
    rows = rows[np.lexsort((m.classes[rows], m.groups[rows], m.sizes[rows]))]
    across = bool(m.across[rows[0]])
    sides = [rows[m.side[rows] == s] for s in np.unique(m.side[rows])] if across else [rows]
    if across and len(sides) < 2:
        return np.zeros((0, 2), np.int64)
    out = [np.zeros((0, 2), np.int64)]

    def tree(part, width):
        return Tree(m.sizes[part], m.folded(part, width), m.groups[part])

    def compare(x, y, width):
        if len(x) and len(y):
            p = dual_traversal(tree(x, width), tree(y, width), percent, False)
            out.append(np.stack([x[p[:, 0]], y[p[:, 1]]], axis=1))

    for w in np.unique(m.widths[rows]).tolist():
        # sets that link have bitmaps of one width, or of neighbouring widths
        own = [s[m.widths[s] == w] for s in sides]
        near = [s[m.widths[s] == 2 * w] for s in sides]
        if across:
            compare(own[0], own[1], w)
            compare(own[0], near[1], w)
            compare(own[1], near[0], w)
        else:
            if len(own[0]):
                t = tree(own[0], w)
                out.append(own[0][dual_traversal(t, t, percent, True)])
            compare(own[0], near[0], w)
    pairs = np.concatenate(out)
    ok = (m.groups[pairs[:, 0]] != m.groups[pairs[:, 1]]) & m.early(pairs[:, 0], pairs[:, 1], percent)
    return pairs[ok]


# ---- the join -------------------------------------------------------------

def _passes(wanted: DataFrame):
    """A condition on ``class`` that holds for those in ``wanted`` and a few others: it spares sets the shuffle."""
    flags = wanted.sparkSession.sparkContext.broadcast(build_filter(wanted, "class"))

    @F.pandas_udf("boolean")
    def may_be(k):
        out = np.zeros(len(k), bool)
        out[passing(flags.value, k.to_numpy().view(np.uint64))] = True
        return pd.Series(out)

    return may_be("class")


def _verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets link."""
    @F.pandas_udf("boolean")
    def links(x, y):
        out = []
        for s, t in zip(x, y, strict=True):
            s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
            o = len(np.intersect1d(s, t, assume_unique=True))
            out.append(100 * o >= percent * (len(s) + len(t) - o))
        return pd.Series(out, dtype=bool)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class"))
    sets = whole.where(_passes(wanted)).select("class", "set")
    return (pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("class").alias("b"), F.col("set").alias("y")), "b")
            .where(links("x", "y")).select("a", "b"))


def _with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    return (rows.join(components.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("component", F.coalesce("component", "class")))


def join_components(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, often: int = OFTEN) -> DataFrame:
    """doc_id, n_shingles, class_id (hash of the set; null if empty), component_id: the smallest id reachable by links."""
    sets = stored(document_sets(docs, size=size, percent=percent), "sets")
    usable = sets.where(F.col("doc_id").isNotNull() & F.col("class").isNotNull())
    classes = stored(usable.groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "classes")
    counted = usable.select("class", F.explode("sample").alias("h")).groupBy("h").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("n"))
    counted = stored(counted.where("lo <> hi").select("h", "n"), "shared-shingles")
    flags = build_filter(counted, "h")
    linkable = linkable_classes(usable, counted, flags, percent)
    wanted = stored(linkable.join(classes.select("class", "first"), "class"), "linkable-classes")
    whole = stored(whole_sets(docs, wanted, size), "whole-sets")
    rows = stored(prefixes(whole, frequent_shingles(counted, often=often), flags, percent), "prefixes")
    ends = rows.groupBy("h").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    shared = stored(rows.join(ends, "h").select("h", "lo", "hi", "class", "n", "place"), "shared-prefixes")

    # two comparisons a class, where there is much in common: with the first and with
    # the last owner with which it shares most shingles
    best = None
    for owner in ("lo", "hi"):
        with_owner = shared.where(F.col("class") != F.col(owner)).groupBy("class", owner).agg(F.count("*").alias("m"), F.max("n").alias("n"))
        most = with_owner.groupBy("class").agg(F.max(F.struct("m", owner, "n")).alias("best")).select(
            "class", "best.m", "best.n", F.col(f"best.{owner}").alias("b"))
        best = most if best is None else best.unionByName(most)
    best = (best.where(F.col("m") * 100 >= (100 - percent) * STAR_SHARE * F.col("n"))
            .select(F.greatest("class", "b").alias("a"), F.least("class", "b").alias("b")).distinct())
    links = stored(_verified(stored(best, "star-pairs"), whole, percent), "star-links")
    components = stored(connected_components(links), "components")
    pairs = stored(_open_pairs(shared, whole, components, percent, block, True), "tree-pairs")
    found = stored(_verified(pairs, whole, percent), "tree-links")
    links = links.unionByName(found)
    components = stored(connected_components(links), "components")
    failed = stored(pairs.join(found, ["a", "b"], "left_anti"), "failed-pairs")
    if not failed.isEmpty():
        # where all of a tree's pairs link, it is one component; the others are compared in full
        trees = stored(connected_components(links.unionByName(failed)), "trees")
        again = trees.join(failed.select(F.col("a").alias("node")), "node").select("component").distinct()
        again = trees.join(again, "component").select(F.col("node").alias("class"))
        pairs = stored(_open_pairs(shared.join(again, "class", "left_semi"), whole, components, percent, block, False), "last-pairs")
        links = links.unionByName(stored(_verified(pairs, whole, percent), "last-links"))
        components = stored(connected_components(links), "components")

    members = _with_component(classes.select("class", "first"), components)
    least = members.groupBy("component").agg(F.min("first").alias("component_id"))
    members = members.join(least, "component").select(F.col("class").alias("class_id"), "component_id")
    return (sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("class").alias("class_id"))
            .join(members, "class_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def _open_pairs(shared: DataFrame, whole: DataFrame, components: DataFrame, percent: int, block: int, forest: bool) -> DataFrame:
    """Pairs (a, b) of classes in different components that share a bucket and may link."""
    @F.pandas_udf("bits binary, marks binary")
    def signed(sets):
        sets = [np.frombuffer(s, np.uint64) for s in sets]
        return pd.DataFrame({"bits": [bitmap(s).tobytes() if len(s) > MOST_MARKS else None for s in sets], "marks": [marks(s) for s in sets]})

    rows = _with_component(shared.select("h", "class", "n", "place"), components)
    open_ = rows.groupBy("h").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("members"),
                                  F.bit_xor(F.xxhash64("class")).alias("s0"), F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("s1"),
                                  F.min(F.struct("class", "place")).alias("least")).where("c0 <> c1")
    # of buckets with the same members (a passage has many) the first in order does for all: places are the smallest there
    open_ = open_.groupBy("s0", "s1", "members").agg(F.min(F.struct("least.place", "h")).alias("one")).select("one.h", "members")
    rows = stored(rows.join(open_, "h"), "open-buckets")
    # a bucket of more than one block is dealt out to pairs of blocks
    blocks = F.ceil(F.col("members") / block).cast("int")
    rows = rows.select("h", "class", "place", "component", "n", blocks.alias("blocks"), F.pmod(F.xxhash64("class", "h"), blocks).cast("int").alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("h", "class", "place", "component", "n", "own", other.alias("other")).select(
        "h", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "own", "class", "place", "component", "n")

    def buckets(batches_):
        rest = None
        for batch in batches_:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            # the last bucket may go on in the next batch
            keys = [t.column(c).to_numpy() for c in ("h", "block_a", "block_b")]
            n = int(np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))[-1] + 1) if len(t) and any(
                (k != k[-1]).any() for k in keys) else 0
            rest = t.slice(n)
            if n:
                yield t.slice(0, n).combine_chunks()
        if rest is not None and len(rest):
            yield rest.combine_chunks()

    def pick(batches_):
        for t in buckets(batches_):
            yield from t.filter(pa.array(with_partner(Members(t), percent))).to_batches()

    def compare(batches_):
        for t in buckets(batches_):
            pairs = np.sort(bucket_pairs(Members(t), percent, forest), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1]), pa.array(pairs[:, 0])], ["a", "b"])

    # bitmaps and marks are many times as long as the rest of a row, so only rows with a partner get them
    key = ["h", "block_a", "block_b"]
    rows = stored(rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(forgetting(pick), rows.schema), "rows-with-partners")
    info = whole.where(_passes(rows.select("class"))).select("class", signed("set").alias("s")).select("class", "s.*")
    return rows.join(info, "class").repartition(*key).sortWithinPartitions(*key).select(
        *rows.columns, "bits", "marks").mapInArrow(forgetting(compare), "a long, b long").distinct()


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that are the first of their component, with all their columns.

    Rows with a null doc_id, which link with nothing, stay.  Of repeated rows of
    a kept document one stays if all their columns agree.
    """
    member = join_components(docs, **options).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    ids = rows.where("own_id IS NOT NULL").groupBy("own_id").agg(F.count("*").alias("n"))
    again = stored(ids.where("n > 1").select(F.col("own_id").alias("gone_id")), "repeated-ids")
    if again.isEmpty():
        kept = rows.join(member, F.col("own_id") == F.col("gone_id"), "left_anti")
    else:
        member = stored(member, "members")
        once = rows.join(member.union(again), F.col("own_id") == F.col("gone_id"), "left_anti")
        twice = rows.join(again.join(member, "gone_id", "left_anti"), F.col("own_id") == F.col("gone_id"), "left_semi")
        twice = (twice.groupBy("own_id", F.sha2(F.to_json("row"), 256).alias("row_key"))
                 .agg(F.any_value("row").alias("row")).select("own_id", "row"))
        kept = once.unionByName(twice)
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
