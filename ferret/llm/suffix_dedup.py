"""Operator 2: exact removal of repeated byte strings with suffix arrays.

Texts are UTF-8 bytes.  A byte goes when a ``length``-byte string that covers it
also starts somewhere else, in any document.

1. Every window of ``length`` bytes has an anchor: its 32-byte gram with the
   smallest hash, the first of equals.  Equal windows have equal anchors at equal places, so
   windows are compared only where their anchors agree.  Windows that follow
   each other share an anchor; together they are a region (below 2 * ``length`` bytes).
2. Anchors that occur once in the corpus drop out by an aggregate.  Regions
   with equal content are one string with a count, and all their windows
   repeat when the count is above one.
3. The distinct strings of an anchor are put into one suffix array (linear
   grouping construction, ``suffix_array``).  Neighbours in it that agree in
   a whole window mark windows that repeat.  Before that, strings are cut to what they share with
   any other around the anchor, those that share less than a window go, and the
   core that all of them share becomes one symbol.
4. An anchor with more distinct strings than ``group_limit`` doesn't go to one
   task: its windows are hashed (128 bits) and counted one by one.

Only regions of repeated anchors are shuffled; the texts themselves are read
again through a filter of fixed size that picks the documents concerned.

Cases: null and empty texts and those shorter than a window lose nothing;
repeated rows repeat each other; a null doc_id is kept as a row; very long
texts are cut into blocks for anchors only, without losing a window; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.bits import build_filter, passing
from ferret.llm.common import stored, text_of
from ferret.llm.suffix_array import suffix_array
from ferret.llm.words import mixed

LENGTH = 400
GRAM = 32  # a power of two
SALTS = 16  # a string that occurs several times is looked up under so many keys
GROUP_LIMIT = 4096
_POSITION_BITS = 23
_BLOCK = 1 << 22
REGION = "row_key long, lo long, hi long, anchor_at long, anchor long, content long"


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` bytes, by doubling."""
    h, width = data.astype(np.uint64), 1
    factors = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
    for k in range(gram.bit_length() - 1):
        h = h[:len(h) - width] * np.uint64(factors[k]) + h[width:]
        width *= 2
    return mixed(h)


def regions(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """Yields (first window, last window, place of the anchor, anchor's hash) over all windows of ``data``."""
    span = length - gram + 1  # grams in a window
    for block in range(0, len(data) - length + 1, _BLOCK):
        part = np.frombuffer(data, np.uint8, min(_BLOCK + length - 1, len(data) - block), block)
        h = gram_hashes(part, gram)
        m = len(h)
        # high bits of the hash, then the place: the minimum is the first of the smallest
        keyed = (h >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(m, dtype=np.uint64)
        rows = np.concatenate([keyed, np.full(-m % span, ~np.uint64(0))]).reshape(-1, span)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(back[:m - span + 1], ahead[span - 1:m]) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(at) - 1]])
        yield from zip((lo + block).tolist(), (hi + block).tolist(), (at[lo] + block).tolist(),
                       h[at[lo]].view(np.int64).tolist(), strict=True)


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _best(sides: list[bytes]) -> list[int]:
    """For each string the longest prefix that it shares with another one."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in pairwise(order):
        n = shared_prefix(sides[i], sides[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def covered(starts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows at the sorted ``starts``."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + length)
        else:
            out.append([s, s + length])
    return [(a, b) for a, b in out]


def _core_symbols(parts: list[bytes], at: list[int], core: tuple[int, int]):
    """The strings with their common core (``core`` bytes before and after the anchor) as one symbol.

    Returns the symbols (strings, each with a separator of its own, and a last
    one that is the smallest), the same as bytes, where each string begins, and where its core is.
    """
    outer = [(s[:a - core[0]], s[a + core[1]:]) for s, a in zip(parts, at, strict=True)]
    m = len(parts)
    pieces = []
    for k, (x, y) in enumerate(outer, 1):
        pieces += [np.frombuffer(x, np.uint8).astype(np.int64) + m + 2, np.array([m + 1]), np.frombuffer(y, np.uint8).astype(np.int64) + m + 2, np.array([k])]
    text = b"".join([x + b"\0" + y + b"\0" for x, y in outer])
    sizes = np.array([len(x) + len(y) + 2 for x, y in outer])
    begin = np.cumsum(sizes) - sizes
    return np.concatenate([*pieces, np.array([0])]), text, begin, sizes, begin + np.array([len(x) for x, _ in outer])


def repeated_in_group(strings: list[bytes], anchors: list[int], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Covered runs of each string that occurs once, among the distinct strings of an anchor.

    Strings are cut to what they share with any other around the anchor; equal
    ones are then one string.  What all of them share around the anchor, the core, is one symbol
    of the suffix array: a window that holds the core whole repeats when its
    neighbour there agrees with it, and one that begins (or ends) inside the core repeats when
    some other string agrees far enough to the right (or left).
    """
    right = _best([s[p:] for s, p in zip(strings, anchors, strict=True)])
    left = _best([s[:p][::-1] for s, p in zip(strings, anchors, strict=True)])
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    same: dict[tuple[bytes, int], list[int]] = {}
    for k, (s, p) in enumerate(zip(strings, anchors, strict=True)):
        if left[k] + right[k] >= length:
            same.setdefault((s[p - left[k]:p + right[k]], left[k]), []).append(k)
    parts, at = [x for x, _ in same], [a for _, a in same]
    owners = list(same.values())
    alone = [len(o) == 1 and counts[o[0]] == 1 for o in owners]
    for o, single, s, a in zip(owners, alone, parts, at, strict=True):
        for k in o:
            if not single and counts[k] == 1:
                out[k] = [(anchors[k] - a, anchors[k] - a + len(s))]
    if not any(alone):
        return out
    rights, lefts = [s[a:] for s, a in zip(parts, at, strict=True)], [s[:a][::-1] for s, a in zip(parts, at, strict=True)]
    core = (shared_prefix(min(lefts), max(lefts)), shared_prefix(min(rights), max(rights)))
    far_right, far_left = _best(rights), _best(lefts)
    found: list[set[int]] = [set() for _ in parts]  # window starts, counted from the anchor
    for k in range(len(parts)):
        if alone[k]:
            found[k].update(range(-core[0], min(0, far_right[k] - length) + 1))
            found[k].update(range(-far_left[k], min(0, core[1] - length) + 1))
    window = length - sum(core) + 1
    if window > 1:
        symbols, text, begin, sizes, middle = _core_symbols(parts, at, core)
        order = np.frombuffer(suffix_array(symbols), np.int32)
        order = order[order < len(text)]
        owner = np.repeat(np.arange(len(parts)), sizes)[order]
        # suffixes whose window lies in their string and holds the core
        whole = (order <= middle[owner]) & (order + window > middle[owner]) & (order + window < begin[owner] + sizes[owner])
        order, owner = order[whole].tolist(), owner[whole].tolist()
        offset = (middle[owner] - order).tolist() if order else []
        for (a, b), (x, y), (i, j) in zip(pairwise(order), pairwise(owner), pairwise(offset), strict=True):
            if i == j and text[a:a + window] == text[b:b + window]:
                found[x].add(-core[0] - i)
                found[y].add(-core[0] - j)
    for o, single, starts in zip(owners, alone, found, strict=True):
        if single:
            out[o[0]] = covered([anchors[o[0]] + s for s in sorted(starts)], length)
    return out


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", F.col("text").cast("binary").alias("data"))


def _concerned(keys: DataFrame, name: str = "row_key"):
    """A condition that holds for all rows whose ``name`` is among those of ``keys``, and for a few others."""
    flags = keys.sparkSession.sparkContext.broadcast(build_filter(keys, name))

    @F.pandas_udf("boolean")
    def may_be(k):
        out = np.zeros(len(k), bool)
        out[passing(flags.value, k.to_numpy().view(np.uint64))] = True
        return pd.Series(out)

    return may_be(name)


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """row_key and spans (array of start, end in bytes, unsorted, overlapping) of every document that repeats something."""
    def find(batches):
        names = [f.split()[0] for f in REGION.split(", ")]
        for batch in batches:
            cols = [array("q") for _ in names]
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                for lo, hi, at, anchor in regions(data, length, gram):
                    content = xxhash.xxh3_64_intdigest(data[lo:hi + length])
                    for col, v in zip(cols, (key, lo, hi, at, anchor, content - (content >> 63 << 64)), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in cols], names)

    found = stored(_rows(docs).select("row_key", "data").mapInArrow(find, REGION), "regions")
    repeated = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    # no row is dealt by its anchor, which may be that of a third of all rows: the filter lets a
    # few anchors pass that occur once, and those have one string that occurs once
    found = stored(found.where(_concerned(stored(repeated, "anchors"), "anchor")), "repeated-anchors")
    strings = stored(found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("row_key", "lo", "hi", "anchor_at")).alias("one")), "strings")
    copied = strings.where("n > 1").select("anchor", "content", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    whole = (found.withColumn("salt", F.pmod(F.xxhash64("row_key", "lo"), F.lit(SALTS)).cast("int"))
             .join(copied, ["anchor", "content", "salt"])
             .select("row_key", F.col("lo").alias("start"), (F.col("hi") + length).alias("end")))

    # the distinct strings of anchors that have several
    several = strings.groupBy("anchor").agg(F.count("*").alias("members"), F.min("n").alias("least")).where("members > 1 AND least = 1")
    picked = strings.join(several.select("anchor", "members"), "anchor").select("anchor", "n", "members", "one.*")
    wanted = stored(picked.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "n", "members", "lo", "hi", "anchor_at")).alias("want")), "wanted-strings")
    rows = _rows(docs)
    texts = rows.where(_concerned(wanted.select("row_key"))).dropDuplicates(["row_key"])

    def cut(batches):
        types = (pa.int64(),) * 6 + (pa.binary(),)
        names = ["anchor", "n", "members", "row_key", "lo", "at", "string"]
        for batch in batches:
            for first in range(0, batch.num_rows, 200):  # small pieces: a string is cut out of a text several times over
                out = []
                for r in batch.slice(first, 200).to_pylist():
                    out += [(w["anchor"], w["n"], w["members"], r["row_key"], w["lo"], w["anchor_at"] - w["lo"],
                             r["data"][w["lo"]:w["hi"] + length]) for w in r["want"]]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    members = texts.join(wanted, "row_key").select("row_key", "data", "want").mapInArrow(
        cut, "anchor long, n long, members long, row_key long, lo long, at long, string binary")
    members = stored(members, "group-strings")

    def compare(batches):
        """Anchor by anchor over rows sorted by anchor; one may go on in the next batch."""
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            keys = t.column("anchor").to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            rest = t.slice(edges[-1]) if len(t) else rest
            yield spans_of(t.slice(0, edges[-1]), edges)
        if rest is not None:
            yield spans_of(rest, [0, len(rest)])

    def spans_of(t, edges):
        strings, at, n, keys, los = (t.column(c).to_pylist() for c in ("string", "at", "n", "row_key", "lo"))
        cols = ([], [], [])
        for a, b in pairwise(edges):
            runs = repeated_in_group(strings[a:b], at[a:b], n[a:b], length)
            for key, lo, found in zip(keys[a:b], los[a:b], runs, strict=True):
                for first, last in found:
                    for col, v in zip(cols, (key, lo + first, lo + last), strict=True):
                        col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row_key", "start", "end"])

    small = (members.where(F.col("members") <= group_limit).repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(compare, "row_key long, start long, end long"))

    def windows(batches):
        for batch in batches:
            for r in batch.select(["n", "row_key", "lo", "string"]).to_pylist():
                s = r["string"]
                digests = [xxhash.xxh3_128_digest(s[k:k + length]) for k in range(len(s) - length + 1)]
                m = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["n"]] * m, pa.int64()), pa.array([r["row_key"]] * m, pa.int64()),
                     pa.array(range(r["lo"], r["lo"] + m), pa.int64()), pa.array(digests, pa.binary())],
                    ["n", "row_key", "start", "window"])

    each = members.where(F.col("members") > group_limit).mapInArrow(windows, "n long, row_key long, start long, window binary")
    often = each.groupBy("window").agg(F.sum("n").alias("total")).where("total > 1").select("window")
    large = each.where("n = 1").join(often, "window").select("row_key", "start", (F.col("start") + length).alias("end"))
    spans = whole.unionByName(small).unionByName(large)
    return spans.groupBy("row_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"


def remove_repeats(docs: DataFrame, *, with_bytes: bool = True, **options) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs, SHA-256 of what is left, that itself (if asked for)
    and as text, where a character that lost some of its bytes is the replacement character."""
    spans = stored(repeated_spans(docs, **options), "spans")

    def apply(batches):
        for batch in batches:
            cols = ([], [], [], [], [], [], [])
            for doc, data, found in zip(*batch.columns, strict=True):
                doc, data, found = doc.as_py(), data.as_py(), found.as_py()
                runs = merged(found)
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = (doc, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                       kept if with_bytes else None, kept.decode(errors="replace"))
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            types = (pa.int64(),) * 4 + (pa.string(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             [f.split()[0] for f in RESULT.split(", ")])

    rows = _rows(docs).withColumn("may_lose", _concerned(spans.select("row_key")))
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    untouched = rows.where(~F.col("may_lose")).select("doc_id", "data", none)
    touched = rows.where("may_lose").join(spans, "row_key", "left").select("doc_id", "data", "spans")
    return untouched.unionByName(touched).mapInArrow(apply, RESULT)
