"""Operator 7: secret scan of whole texts.

An Aho-Corasick automaton over lower-cased bytes finds the keywords; regular
expressions anchored at a hit decide the span; token formats that embed a
checksum count only when it is right.  Long hexadecimal runs have no keyword:
they are found by their run length over the bytes.  All patterns are ASCII, so
matching UTF-8 bytes equals matching code points; spans are reported in code
points, end exclusive.

Kinds, in the order of ties: ``assign`` (group 2 of at least 6 characters),
``access`` (at least 20), ``hex`` (at least 24), each the leftmost
non-overlapping matches of its pattern with failing ones dropped afterwards;
then the checksummed kinds ``github`` and ``npm``: a prefix, 30 base-62
characters and the CRC-32 of those in 6 base-62 digits.

Cases: null and empty texts have no spans; repeated rows are scanned each; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import small_batches, text_of

# fixed values: the patterns and least lengths of the base kinds
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
HEX_DIGITS = b"0123456789abcdef"
# fixed values: published prefixes of tokens that end in a base-62 CRC-32
CHECKSUMMED = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, *CHECKSUMMED)
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",), **CHECKSUMMED}

RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def checksum62(body: bytes) -> bytes:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d:d + 1] + out
    return out


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                self.automaton.add_word(w, (kind, len(w)))
        self.automaton.make_automaton()
        self.assign = re.compile(ASSIGN, re.IGNORECASE)
        self.access = re.compile(ACCESS)
        self.token = re.compile(rb"[a-z]{3}_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
        self.is_hex = np.zeros(256, bool)
        self.is_hex[list(HEX_DIGITS)] = True

    def match(self, kind: str, data: bytes, at: int):
        """Where the anchored match ends, and whether it counts."""
        if kind == "assign":
            m = self.assign.match(data, at)
            return m and (m.end(), m.end(2) - m.start(2) >= ASSIGN_LEAST)
        if kind == "access":
            m = self.access.match(data, at)
            return m and (m.end(), m.end() - at >= ACCESS_LEAST)
        m = self.token.match(data, at)
        return m and (m.end(), data[at:at + 4].decode() in CHECKSUMMED[kind] and checksum62(m[1]) == m[2])

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, kind's number, end) in bytes, sorted."""
        found: list[tuple[int, int, int]] = []
        # bytes.lower() changes ASCII letters only; latin-1 keeps one character a byte
        hits = sorted((end + 1 - n, kind) for end, (kind, n) in self.automaton.iter(data.lower().decode("latin-1")))
        free = dict.fromkeys(KINDS, 0)
        for at, kind in hits:
            if at >= free[kind] and (m := self.match(kind, data, at)):
                free[kind] = m[0]
                if m[1]:
                    found.append((at, KINDS.index(kind), m[0]))
        if len(data) >= HEX_LEAST:
            flags = np.zeros(len(data) + 2, np.int8)
            flags[1:-1] = self.is_hex[np.frombuffer(data, np.uint8)]
            edge = np.diff(flags)
            start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            for k in np.flatnonzero(end - start >= HEX_LEAST).tolist():
                found.append((int(start[k]), KINDS.index("hex"), int(end[k])))
        return sorted(found)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan_text(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, end, kind) in code points, by start, then kind."""
    data = text.encode("utf-8", "surrogatepass")
    spans = scanner().spans(data)
    if len(data) != len(text) and spans:  # byte offsets to code points: count what is no continuation byte
        points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
        return [(int(points[a]), int(points[b]), KINDS[k]) for a, k, b in spans]
    return [(a, b, KINDS[k]) for a, k, b in spans]


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans."""
    def scan(rows):
        for batch in rows:
            cols = ([], [], [], [], [])
            for text in batch.column(1).to_pylist():
                spans = scan_text(text)
                base = [s for s in spans if s[2] in BASE_KINDS]
                joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
                for col, kind in zip(cols, BASE_KINDS, strict=False):
                    col.append(sum(s[2] == kind for s in base))
                cols[3].append(hashlib.sha256(joined.encode()).hexdigest())
                cols[4].append(",".join(f"{k}:{a}:{b}" for a, b, k in spans))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in RESULT.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(scan, RESULT)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; other columns unchanged."""
    @F.pandas_udf("string")
    def mask(texts):
        def one(text):
            out, at = [], 0
            for a, b, kind in scan_text(text):
                if a >= at:
                    out += [text[at:a], f"<{kind}>"]
                at = max(at, b)
            return "".join([*out, text[at:]])

        return texts.map(one)

    return docs.withColumn("text", F.when(F.col("text").isNotNull(), mask(text_of())))
