"""Operator 12: SentencePiece ids with the source bytes of every piece, and back.

Encoding keeps track of places in three steps.

* Normalising: at each place the longest prefix that the model's compiled
  character map knows is replaced (the map is a double-array trie), any other
  character stands for itself; blanks and the prefix mark follow the model's
  settings.  Every character that comes out records the source byte it stems from.
* Segments: the normalised text is cut where no piece of the vocabulary holds the two
  neighbours side by side, so no merge crosses a cut; each distinct segment is
  encoded once a task.  The ids equal those of encoding the text as a whole.
* Spans: a piece covers as many normalised characters as it spells, and their
  sources give its span of original bytes.  Of the byte pieces of one character the
  last has the character's span and those before it an empty one at its start; the
  begin and end ids have empty spans at the ends.  The spans of a text tile it.

Decoding is the library's ``decode``.

Models must be BPE models with byte fallback and without user-defined pieces;
others raise ``ValueError``.  Cases: null and empty texts give the begin and end
ids alone and decode to the empty text; repeated rows are encoded each; an empty table
gives an empty result.  The model file must be readable on the executors.
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

MARK = "▁"  # fixed: stands for a blank in pieces
SEPARATOR = "\n"  # segments are encoded together, apart by it, if no longer piece holds it
TOGETHER = 500
CACHE_SEGMENTS = 300_000
PART_CHARS = 1 << 20

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, source_bytes long, spans_crc32 long"
ENCODED = "doc_id long, ids array<int>, starts array<long>, ends array<long>"


class CharacterMap:
    """Longest-prefix replacement by a compiled character map.

    Layout: the trie's size in bytes (little-endian, 4 bytes), its units, then the
    replacements, each ended by a zero byte.  The rules of a unit are those of the
    published double-array trie format: bit 8 says that a value hangs on it, bits 10
    up are the offset (times 256 if bit 9 is set), bits 0 to 7 and 31 are the label.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length of the longest known prefix at a place, its replacement)."""
        units, found, pos = self.units, None, 0
        unit = units[0]
        pos ^= _offset(unit)
        for k in range(at, len(data)):
            pos ^= data[k]
            unit = units[pos]
            if unit & 0x800000FF != data[k]:
                break
            pos ^= _offset(unit)
            if unit >> 8 & 1:
                value = units[pos] & 0x7FFFFFFF
                found = k + 1 - at, self.texts[value:self.texts.index(0, value)]
        return found


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & (1 << 9)) >> 6)


def _fields(message: bytes):
    """(number, value) of the fields of a serialised message; varints as int, the rest as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}[tag & 7] if tag & 7 != 2 else varint()
            yield tag >> 3, message[at:at + n]
            at += n


class Normaliser:
    """Text to normalised text, with the source byte of every character."""

    def __init__(self, spec: bytes, suffix: bool = False):
        # fixed by the model format: fields of the normaliser's settings, and their defaults
        f = {2: b"", 3: 1, 4: 1, 5: 1} | dict(_fields(spec))
        self.map = CharacterMap(f[2])
        self.prefix, self.squeeze, self.mark = bool(f[3]), bool(f[4]), MARK if f[5] else " "
        self.suffix = suffix

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each character and its end, the source byte."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return "", np.zeros(1, np.int64)
        if self.map or self.squeeze:
            return self._general(data)
        head = bool(self.prefix)
        if len(data) == len(text):
            at = np.arange(len(data) + 1)
        else:
            at = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
        out = text.replace(" ", self.mark)
        if head and self.suffix:
            return out + self.mark, np.append(at, len(data))
        return (self.mark + out, np.append(0, at)) if head else (out, at)

    def _units(self, data: bytes):
        """(source place, what it becomes) of each replaced prefix or single character."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at) if self.map else None
            if hit is None:
                lead = data[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = n, data[at:at + n]
            yield at, hit[1].decode("utf-8", "surrogatepass")
            at += hit[0]

    def _general(self, data: bytes) -> tuple[str, np.ndarray]:
        out, at = [], []
        begun, blank, end = False, self.squeeze, len(data)
        for place, piece in self._units(data):
            if not begun:
                if self.squeeze and piece == " ":
                    continue
                begun = True
                if self.prefix and not self.suffix:
                    out.append(self.mark)
                    at.append(place)
            if blank:
                piece = piece.lstrip(" ")
            for c in piece:
                out.append(self.mark if c == " " else c)
                at.append(place)
            if piece:
                blank = self.squeeze and piece.endswith(" ")
        if not begun:
            return "", np.zeros(1, np.int64)
        if self.squeeze:
            while out and out[-1] in (" ", MARK):
                out.pop()
                end = at.pop()
        if self.prefix and self.suffix:
            out.append(self.mark)
            at.append(end)
        return "".join(out), np.array([*at, end], np.int64)


def _cuts(pieces: list[str]):
    """The finder of segments of normalised texts; None if texts can't be cut for this vocabulary."""
    begins, follows = set(), set()
    for p in pieces:
        body = p.lstrip(MARK)
        if MARK in body:
            return None
        if len(p) > 1:
            begins.add(p[0])
            follows.update(body if len(body) < len(p) else p[1:])
    def chars(cs):
        return "".join(re.escape(c) for c in sorted(cs)) or "\\b"

    tail = f"[{chars(follows)}]*" if follows else ""
    return re.compile(f"{MARK}+{tail}|[{chars(begins - {MARK})}]{tail}|.", re.DOTALL).findall


class Codec:
    """Ids and spans of texts by one model."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        fields = list(_fields(model))
        spec = b"".join(v for k, v in fields if k == 3)
        trainer = dict(_fields(b"".join(v for k, v in fields if k == 2)))
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        # the same pieces behind a normaliser that changes nothing; later fields replace earlier ones
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=model + _PLAIN)
        size = self.processor.get_piece_size()
        kinds = [dict(_fields(v)).get(3, 1) for k, v in fields if k == 1]
        if trainer.get(3, 1) != 2 or 6 not in kinds or 4 in kinds:
            raise ValueError("the model must be a BPE model with byte fallback and without user-defined pieces")
        self.normalise = Normaliser(spec, bool(trainer.get(24, 0)))
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        names = [self.processor.id_to_piece(k) for k in range(size)]
        self.find = _cuts([n for n, kind in zip(names, kinds, strict=True) if kind in (1, 5)])
        self.chars = np.array([len(n) if kind in (1, 5) else 0 for n, kind in zip(names, kinds, strict=True)])
        byte = np.array([int(n[3:5], 16) if kind == 6 else -1 for n, kind in zip(names, kinds, strict=True)])
        self.follows = (byte >= 0x80) & (byte < 0xC0)  # byte pieces inside a character
        self.chars[(byte >= 0) & (byte < 0x80)] = 1
        apart = np.array(self.plain.encode(SEPARATOR), self.type)
        longer = any(SEPARATOR in n for n, kind in zip(names, kinds, strict=True) if kind in (1, 5) and len(n) > 1)
        self.apart = apart[0] if len(apart) == 1 and not longer else None
        self.known: dict[str, bytes] = {}

    def forget(self) -> None:
        self.known = {}

    def _learn(self, segments: list[str]) -> None:
        odd = [s for s in segments if s == SEPARATOR or self.apart is None]
        for s, ids in zip(odd, self.plain.encode(odd, num_threads=1), strict=True):
            self.known[s] = np.array(ids, self.type).tobytes()
        rest = [s for s in segments if s != SEPARATOR] if self.apart is not None else []
        for k in range(0, len(rest), TOGETHER):
            part = rest[k:k + TOGETHER]
            ids = np.array(self.plain.encode(SEPARATOR.join(part)), self.type)
            end = np.append(np.flatnonzero(ids == self.apart), len(ids))
            raw, w = ids.tobytes(), self.type.itemsize
            begin = np.append(0, end[:-1] + 1)
            self.known.update(zip(part, [raw[w * a:w * b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], strict=True))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: ids with begin and end, and, for each id and the end, where its source bytes begin."""
        forms = [self.normalise(t) for t in texts]
        cut = [self.find(n) if self.find else [n] for n, _ in forms]
        if len(self.known) > CACHE_SEGMENTS:
            self.forget()
        self._learn(list(set().union(*cut).difference(self.known)))
        known, out = self.known.__getitem__, []
        for (normal, source), parts in zip(forms, cut, strict=True):
            ids = np.frombuffer(b"".join(map(known, parts)), self.type).astype(np.int64)
            out.append((np.concatenate([[self.processor.bos_id()], ids, [self.processor.eos_id()]]), self._starts(ids, normal, source)))
        return out

    def _starts(self, ids: np.ndarray, normal: str, source: np.ndarray) -> np.ndarray:
        chars = self.chars[ids]
        inside = self.follows[ids]
        if inside.any():  # the last byte piece of a character stands for it
            chars = chars + (inside & ~np.append(inside[1:], False))
        ends = np.cumsum(chars)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError("the pieces don't spell the normalised text")
        starts = source[np.append(0, ends)]
        starts[0] = 0  # what normalising drops belongs to the piece before it, and at the beginning to the first one
        return np.concatenate([[0], starts, source[-1:]]) if len(ids) else np.zeros(3, np.int64)


def _message(number: int, body: bytes) -> bytes:
    return bytes([number << 3 | 2, len(body)]) + body


# the normaliser's settings (field 3) of the plain processor: no map, no prefix, nothing removed, blanks as they are
_PLAIN = _message(3, _message(2, b"") + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0]))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _parts(batch):
    keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    a = size = 0
    for k, t in enumerate(texts):
        if k > a and size + len(t) > PART_CHARS:
            yield keys[a:k], texts[a:k]
            a, size = k, 0
        size += len(t)
    if a < len(texts):
        yield keys[a:], texts[a:]


def _documents(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per document: its ids (with begin and end) and each id's span of the text's UTF-8 bytes."""
    def encode(rows):
        c = codec(path)
        try:
            for batch in rows:
                for keys, texts in _parts(batch):
                    coded = c.encode(texts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), _lists([i for i, _ in coded], pa.int32()),
                         _lists([s[:-1] for _, s in coded], pa.int64()), _lists([s[1:] for _, s in coded], pa.int64())],
                        ["doc_id", "ids", "starts", "ends"])
        finally:
            c.forget()

    return _documents(docs).mapInArrow(encode, ENCODED)


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    at = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(arrays), kind))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; a null list decodes to the empty text."""
    def decode(rows):
        sp = codec(path).processor
        for batch in rows:
            texts = sp.decode([[] if i is None else i for i in batch.column(1).to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def describe_codes(docs: DataFrame, path: str) -> DataFrame:
    """Per document: digests of its ids, of the decoded text and of the span borders, in one pass."""
    def describe(rows):
        c = codec(path)
        try:
            for batch in rows:
                for keys, texts in _parts(batch):
                    coded = c.encode(texts)
                    decoded = c.processor.decode([i.tolist() for i, _ in coded], num_threads=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array([len(i) for i, _ in coded], pa.int64()),
                         pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i, _ in coded], pa.string()),
                         pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decoded], pa.string()),
                         pa.array([int(s[-1]) for _, s in coded], pa.int64()),
                         pa.array([zlib.crc32(s.astype("<i8").tobytes()) for _, s in coded], pa.int64())],
                        [f.split()[0] for f in RESULT.split(", ")])
        finally:
            c.forget()

    return _documents(docs).mapInArrow(describe, RESULT)
