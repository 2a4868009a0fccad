"""Token ids of whole texts with the ``tokenizers`` library, inside tasks.

A text is cut into chunks at places where the tokenizer cuts it anyway, and the
ids of a chunk are remembered, so a repeated word is encoded once per worker.
New chunks are encoded many at a time, as one text, whose ids are told apart by
what every chunk ends or begins with.  The ids equal those of encoding the whole text
(tested); a text to which a rule doesn't apply is encoded whole.  Strings of
special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import cache, lru_cache

import numpy as np

CACHE_CHUNKS = 800_000
_TOGETHER = 400  # chunks that are encoded as one text


@cache
def _unicode_class(kind: str) -> str:
    """The ranges of all characters of a general category (by its first letter), for a regular expression."""
    ranges, begin = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and begin is None:
            begin = c
        elif not inside and begin is not None:
            ranges.append(f"{re.escape(chr(begin))}-{re.escape(chr(c - 1))}")
            begin = None
    return "".join(ranges)


# fixed values: the white space of Unicode, and the contractions that both tokenizer files cut off
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'(?:[stmd]|re|ve|ll)"
# fixed values: letters and numbers among the first 256 characters; small classes are searched faster
LATIN_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
# letters whose lower case depends on what follows, or brings a mark
UNSTABLE = re.compile("[\u0130\u03a3]").search


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEnds:
    """For tokenizers that lower-case, drop white space and mark the last token of every word."""

    def __init__(self, tokenizer):
        letter, number = _unicode_class("L"), _unicode_class("N")
        # the most frequent alternative first: none but the last two begin alike
        form = f"[%s]+|[%s]|{CONTRACTIONS}|[^{SPACE}%s%s]+"
        self.find = re.compile(form % (letter, number, letter, number)).findall
        self.find_latin = re.compile(form % (LATIN_LETTER, LATIN_NUMBER, LATIN_LETTER, LATIN_NUMBER)).findall
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.is_end = np.zeros(size, bool)
        for token, k in tokenizer.get_vocab(with_added_tokens=False).items():
            self.is_end[k] = token.endswith("</w>")

    def cut(self, text: str) -> list[str] | None:
        if _is_latin(text):  # nothing to compose
            return self.find_latin(text.lower())
        # composing, or unstable letters, may move a cut
        if not unicodedata.is_normalized("NFC", text) or UNSTABLE(text):
            return None
        return self.find(text.lower())

    def apart(self, encode, chunks: list[str]) -> list[bytes] | None:
        ids = encode(" ".join(chunks))
        end = np.flatnonzero(self.is_end[ids]) + 1
        return _split(ids, np.append(0, end[:-1]), end) if len(end) == len(chunks) and end[-1] == len(ids) else None


class ByteLevel:
    """For byte-level tokenizers that join one blank to the word behind it."""

    def __init__(self, tokenizer):
        letter, number = _unicode_class("L"), _unicode_class("N")
        form = f" ?[%s]+|{CONTRACTIONS}| ?[%s]+| ?[^{SPACE}%s%s]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        self.find = re.compile(form % (letter, number, letter, number)).findall
        self.find_latin = re.compile(form % (LATIN_LETTER, LATIN_NUMBER, LATIN_LETTER, LATIN_NUMBER)).findall
        self.line_break = tokenizer.encode("\n", add_special_tokens=False).ids
        self.blank = re.compile(f"[{SPACE}]*").fullmatch
        self.begins = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, k in tokenizer.get_vocab(with_added_tokens=False).items():
            self.begins[k] = token[0] == "\u0120"  # a blank, in the alphabet of bytes

    def cut(self, text: str) -> list[str] | None:
        return self.find_latin(text) if _is_latin(text) else self.find(text)

    def apart(self, encode, chunks: list[str]) -> list[bytes] | None:
        if any(map(self.blank, chunks)) or len(self.line_break) != 1:
            return None
        if all(c[0] == " " for c in chunks):
            ids = encode("".join(chunks))
            at = np.flatnonzero(self.begins[ids])
            return _split(ids, at, np.append(at[1:], len(ids))) if len(at) == len(chunks) and at[0] == 0 else None
        ids = encode("\n".join(chunks))
        at = np.flatnonzero(ids == self.line_break[0])
        return _split(ids, np.append(0, at + 1), np.append(at, len(ids))) if len(at) == len(chunks) - 1 else None


def _split(ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    raw, width = ids.tobytes(), ids.itemsize
    return [raw[a:b] for a, b in zip((width * begin).tolist(), (width * end).tolist(), strict=True)]


RULES = {"word_ends": WordEnds, "byte_level": ByteLevel}


class Encoder:
    """Packed little-endian unsigned ids of texts, ``width`` bytes each; the cache of chunks is bounded."""

    def __init__(self, path: str, rule: str | None, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.type = np.dtype(f"<u{width}")
        self.rule = RULES[rule](self.tokenizer) if rule else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.type)

    def _learn(self, chunks: list[str]) -> None:
        for k in range(0, len(chunks), _TOGETHER):
            part = chunks[k:k + _TOGETHER]
            found = self.rule.apart(self._ids, part)
            if found is None:
                found = [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self.known.update(zip(part, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.rule.cut(t) if self.rule else None for t in texts]
        if len(self.known) > CACHE_CHUNKS // 2:  # two generations: what is used stays
            self.known, self.older = {}, self.known
        new = set().union(*(c for c in cut if c is not None)).difference(self.known)
        older = {c: self.older[c] for c in new if c in self.older}
        self.known.update(older)
        rest = new.difference(older)
        after_blank = [c for c in rest if c[0] == " "]
        for kind in (after_blank, list(rest.difference(after_blank))):  # what may need a fallback apart from plain words
            odd = [c for c in kind if not c.strip()]
            self._learn(odd)
            self._learn([c for c in kind if c.strip()] if odd else kind)
        known = self.known.__getitem__
        return [self._ids(t).tobytes() if c is None else b"".join(map(known, c)) for t, c in zip(texts, cut, strict=True)]


@lru_cache(maxsize=4)
def encoder(path: str, rule: str | None, width: int = 4) -> Encoder:
    """One encoder per worker process and tokenizer; it lives on across tasks."""
    return Encoder(path, rule, width)


def id_width(path: str) -> int:
    """Bytes that an id of this tokenizer needs: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def batches(texts: list[str], chars: int = 1 << 20):
    """Slices of ``texts`` of bounded total length (a single longer text stands alone)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part
