"""A membership filter of fixed size: it passes every member and a few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 24  # 2 MB, whatever the number of members
PROBES = (0, 20, 40)  # which bits of a 64-bit hash choose its bits in the filter


def build_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Flags of the 64-bit hashes in ``column``, packed into 64-bit words; at most 262,144 rows arrive here."""
    at = F.explode(F.array(*[F.shiftrightunsigned(column, s).bitwiseAND((1 << FILTER_BITS) - 1) for s in PROBES]))
    words = (hashes.select(at.alias("bit")).select(F.shiftright("bit", 6).alias("word"),
                                                   F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("flag"))
             .groupBy("word").agg(F.bit_or("flag").alias("flags")).collect())
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    if words:
        out[np.array([r["word"] for r in words])] = np.array([r["flags"] for r in words], np.int64).view(np.uint64)
    return out


def passing(flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where the unsigned 64-bit ``hashes`` are that may be members."""
    left = np.arange(len(hashes))
    for shift in PROBES:
        bit = (hashes[left] >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
        left = left[((flags[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)]
    return left
