"""A fixed-size bit filter over hashes, gathered by Spark and sent to every task.

Its size is a parameter and does not grow with the rows, so it may be broadcast at any scale. It has no false negatives;
false positives only let a few more rows through to the exact join that follows each use.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
LOG2_BITS = 25  # 4 MB


def _positions(hashes: np.ndarray, probe: int, log2_bits: int) -> np.ndarray:
    shift, mask = np.uint64(probe * 13), np.uint64((1 << log2_bits) - 1)
    return ((hashes >> shift) ^ (hashes << np.uint64(7 * probe))) & mask


def _position(h: Column, probe: int, log2_bits: int) -> Column:
    mixed = F.shiftrightunsigned(h, probe * 13).bitwiseXOR(F.shiftleft(h, 7 * probe))
    return mixed.bitwiseAND(F.lit((1 << log2_bits) - 1))


class BitFilter:
    def __init__(self, words: np.ndarray, log2_bits: int) -> None:
        self.words, self.log2_bits = words, log2_bits

    @classmethod
    def gather(cls, df: DataFrame, column: str, log2_bits: int = LOG2_BITS) -> BitFilter:
        """The filter of a column of 64-bit hashes (long). At most 2^log2_bits / 64 sums reach the driver."""
        h = F.col(column).cast("long")
        places = df.select(F.explode(F.array(*(_position(h, k, log2_bits) for k in range(PROBES)))).alias("at"))
        rows = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
        )
        words = np.zeros(1 << (log2_bits - 6), np.uint64)
        table = rows.where("word is not null").toArrow()
        words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
        return cls(words, log2_bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that may be members."""
        left = np.arange(len(hashes))
        for probe in range(PROBES):
            at = _positions(hashes[left], probe, self.log2_bits)
            bit = (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
            left = left[bit.astype(bool)]
        return left
