"""Sets of 64-bit keys as bit maps of a fixed size, built by Spark and broadcast to Python tasks."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIEVE_BITS = 1 << 25


class Sieve:
    """A set of 64-bit keys as two bits each in a map of fixed size: no key is missed, some others pass."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def of(keys: DataFrame, column: str = "key", size: int = SIEVE_BITS) -> Broadcast:
        """Built by Spark; the driver receives at most ``size`` bits in words of 64."""
        places = [F.col(column).bitwiseAND(size - 1), F.shiftrightunsigned(column, 36).bitwiseAND(size - 1)]
        spots = keys.select(F.explode(F.array(*places)).alias("p"))
        one = F.expr("shiftleft(1L, cast(p & 63 as int))")
        words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("x")).toArrow()
        bits = np.zeros(size >> 6, np.int64)
        bits[words.column("w").to_numpy()] = words.column("x").to_numpy()
        return keys.sparkSession.sparkContext.broadcast(Sieve(bits.view(np.uint64)))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        size = np.uint64(len(self.bits) * 64 - 1)
        made = np.ones(len(keys), bool)
        for p in (keys & size, (keys >> np.uint64(36)) & size):
            made &= (self.bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return made
