"""Whole Arrow batches cut into words and hashed with numpy, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in runs of about this many bytes, hashes in runs of this many items.
BLOCK_BYTES = 1 << 19

# The six white-space bytes, A-Z, and multipliers of the splitmix64 generator.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STEP = 0x9E3779B97F4A7C15
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

# Odd, so that it has an inverse modulo 2^64.
RADIX = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(3) + mix(b + np.uint64(STEP)))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", RADIX), ("down", pow(RADIX, -1, 1 << 64))):
            made = np.full(max(n, BLOCK_BYTES), base, np.uint64)
            made[0] = 1
            _powers[name] = np.multiply.accumulate(made)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of a sequence of numbers; equal spans have equal hashes.

    Prefix sums of mixed values times powers of an odd radix; a span's difference is
    brought to a common exponent.  Spans must be ordered by start.  Long sequences are
    worked on in runs, so memory follows the longest span.
    """
    made = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        begin = int(starts[done])
        upto = int(np.searchsorted(starts, begin + BLOCK_BYTES))
        finish = int(ends[done:upto].max())
        up, down = _power(finish - begin + 1)
        sums = np.zeros(finish - begin + 1, np.uint64)
        np.cumsum(mix(values[begin:finish].astype(np.uint64) + np.uint64(STEP)) * up[:-1], out=sums[1:])
        a, b = starts[done:upto] - begin, ends[done:upto] - begin
        made[done:upto] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        done = upto
    return made


_byte_mix = mix(np.arange(256, dtype=np.uint64) + np.uint64(STEP))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of true, broken at row offsets."""
    n = len(inside)
    broken = np.zeros(n + 1, bool)
    broken[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | broken[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | broken[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def text_blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of consecutive rows; null texts count as empty."""
    texts = pc.fill_null(batch.column(column), "")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1)
        end = min(end, len(texts))
        yield first, end, offsets[first : end + 1] - offsets[first], content[offsets[first] : offsets[end]]
        first = end


class Tally:
    """Sums counts by 64-bit keys, carrying further columns; holds a bounded number of keys."""

    def __init__(self, limit: int = 1 << 19):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray, *carried: np.ndarray) -> None:
        if len(keys):
            self.parts.append(self._sum([(keys, counts, *carried)]))
            self.held += len(self.parts[-1][0])

    @staticmethod
    def _sum(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, counts, *carried = (np.concatenate(x) for x in zip(*parts, strict=True))
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return (unique, np.bincount(inverse, counts, len(unique)).astype(np.int64), *(c[first] for c in carried))

    def full(self) -> bool:
        """Merge what is held; true if it is still more than the limit."""
        if self.held > 1.5 * self.limit:
            self.parts = [self._sum(self.parts)]
            self.held = len(self.parts[0][0])
        return self.held > self.limit and len(self.parts) == 1

    def take(self) -> tuple[np.ndarray, ...] | None:
        made = self._sum(self.parts) if self.parts else None
        self.parts, self.held = [], 0
        return made


def lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, -1)


class Places:
    """Index of keys in a sorted table of 64-bit hashes, -1 if they are not there; their leading bits tell where to look."""

    def __init__(self, table: np.ndarray):
        self.table, self.starts = table, None

    def __getstate__(self) -> dict:
        return {"table": self.table, "starts": None}

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        made = np.full(len(keys), -1)
        if not len(self.table):
            return made
        bits = max(1, int(len(self.table)).bit_length())
        shift = np.uint64(64 - bits)
        if self.starts is None:
            many = np.bincount((self.table >> shift).astype(np.int64), minlength=1 << bits)
            self.starts = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
        part = (keys >> shift).astype(np.int64)
        at, end = self.starts[part], self.starts[part + 1]
        left = np.flatnonzero(at < end)
        at, end, keys = at[left], end[left], keys[left]
        while len(left):
            good = self.table[at] == keys
            made[left[good]] = at[good]
            more = np.flatnonzero(~good & (at + 1 < end))
            left, at, end, keys = left[more], at[more] + 1, end[more], keys[more]
        return made
