"""Vectorised hashing of bytes, words and windows (numpy inside tasks).

A run ``c[p:p+L]`` of 64-bit units hashes to ``sum c[p+k] * M**k (mod 2**64)``,
read off prefix sums for all positions at once; ``mix`` spreads the bits.
Such sums are for short runs: texts that differ in a pattern (one and the same
change at places that double a power of two often enough) share the low bits of
their sums, about k*k/2 bits for a pattern of 2**k places, whatever the
multiplier.  So

* whole texts, and words of more than ``SHORT`` bytes, have a digest of their bytes;
* windows mix the sums of both multipliers into one name (``window_names``): 128
  bits, of which a pattern that fits a window of 100 units takes 54.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SHORT = 24
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_U = np.uint64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective spreading of 64-bit values (splitmix64's last steps)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def byte_units(lower: bool = False) -> np.ndarray:
    """256 random 64-bit units; with ``lower`` A-Z have those of a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))
    if lower:
        table[65:91] = table[97:123]
    return table


BYTE_UNITS = byte_units()
LOWER_UNITS = byte_units(lower=True)


def _powers(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(m)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        one = np.ones(1, dtype=np.uint64)
        up = np.concatenate([one, np.cumprod(np.full(size - 1, m, dtype=np.uint64))])
        down = np.concatenate([one, np.cumprod(np.full(size - 1, pow(m, -1, 1 << 64), dtype=np.uint64))])
        have = (up, down)
        if size <= 1 << 23:  # the tables of very long texts are not kept
            _POWERS[m] = have
    return have


class Runs:
    """Hashes of runs of a unit array."""

    def __init__(self, units: np.ndarray, multiplier: int = MULTIPLIERS[0]):
        up, self.down = _powers(len(units) + 1, multiplier)
        self.sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * up[:len(units)], out=self.sums[1:])

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def windows(self, start: np.ndarray, length: int) -> np.ndarray:
        return mix(self.at(start, start + length))


def window_names(units: np.ndarray, first: Runs, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs at ``start``: names made of the sums of both multipliers, and the second's hashes (to deal by)."""
    second = Runs(units, MULTIPLIERS[1]).windows(start, length)
    return mix(first.windows(start, length) + (second << _U(29) | second >> _U(35))), second


def digest(data: bytes | memoryview, size: int = 16) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and its n+1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"" if kind == pa.large_binary() else "")
    n = len(column)
    _, at, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each text's
    n+1 offsets into them.  Words end where a text ends."""
    word = ~((raw == 32) | ((raw - np.uint8(9)) < 5))
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    prior = np.zeros(len(raw) + 1, dtype=bool)
    prior[1:] = word
    starts = np.flatnonzero(word & (~prior[:-1] | edge[:-1]))
    after = np.zeros(len(raw) + 1, dtype=bool)
    after[:-1] = word
    ends = np.flatnonzero(word & (~after[1:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    runs = Runs((LOWER_UNITS if lower else BYTE_UNITS)[raw])
    out = mix(runs.at(starts, ends) + (ends - starts).astype(np.uint64) * _U(0x8BB84B93962EACC9))
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        words = (raw[a:b].tobytes() for a, b in zip(starts[long].tolist(), ends[long].tolist()))
        out[long] = np.frombuffer(b"".join(digest(w.lower() if lower else w, 8) for w in words), dtype="<u8")  # bytes lower A-Z only
    return out
