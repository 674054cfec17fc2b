"""Words of a whole batch of texts as spans of its bytes, hashed without a loop over words.

A batch is one array of bytes with the place where each text begins. Bytes from 0x80 on
count as parts of words throughout, so spans never cut a UTF-8 character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyhall.llm.common import process_state

#: Bytes that words are made of: all but white space (space, tab to carriage return).
SOLID = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
#: Bytes of lower-cased words: digits, letters, everything outside ASCII.
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
#: A-Z to a-z, other bytes as they are.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

RADIX = 0x9E3779B97F4A7C17  # odd, so that it has an inverse modulo 2^64
WORD_RADIX = 0xD1342543DE82EF97


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, one after the other, and where each begins, with the end at last."""
    column = column.cast(pa.large_binary())
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or places[0] == places[-1]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def binary(data: np.ndarray, places: np.ndarray) -> pa.Array:
    """Values cut from an array at ``places``, counted in its elements."""
    offsets = pa.py_buffer((places * data.itemsize).astype(np.int64))
    packed = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
    return packed.cast(pa.binary())


def find_words(part: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``part`` within a text, and the text it is in."""
    n = len(part)
    if not n:
        return (np.empty(0, np.int64),) * 3
    border = np.zeros(n + 1, bool)
    border[places] = True
    border[0] = border[n] = True
    cut = np.ones(n + 1, bool)  # between byte i - 1 and byte i no word goes on
    cut[1:n] = ~(part[1:] & part[:-1]) | border[1:n]
    starts = np.flatnonzero(part & cut[:n])
    ends = np.flatnonzero(part & cut[1:]) + 1
    return starts, ends, np.searchsorted(places, starts, "right") - 1


class Powers:
    """Powers of an odd number modulo 2^64, and of its inverse."""

    def __init__(self, radix: int):
        self.radix, self.inverse = radix, pow(radix, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 20)
            for name, factor in (("up", self.radix), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def powers(radix: int) -> Powers:
    return process_state(f"powers-{radix}", lambda: Powers(radix))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, radix: int) -> np.ndarray:
    """Hash of each run of 64-bit values: a polynomial in ``radix``, by differences of sums."""
    up, down = powers(radix).upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_BYTES = np.random.default_rng(5).integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes, the same in every batch."""
    return span_hashes(_BYTES[data], starts, ends, RADIX)
