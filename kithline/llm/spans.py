"""Vectorised words of UTF-8 buffers: maximal runs without the bytes 0x20 and 0x09-0x0D."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of a buffer of texts: byte ``starts`` and ``ends``; text d has words bounds[d] to bounds[d + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        white = WHITE[data]
        before = np.ones(len(data), bool)
        before[1:] = white[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = white[1:]
        inner = offsets[offsets < len(data)]
        before[inner] = True
        last = offsets[offsets > 0] - 1
        after[last] = True
        self.data, self.offsets, self.white = data, offsets, white
        self.starts = np.flatnonzero(~white & before)
        self.ends = np.flatnonzero(~white & after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def array(self) -> pa.Array:
        """The words as an Arrow binary array."""
        at = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=at[1:])
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(at), pa.py_buffer(self.data[~self.white])])

    def hashes(self) -> np.ndarray:
        """XXH64 of each word, computed once for each distinct word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        coded = self.array().dictionary_encode()
        digest = xxhash.xxh64_intdigest
        own = np.array([digest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        return own[coded.indices.to_numpy()]

    def spaced(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Each text's words joined by one space, as one byte string, and each word's start and end there."""
        keep = ~self.white
        text = np.searchsorted(self.bounds, np.arange(len(self)), "right")
        joint = self.ends[:-1][text[:-1] == text[1:]] if len(self) else self.ends
        keep[joint] = True
        data = self.data.copy()
        data[joint] = 0x20
        place = np.cumsum(keep) - 1
        starts = place[self.starts]
        return data[keep].tobytes(), starts, starts + (self.ends - self.starts)


def rolling(hashes: np.ndarray, length: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of every ``length`` consecutive values; made by doubling."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    mask = (1 << 64) - 1
    done, out, span, power = 0, None, hashes, factor
    rest, width = length, 1
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out, done = span, width
                else:
                    n = min(len(out), len(span) - done)
                    out = out[:n] * np.uint64(power) + span[done : done + n]
                    done += width
            rest >>= 1
            if rest:
                n = len(span) - width
                span = span[:n] * np.uint64(power) + span[width:]
                width *= 2
                power = power * power & mask
        return mixed(out[: len(hashes) - length + 1])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that any of their bits can choose a bucket."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
