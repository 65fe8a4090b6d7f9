"""Vectorised cutting and hashing of whole texts, a few MB at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

LANES = 8  #: 8-byte lanes of a span that are hashed together with other spans; longer spans are hashed one by one
BLOCK = 4 << 20  #: bytes of text hashed at once; a longer text is a block of its own

SPACES = np.zeros(256, bool)  #: \x20 and \x09-\x0D
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are, or may begin, a white-space character.
MAY_SPACE = SPACES.copy()
MAY_SPACE[[0xC2, 0xE1, 0xE2, 0xE3, *range(0x1C, 0x20)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  #: keeps the first k bytes of a lane
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Lanes:
    """Reads spans of bytes 8 at a time, zero behind their ends."""

    def __init__(self, data: np.ndarray) -> None:
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.at = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))

    def read(self, starts: np.ndarray, size: np.ndarray, j: int) -> np.ndarray:
        return self.at[starts + 8 * j].view(np.uint64).reshape(-1) & _MASKS[np.minimum(size - 8 * j, 8)]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end].

    Every 8 bytes are stirred in by a bijection that spreads all bits, so no sums or products of
    texts can cancel; spans of more than 8 * LANES bytes take XXH3. Two different strings share a
    hash with odds of 2**-64. Where that could decide a result, contents are compared (``distinct``)
    or a second seed is used beside.
    """
    size = ends - starts
    h = mix(size.astype(np.uint64) * _STEP + np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64))
    if not len(starts):
        return h
    lanes, on = _Lanes(data), np.flatnonzero((size > 0) & (size <= 8 * LANES))
    for j in range(LANES):
        if not len(on):
            break
        h[on] = mix((h[on] ^ lanes.read(starts[on], size[on], j)) * _STEP)
        on = on[size[on] > 8 * (j + 1)]
    for i in np.flatnonzero(size > 8 * LANES).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], seed)
    return h


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different string among the spans, and each span's string; contents decide, not hashes."""
    _, at, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    to = starts[at[which]]
    unlike = size != size[at[which]]
    lanes, on = _Lanes(data), np.flatnonzero(~unlike & (size <= 8 * LANES) & (to != starts))
    for j in range(LANES):
        on = on[size[on] > 8 * j]
        if not len(on):
            break
        unlike[on] |= lanes.read(starts[on], size[on], j) != lanes.read(to[on], size[on], j)
    for i in np.flatnonzero(~unlike & (size > 8 * LANES) & (to != starts)).tolist():
        unlike[i] = data[starts[i] : ends[i]].tobytes() != data[to[i] : to[i] + size[i]].tobytes()
    if unlike.any():  # a hash has met another: these strings are told apart one by one
        places: dict[bytes, int] = {}
        found = np.array([places.setdefault(data[a:b].tobytes(), len(places)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        _, at, which = np.unique(found, return_index=True, return_inverse=True)
    return at, which


class Block:
    """Some rows' texts: ``data`` (bytes), ``bounds`` (of each text in data), ``rows`` (slice of the batch)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int) -> None:
        self.data, self.bounds, self.first, self.n = data, bounds, first, len(bounds) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of all texts: start and end of each, and the number of words before each text (n + 1 numbers)."""
        inside = ~SPACES[self.data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = self.bounds[1:-1]  # no word crosses from one text into the next
        edges = edges[(edges > 0) & (edges < len(inside))]
        starts[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return s, e, np.searchsorted(s, self.bounds)

    def chunks(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of the chunks that begin where ``starts`` is true and where a text begins."""
        starts = starts.copy()
        filled = self.bounds[:-1][self.bounds[1:] > self.bounds[:-1]]
        starts[filled] = True
        s = np.flatnonzero(starts)
        e = np.append(s[1:], len(self.data))
        return s, e, np.searchsorted(s, self.bounds)


@cache
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # not glibc
        return None


def trim() -> None:
    """Give freed memory back, since Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """Texts (no nulls) of one Arrow batch in blocks of about ``limit`` bytes."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield Block(data[at[i] : at[j]], at[i : j + 1] - at[i], i)
        i = j
    trim()


def pack(a: np.ndarray) -> bytes:
    """An array of numbers, byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes(), 1)


def unpack(packed: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def spread(lengths: np.ndarray) -> np.ndarray:
    """0 .. length-1 for each length, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
