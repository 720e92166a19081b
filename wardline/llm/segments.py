"""Whitespace-led segments of a batch of texts, hashed and encoded once each without a Python loop over words.

A segment starts where ASCII white space follows something that is surely no white space, so no
tokenizer pattern whose matches hold white space only at their front can span two segments.
Encoding the distinct segments of a batch therefore encodes the batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa

#: Bytes hashed at a time.
PART_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and n + 1 offsets; a null text has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[starts[0]:starts[-1]], starts - starts[0]


def segment_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where a segment starts, text starts included, in ascending order.

    No start is set after a byte that may end a non-ASCII white space, which only makes a
    segment longer.
    """
    n = len(flat)
    start = np.zeros(n + 1, bool)
    if n > 1:
        space = _SPACE[flat]
        start[1:n] = space[1:] & ~space[:-1]
        doubt = np.flatnonzero(start[1:n] & (flat[:-1] >= 0x80)) + 1
        two = flat[np.maximum(doubt - 2, 0)] == 0xC2
        three = np.isin(flat[np.maximum(doubt - 3, 0)], (0xE1, 0xE2, 0xE3))
        start[doubt[two | three]] = False
    start[offsets[:-1]] = True
    return np.flatnonzero(start[:n])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A to Z in lower case, starts and ends of the words, offsets of the texts among the words).

    A word is a run without ASCII white space; no word crosses from one text to the next.
    """
    flat, offsets = utf8_bytes(texts)
    flat = _LOWER[flat]
    inside = np.zeros(len(flat) + 2, np.int8)
    inside[1:-1] = ~_SPACE[flat]
    change = np.diff(inside)
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(flat))]
    joins = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])  # two texts meet inside a word
    starts = np.sort(np.append(np.flatnonzero(change == 1), joins))
    ends = np.sort(np.append(np.flatnonzero(change == -1), joins))
    return flat, starts, ends, np.searchsorted(starts, offsets)


def range_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: polynomial prefix sums, the length mixed in."""
    sums = prefix_sums(flat)
    return mixed((sums[ends] - sums[starts]) * inverse_powers(len(flat) + 1)[starts], ends - starts)


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n + n // 8, 1), base, np.uint64)  # also for a batch without a byte
        held[0] = 1
        _POWERS[base] = held = np.multiply.accumulate(held)
    return held[:n]


def inverse_powers(n: int) -> np.ndarray:
    """B to the power -i modulo 2**64, for i below n."""
    return _powers(pow(_BASE, -1, 1 << 64), n)


def prefix_sums(flat: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * B**i modulo 2**64 before each position."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(flat)), out=sums[1:])
    return sums


def mixed(values: np.ndarray, extra: np.ndarray | int = 0) -> np.ndarray:
    """Every bit of the result depends on every bit of the values."""
    h = values + np.asarray(extra).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


_HELD: dict[tuple, object] = {}


def let_go() -> None:
    """Give back what operators before this one left in a reused worker."""
    _HELD.clear()
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library frees pages by itself


def held(key: tuple, make: Callable):
    """The one large object of this worker; that of another key goes first."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


class Memo:
    """What an encoder gave for the segments seen so far in this worker: a ragged array by hash.

    The encoder sees each new segment once. Beyond ``most`` segments or ``most_bytes`` of results
    the segments met most often stay, half as many at most, so memory is bounded.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 350_000,
                 kind=np.int32, most_bytes: int = 40 << 20):
        """``encode`` returns the results of a list of segments end to end, and the size of each."""
        self.encode, self.most, self.kind, self.most_bytes = encode, most, kind, most_bytes
        self.clear()

    def clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.offsets, self.values = np.zeros(1, np.int64), np.zeros(0, self.kind)
        self.hits = np.zeros(0, np.int32)

    def _keep_hot(self) -> None:
        """Drop all but the segments of most hits."""
        room = self.most // 2
        least = np.partition(self.hits, -room)[-room] if len(self.hits) > room else -1
        stay = np.flatnonzero(self.hits > least)
        sizes = np.diff(self.offsets)
        if sizes[stay].sum() * self.values.itemsize > self.most_bytes // 2:
            self.clear()
            return
        new_row = np.full(len(self.hits), -1)
        new_row[stay] = np.arange(len(stay))
        self.values, self.offsets = ragged(self.offsets, self.values, stay)
        self.hits = self.hits[stay] // 2
        live = new_row[self.rows] >= 0
        self.keys, self.rows = self.keys[live], new_row[self.rows[live]]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rows[at], -1)

    def __call__(self, flat: np.ndarray, offsets: np.ndarray,
                 starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(results of all texts end to end, offsets of the texts among them).

        ``starts``: where segments start, text starts included; by default at white space.
        """
        starts = segment_starts(flat, offsets) if starts is None else starts
        ends, found, at = np.append(starts[1:], len(flat)), [np.zeros(0, self.kind)], 0
        sizes = np.zeros(len(starts), np.int64)
        while at < len(starts):
            # a part of a long text at a time, so that the sums over its bytes stay small
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + PART_BYTES, side="right")))
            low = starts[at]
            values, sizes[at:to] = self._part(flat[low:ends[to - 1]], starts[at:to] - low, ends[at:to] - low)
            found.append(values)
            at = to
        return np.concatenate(found), np.append(0, np.cumsum(sizes))[np.searchsorted(starts, offsets)]

    def _part(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coded, keys = pd.factorize(range_hashes(flat, starts, ends))
        if len(self.keys) + len(keys) > self.most or self.values.nbytes > self.most_bytes:
            self._keep_hot()
        rows = self._find(keys)
        self.hits[rows[rows >= 0]] += 1
        new = np.flatnonzero(rows < 0)
        if len(new):
            first = np.zeros(len(keys), np.int64)
            first[coded[::-1]] = np.arange(len(coded) - 1, -1, -1)
            data = flat.tobytes()
            values, sizes = self.encode(
                [data[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            rows[new] = len(self.offsets) - 1 + np.arange(len(new))
            self.offsets = np.append(self.offsets, self.offsets[-1] + np.cumsum(sizes))
            self.values = np.append(self.values, values)
            self.hits = np.append(self.hits, np.zeros(len(new), np.int32))
            by_key = new[np.argsort(keys[new])]
            at = np.searchsorted(self.keys, keys[by_key])
            self.keys, self.rows = np.insert(self.keys, at, keys[by_key]), np.insert(self.rows, at, rows[by_key])
        picked, at = ragged(self.offsets, self.values, rows[coded])
        return picked, np.diff(at)


def slices(texts: pa.Array, most: int = 8 << 20):
    """(from, to) row ranges of about ``most`` bytes each; a longer text is alone in its range."""
    flat, offsets = utf8_bytes(texts)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, min(to, n)
        at = to


def ragged(offsets: np.ndarray, values: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``picks`` of the ragged array (offsets, values) end to end, and their offsets."""
    sizes = (offsets[1:] - offsets[:-1])[picks]
    ends = np.cumsum(sizes)
    out = np.zeros(len(picks) + 1, np.int64)
    out[1:] = ends
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total, dtype=np.int64) + np.repeat(offsets[:-1][picks] - out[:-1], sizes)
    return values[place], out
