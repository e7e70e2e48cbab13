"""Words, hashes and k-word windows of Arrow text columns, computed with numpy inside a task.

A word is a maximal run of bytes other than space and tab to carriage return, so every word is cut between whole UTF-8
characters. NULL text has no words. Rows are handled in groups of about ``LIMIT`` bytes, which bounds the memory of a
task; one longer text is a group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LIMIT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(LIMIT + 1, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.cumprod(table, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser, fixed constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of consecutive rows from row ``first`` on: row ``i`` of them owns bytes ``offsets[i]:offsets[i + 1]`` of
    ``data`` and words ``bounds[i]:bounds[i + 1]``, which are its bytes ``starts:ends``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers()
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + LIMIT, "right"))
        if j <= i:  # one word longer than the tables
            digest = hashlib.blake2b(data[base : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, np.uint64)[0]
            i += 1
            continue
        part = data[base : ends[j - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out)


def text_groups(texts: pa.Array, limit: int = LIMIT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of groups of rows of at most about ``limit`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
    pa.default_memory_pool().release_unused()


def words_of(texts: pa.Array, lower: bool = False, limit: int = LIMIT) -> Iterator[Words]:
    """The words of a text column, group by group; ``lower`` maps A-Z to a-z first."""
    for first, data, offsets in text_groups(texts, limit):
        if lower:
            data = _LOWER[data]
        solid = ~_SPACE[data]
        size = len(data)
        inner = offsets[(offsets > 0) & (offsets < size)]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        begin[inner] = solid[inner]
        end = np.zeros(size + 1, bool)
        end[1:] = solid
        end[1:-1] &= ~solid[1:]
        end[inner] = solid[inner - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
        yield Words(first, data, offsets, starts, ends, np.searchsorted(starts, offsets), _hash_words(data, starts, ends))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` values from each place on; one value for each place that has ``k`` values left."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    total, width = None, 0
    bit, block = 1, hashes
    while True:  # binary doubling: block covers ``bit`` values, total the last ``width`` ones taken so far
        if k & bit:
            if total is None:
                total, width = block, bit
            else:
                n = len(hashes) - width - bit + 1
                total = block[:n] * _power(width) + total[bit : bit + n]
                width += bit
        if width == k:
            return mix(total)
        n = len(hashes) - 2 * bit + 1
        block = block[: max(n, 0)] * _power(bit) + block[bit : bit + max(n, 0)]
        bit *= 2


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), n, 1 << 64))


def inside(bounds: np.ndarray, k: int, total: int) -> np.ndarray:
    """True for each of the ``total`` window places whose ``k`` words lie in one row."""
    row_end = np.repeat(bounds[1:], np.diff(bounds))[:total]
    return np.arange(total) + k <= row_end


def spelled(words: Words, index: np.ndarray) -> pa.Array:
    """The words at ``index`` as an Arrow text column."""
    starts, ends = words.starts[index], words.ends[index]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    data = words.data[at]
    return pa.Array.from_buffers(
        pa.string(), len(index), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    )
