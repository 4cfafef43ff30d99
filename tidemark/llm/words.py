"""Words of whole batches of texts as arrays: where they begin and end, and a hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm import worker

BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}
worker.cache("powers", _POWERS.clear)


def mixed(h: np.ndarray) -> np.ndarray:
    """Each 64-bit value with its bits well mixed (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse, kept for the next batch."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(max(n, 1 << 16) * 5 // 4, base)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(units: np.ndarray) -> np.ndarray:
    """Running polynomial sums, so any slice's hash is a difference; see ``slice_hash``."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units))[0], out=out[1:])
    return out


def slice_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each slice [start, end), the same wherever the same units stand."""
    return mixed((running[ends] - running[starts]) * powers(len(running))[1][starts])


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    """Of each text, the number of its first word; one more at the end."""

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(column: pa.Array, lower: bool = False, break_at: np.ndarray = SEPARATOR) -> Words:
    """The words of each text of a column; a word never spans two texts."""
    data, offsets = raw(column)
    gap = break_at[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    running = prefix_hash((LOWER if lower else BYTE)[data])
    return Words(data, starts, ends, slice_hash(running, starts, ends), np.searchsorted(starts, offsets))
