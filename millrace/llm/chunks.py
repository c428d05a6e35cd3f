"""Byte and word hashing over chunks of many texts, with numpy.

Texts are joined into chunks of about a megabyte, so that the work arrays stay small
whatever the size of a batch; a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_TABLES = {
    lane: np.random.Generator(np.random.PCG64(7700 + lane)).integers(
        0, 1 << 64, size=256, dtype=np.uint64, endpoint=False
    )
    for lane in (0, 1)
}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def chunked(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold about `limit` bytes each."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + CHUNK_BYTES // 4)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            ones = np.full(size, base, dtype=np.uint64)
            ones[0] = 1
            _POWERS[name] = np.multiply.accumulate(ones)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run values[start:end] that doesn't depend on where the run stands."""
    up, down = _powers(len(values) + 1)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def byte_values(joined: np.ndarray, lane: int = 0) -> np.ndarray:
    """A fixed random 64-bit number for each byte."""
    return _TABLES[lane][joined]


class Words:
    """The words of one chunk: runs without white space (blank and 0x09 to 0x0D)."""

    def __init__(self, texts: Sequence[bytes]):
        self.joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths + 1)
        inside = np.zeros(len(self.joined) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[self.joined]
        turns = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = turns[::2], turns[1::2]
        #: words before each text, and after the last
        self.first = np.concatenate(([0], np.searchsorted(self.starts, ends)))
        self.text_starts = ends - lengths - 1

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        return span_hashes(byte_values(self.joined, lane), self.starts, self.ends)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Positions at which `width` items of one text begin; `first` bounds the texts."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(first[:-1] - before, counts)


def spanned(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places lie in one of the runs."""
    turns = np.bincount(np.minimum(starts, size), minlength=size + 1)
    turns -= np.bincount(np.minimum(ends, size), minlength=size + 1)
    return np.cumsum(turns[:-1]) > 0


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of `size` places lie in a run of `width` places from one of `starts`."""
    return spanned(starts, starts + width, size)


def encoded(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]
