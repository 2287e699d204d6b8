"""64-bit hashes of word shingles, for many texts at once in numpy.

Words are runs of non-blank bytes, A-Z lower-cased. A word's hash is a polynomial in its bytes,
taken from running sums; a shingle's mixes those of its words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once.
SEGMENT = 1 << 20

_rng = np.random.default_rng(20_240_501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_ANY_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least n positions."""
    if not _tables or next(iter(_tables)) < n:
        _tables.clear()
        size = max(n, SEGMENT + SEGMENT // 4)
        _tables[size] = (_powers(_BASE, size + 1), _powers(_INVERSE, size + 1))
    return next(iter(_tables.values()))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words_of(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in ``data``, and for each text (by its first byte) its first word.
    Texts are parted by a blank."""
    array = np.frombuffer(data, np.uint8)
    up, down = _power_tables(len(array) + 1)
    blank = np.empty(len(array) + 1, bool)
    blank[:-1] = _BLANK[array]
    blank[-1] = True
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.r_[0, edge]
    begin, end = edge[0::2], edge[1::2]
    sums = np.zeros(len(array) + 1, np.uint64)
    np.cumsum(_BYTE[array] * up[: len(array)], out=sums[1:])
    # The length goes in too: a word is not another one's beginning.
    hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(begin, starts)


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about a segment, cut at blanks."""
    at = 0
    while len(text) - at > SEGMENT:
        found = _ANY_BLANK.search(text, at + SEGMENT)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order; none for a null."""
    group: list[bytes] = []
    done: list[np.ndarray] = []  # of the parts of a long text
    size = 0

    def flush():
        if group:
            starts = np.cumsum([0] + [len(x) + 1 for x in group])
            hashes, first = _words_of(b" ".join(group).lower() + b" ", starts)
            for a, b in zip(first, first[1:]):
                yield hashes[a:b]

    for text in texts:
        *parts, last = _parts(text.as_buffer().to_pybytes() if text.is_valid else b"")
        if parts:
            yield from flush()
            group, size = [], 0
            for part in (*parts, last):
                group = [part]
                done.extend(flush())
            yield np.concatenate(done)
            group, done = [], []
            continue
        group.append(last)
        size += len(last)
        if size >= SEGMENT:
            yield from flush()
            group, size = [], 0
    yield from flush()


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Ascending distinct hashes of the runs of ``size`` words; of the whole sequence if it is
    shorter; none without words."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(size, n)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = mixed(h * np.uint64(0x2127599BF4325C37) + words[i : n - width + 1 + i])
    h.sort()
    return h[np.r_[True, h[1:] != h[:-1]]]
