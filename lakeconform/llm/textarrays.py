"""Words and shingles of a whole Arrow batch as NumPy arrays, without a loop over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
# Bytes hashed at once; a longer word stands alone.
CHUNK = 250_000

WHITE = np.ones(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = False
# Letters, digits and all bytes of characters beyond ASCII.
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        held = _powers[int(base)] = np.cumprod(steps)
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over the whole word; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Hash of each word; those of row ``r`` stand at ``rows[r]:rows[r + 1]``."""

    hashes: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def words_of(texts: pa.Array, is_word: np.ndarray = WHITE, lower: bool = True) -> Words:
    """Runs of bytes that are word bytes; ASCII letters count as lower case. Null: no words."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        raw = LOWER[raw]
    inside = is_word[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    hashes = np.empty(len(starts), np.uint64)
    # In stretches, so that a text of any length needs only a few arrays of bounded size.
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        low, high = starts[i], ends[j - 1]
        part = raw[low:high].astype(np.uint64) + np.uint64(1)
        part *= powers(BASE, len(part))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
        s, e = starts[i:j] - low, ends[i:j] - low
        hashes[i:j] = mixed((total[e] - total[s]) * powers(INVERSE, len(part))[s])
        i = j
    return Words(hashes, np.searchsorted(starts, at))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, rows not regarded."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * BASE + hashes[k : k + n]
    return mixed(total + np.uint64(width))


def shingles_of(words: Words, width: int) -> Words:
    """Runs of ``width`` words inside a row; a row with fewer words is one shingle of all."""
    sizes = words.counts
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    rows = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(rows[-1]), np.uint64)
    single = np.zeros(len(out), bool)
    for short in range(1, width):
        which = np.flatnonzero(sizes == short)
        if len(which):
            first = words.rows[which]
            total = np.zeros(len(which), np.uint64)
            for k in range(short):
                total = total * BASE + words.hashes[first + k]
            out[rows[which]] = mixed(total + np.uint64(short))
            single[rows[which]] = True
    whole = window_hashes(words.hashes, width)
    # A window is inside its row if the row does not end before the window does.
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(whole)]
    fits = np.arange(len(whole)) + width <= words.rows[owner + 1]
    out[~single] = whole[fits]
    return Words(out, rows)
