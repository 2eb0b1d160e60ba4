"""Word shingle sets of whole texts as sorted 64-bit hashes, computed on blocks of texts in numpy."""

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int, base: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up = _powers(n, int(_BASE))
            self.down = _powers(n, pow(int(_BASE), -1, 1 << 64))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocks(texts: pa.Array, size: int):
    """(first row, byte offsets, bytes) of runs of texts of about ``size`` bytes."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + size, "right")) - 1)
        last = min(last, len(texts))
        yield row, ends[row:last + 1] - ends[row], data[ends[row]:ends[last]]
        row = last


def word_hashes(offsets: np.ndarray, raw: np.ndarray):
    """(hash of each word, number of words of each text); words are runs without ASCII
    white space, A-Z lower-cased, and end with their text."""
    space = _SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(raw), bool)
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.ones(len(raw), bool)
    after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    up, down = _POWERS.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(texts: pa.Array, width: int = 5, size: int = 1 << 20):
    """Yield (row, sorted distinct hashes of its shingles) for every text in order.

    A text with fewer than ``width`` words has one shingle, the whole sequence; one
    without words, or null, has none.
    """
    for first, offsets, raw in _blocks(texts, size):
        words, counts = word_hashes(offsets, raw)
        at = np.concatenate([[0], np.cumsum(counts)])
        n = max(0, len(words) - width + 1)
        grams = np.zeros(n, np.uint64)
        for k in range(width):
            grams = grams * _BASE + words[k:k + n]
        grams = mix(grams)
        for i, count in enumerate(counts):
            if count >= width:
                own = np.sort(grams[at[i]:at[i + 1] - width + 1])
                keep = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                yield first + i, own[keep]
            elif count:
                h = np.uint64(count)
                with np.errstate(over="ignore"):
                    for w in words[at[i]:at[i + 1]]:
                        h = h * _BASE + w
                yield first + i, mix(np.array([h], np.uint64))
            else:
                yield first + i, np.empty(0, np.uint64)
