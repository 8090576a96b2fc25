"""Hashed word and character n-gram features, computed for many words at once in numpy."""

from __future__ import annotations

import numpy as np

_STEP = np.uint32(0x01000193)  # multiplier of the polynomial hash (a known 32-bit prime)


def _mixed(h: np.ndarray, salt: int, mask: int) -> np.ndarray:
    h = (h + np.uint32(salt)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(13)
    return (h & np.uint32(mask)).astype(np.int64)


def word_features(words: list[str], sizes: tuple[int, ...], bits: int,
                  whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, index of the word of each) for the character n-grams of ``<word>`` of the
    given sizes and, with ``whole``, one feature for each whole word. Ids are below 2**bits.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = (1 << bits) - 1
    chars = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    ids, owners = [], []
    power = h = None
    with np.errstate(over="ignore"):
        for n in range(1, max(sizes, default=0) + 1):
            m = len(chars) - n + 1
            if m <= 0:
                break
            h = chars[:m].copy() if n == 1 else h[:m] * _STEP + chars[n - 1:]
            if n in sizes:
                inside = owner[:m] == owner[n - 1:]
                ids.append(_mixed(h[inside], n, mask))
                owners.append(owner[:m][inside])
        if whole:
            place = np.arange(len(chars)) - starts[owner]
            power = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint32), dtype=np.uint32)
            summed = np.add.reduceat(chars * power[place], starts, dtype=np.uint32)
            ids.append(_mixed(summed, 97, mask))
            owners.append(np.arange(len(words)))
    return np.concatenate(ids), np.concatenate(owners)


class WordTable:
    """Sums of per-feature weights by word, kept for the words a Python worker has met.

    ``weights``: (2**bits, k). ``lookup`` returns for a list of words their rows of sums, the
    last column being the number of features. The table is emptied when it holds ``limit``
    words, so its memory is bounded.
    """

    def __init__(self, weights: np.ndarray, sizes: tuple[int, ...], bits: int, whole: bool,
                 limit: int = 300_000):
        self.weights, self.sizes, self.bits, self.whole, self.limit = weights, sizes, bits, whole, limit
        self._clear(0)

    def _clear(self, room: int) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((max(room, 4096), self.weights.shape[1] + 1), np.float32)

    def places(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words in ``self.rows`` (valid until the next call)."""
        new = list(set(words).difference(self.index))
        if len(self.index) + len(new) > self.limit and new:
            new = list(set(words))
            self._clear(len(new))
        for at in range(0, len(new), 50_000):
            self._add(new[at:at + 50_000])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _add(self, new: list[str]) -> None:
        n = len(self.index)
        if n + len(new) > len(self.rows):
            more = np.zeros((max(2 * len(self.rows), n + len(new)), self.rows.shape[1]), np.float32)
            more[:n] = self.rows[:n]
            self.rows = more
        ids, owner = word_features(new, self.sizes, self.bits, self.whole)
        for k in range(self.weights.shape[1]):
            self.rows[n:n + len(new), k] = np.bincount(owner, self.weights[ids, k], len(new))
        self.rows[n:n + len(new), -1] = np.bincount(owner, minlength=len(new))
        self.index.update(zip(new, range(n, n + len(new))))


def document_bag(words: list[str], sizes: tuple[int, ...], bits: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, counts) of one document's words, for training."""
    vocabulary, counts = np.unique(np.asarray(words, object), return_counts=True) if words else ([], [])
    ids, owner = word_features(list(vocabulary), sizes, bits, whole)
    found, inverse = np.unique(ids, return_inverse=True)
    total = np.bincount(inverse, np.asarray(counts, float)[owner], len(found)) if len(ids) else np.zeros(0)
    return found, total
