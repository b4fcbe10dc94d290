"""Words and sets of word shingles of many texts, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
#: A worker forgets the hashes of words that it knows when there are so many. Longer words than KNOWN_LENGTH bytes aren't kept.
KNOWN_WORDS, KNOWN_LENGTH = 200_000, 64
_STEP, _SHORT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= KNOWN_LENGTH:
            self[word] = h
        return h


_words = _Words()


def forget() -> None:
    """Frees what this worker knows, at the end of a task."""
    _words.clear()


def words(text: str | None) -> list[bytes]:
    """ASCII capitals in lower case, cut at ASCII white space: bytes.lower() and bytes.split() do just this."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def hashes_of(ws: list[bytes]) -> np.ndarray:
    if len(_words) > KNOWN_WORDS:
        _words.clear()
    return np.fromiter(map(_words.__getitem__, ws), np.uint64, len(ws))


def word_hashes(text: str | None) -> np.ndarray:
    return hashes_of(words(text))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(columns: list[np.ndarray], seed: np.uint64 = np.uint64(1)) -> np.ndarray:
    """One hash of each row of hashes; order counts."""
    acc = np.full(columns[0].shape, seed, np.uint64)
    for c in columns:
        acc = mixed((acc * _STEP) ^ c)
    return acc


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted set of a text's shingles; of fewer words, the one sequence; of none, empty."""
    h = word_hashes(text)
    if not h.size:
        return h
    if h.size < width:
        return joined([h[i : i + 1] for i in range(h.size)], _SHORT)
    return np.unique(joined([h[i : h.size - width + 1 + i] for i in range(width)]))


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted sets share."""
    if a.size < b.size:
        a, b = b, a
    if not b.size:
        return 0
    at = a.searchsorted(b)
    at[at == a.size] = 0
    return int(np.count_nonzero(a[at] == b))
