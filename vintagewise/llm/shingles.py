"""Sets of word shingles as sorted 64-bit hashes, many texts at a time."""

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

WIDTH = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """Per text, the hash of each word in order, A-Z in lower case. Each distinct word is hashed once."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    places = [np.fromiter(map(number.__getitem__, text.lower().split()), np.int64) for text in texts]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    number.default_factory = None  # it holds the dictionary itself, which would wait for the garbage collector
    return (hashes[place] for place in places)


def shingle_sets(texts: Sequence[bytes], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text, the ascending distinct hashes of its shingles; a shorter text is one shingle, one without words none."""
    for h in word_hashes(texts):
        n = h.size
        if n == 0:
            yield h
            continue
        span = min(width, n)
        total = np.full(n - span + 1, span, np.uint64)
        for k in range(span):
            total = total * _STEP + h[k:n - span + 1 + k]
        yield np.unique(mix64(total))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two such sets."""
    if a.size > b.size:
        a, b = b, a
    if not a.size:
        return 0
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), b.size - 1)] == a))
