"""Word n-grams of texts as sorted sets of 64-bit hashes.

Words are runs of anything but ASCII white space, with A-Z in lower case. A text of fewer words than an n-gram has one
n-gram of all its words; a null text or one without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(29)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the place of the first word of each text."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = words.filter(there).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = coded.indices.to_numpy()
    starts = ends[np.concatenate([[0], np.cumsum(lengths)])]
    return hashes[codes] if len(codes) else np.empty(0, np.uint64), starts


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value = (value ^ words[i : i + count]) * MULTIPLIER
        value ^= value >> SHIFT
    return value


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted set of each text."""
    words, starts = _words(texts)
    runs = _folded(words, SIZE)
    sets = []
    for start, end in zip(starts[:-1], starts[1:], strict=True):
        if end - start >= SIZE:
            sets.append(np.unique(runs[start : end - SIZE + 1]))
        else:
            sets.append(_folded(words[start:end], end - start) if end > start else np.empty(0, np.uint64))
    return sets
