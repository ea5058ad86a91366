"""Sets of word shingles as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from genoframe.llm.textscan import mixed, pieces, row_words


def _factors(words: int) -> np.ndarray:
    """One odd 64-bit factor for each place in a shingle."""
    return mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row, in row order.

    A row with fewer words than a shingle has its whole sequence as one shingle; a
    row without words, or null, has none. Hashes of 64 bits stand for the shingles:
    two different ones in a pair of texts collide about once in 10**13 pairs of
    thousand-word texts.
    """
    factors = _factors(words)
    for first, last, found in pieces(column):
        hashes, rows = row_words(first, last, found)
        grams = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
        for k, factor in enumerate(factors):
            grams += hashes[k : k + len(grams)] * factor
        grams = mixed(grams)
        for start, end in zip(rows[:-1], rows[1:]):
            n = end - start
            if n >= words:
                yield np.unique(grams[start : end - words + 1])
            elif n:
                whole = (hashes[start:end] * factors[:n]).sum(dtype=np.uint64)
                # Its length keeps it apart from full shingles.
                yield mixed(np.array([whole + np.uint64(n)], dtype=np.uint64))
            else:
                yield grams[:0]
