"""Words of a text column as 64-bit hashes, computed on Arrow buffers with numpy.

Text is read in pieces of half a megabyte, so a batch of any size and a single
text of any length need the same working memory besides the hashes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
# Odd 64-bit constants that spread bits.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values after which all bits look random."""
    z = values.astype(np.uint64, copy=True)
    for shift, factor in zip((30, 27), MIX):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def byte_codes(fold: bool = True) -> np.ndarray:
    """A 64-bit code for each byte; ``fold`` gives A-Z the codes of a-z."""
    source = np.arange(256)
    if fold:
        source[65:91] += 32
    return mixed((source + 1).astype(np.uint64) * np.uint64(BASE))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        inverse = pow(BASE, -1, 1 << 64)
        for name, base in (("up", BASE), ("down", inverse)):
            factors = np.full(n, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Piece:
    """A run of bytes with the places of its words."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, space: np.ndarray, codes: np.ndarray):
        """``rows``: offsets of the rows in ``data``, first 0, last its length."""
        self.data, self.rows = data, rows
        inside = ~space[data]
        edges = rows[:-1][rows[:-1] < len(data)]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        after[edges[edges > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.row_words = np.searchsorted(self.starts, rows)
        up, self._down = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * up[: len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; equal bytes have equal hashes anywhere."""
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def words(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[rows[0] : rows[-1]], rows - rows[0]


def pieces(
    column: pa.Array | pa.ChunkedArray,
    space: np.ndarray = SPACE,
    codes: np.ndarray | None = None,
    piece_bytes: int = PIECE_BYTES,
) -> Iterator[tuple[int, int, list[Piece]]]:
    """Yield ``(first row, row after the last, pieces)``.

    Several rows share one piece; a row longer than a piece comes alone, as
    several pieces cut between words.
    """
    codes = byte_codes() if codes is None else codes
    data, rows = column_bytes(column)
    first = 0
    while first < len(rows) - 1:
        last = int(np.searchsorted(rows, rows[first] + piece_bytes, side="right")) - 1
        last = max(last, first + 1)
        chunk = data[rows[first] : rows[last]]
        if len(chunk) <= piece_bytes:
            yield first, last, [Piece(chunk, rows[first : last + 1] - rows[first], space, codes)]
        else:
            yield first, last, list(_cut(chunk, space, codes, piece_bytes))
        first = last


def _cut(
    data: np.ndarray, space: np.ndarray, codes: np.ndarray, piece_bytes: int
) -> Iterator[Piece]:
    start = 0
    while start < len(data):
        end = min(start + piece_bytes, len(data))
        # To the end of the word that the cut would split.
        while end < len(data) and not space[data[end]]:
            ahead = np.flatnonzero(space[data[end : end + piece_bytes]])
            end = end + int(ahead[0]) if len(ahead) else min(end + piece_bytes, len(data))
        yield Piece(data[start:end], np.array([0, end - start]), space, codes)
        start = end


def row_words(first: int, last: int, found: list[Piece]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a yield of ``pieces`` and the offsets of its rows in them."""
    if len(found) == 1:
        return found[0].words(), found[0].row_words
    words = np.concatenate([piece.words() for piece in found])
    return words, np.array([0, len(words)])
