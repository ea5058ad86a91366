"""Passages of texts as feature vectors, computed on Arrow buffers with numpy.

A passage is a run of about fifty words. Its features say how it is written, not what
about: shares of byte classes and of pairs of them, lengths of words, how many words
repeat each other, and how much of it comes elsewhere in its text. They are counts, so
equal texts have equal features wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from genoframe.llm.textscan import Piece, mixed, pieces

WORDS = 50
# Words whose run is looked for elsewhere in the text.
RUN = 4

# Byte classes, one for each of these sets, and two for other bytes.
SETS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
    b" \t\v\f", b"\n\r", b".", b",;:", b"!", b"?", b"\"'`", b"()[]{}", b"#*$%&", b"|<>", b"-_/\\",
)
CLASSES = len(SETS) + 2
CLASS = np.full(256, len(SETS), dtype=np.uint8)
CLASS[0x80:] = len(SETS) + 1
for i, letters in enumerate(SETS):
    CLASS[list(letters)] = i
# Word lengths in bytes from which the next class begins.
LENGTHS = np.array([2, 3, 5, 8, 12, 18, 27])
SHARES = 4
FEATURES = CLASSES + CLASSES * CLASSES + len(LENGTHS) + 1 + SHARES


class Passages:
    """Passages of some rows: offsets of the rows in them, words and features of each.

    A row without words has one passage of none.
    """

    def __init__(self, rows: np.ndarray, words: np.ndarray, features: np.ndarray):
        self.rows, self.words, self.features = rows, words, features


def _counts(size: int, owner: np.ndarray, kind: np.ndarray, kinds: int) -> np.ndarray:
    keys = owner.astype(np.int64) * kinds + kind
    return np.bincount(keys, minlength=size * kinds).reshape(size, kinds)


def _passages(first: int, last: int, found: list[Piece]) -> Passages:
    if len(found) == 1:
        row_words = found[0].row_words
    else:
        row_words = np.array([0, sum(len(piece.starts) for piece in found)])
    n_words = np.diff(row_words)
    # The last passage takes what is left if that is less than half of one.
    per_row = np.maximum((n_words + WORDS // 2) // WORDS, 1)
    rows = np.concatenate([[0], np.cumsum(per_row)])
    size = int(rows[-1])
    row_of = np.repeat(np.arange(last - first), n_words)
    within = np.arange(len(row_of)) - row_words[:-1][row_of]
    passage = rows[:-1][row_of] + np.minimum(within // WORDS, per_row[row_of] - 1)

    features = np.zeros((size, FEATURES))
    hashes, lengths, at = [], [], 0
    single = np.zeros((size, CLASSES), dtype=np.int64)
    pairs = np.zeros((size, CLASSES * CLASSES), dtype=np.int64)
    for piece in found:
        count = len(piece.starts)
        if not count:
            continue
        owner = passage[at : at + count]
        at += count
        hashes.append(piece.words())
        lengths.append(piece.ends - piece.starts)
        # Bytes from the start of a word up to that of the next one in the row.
        upto = np.append(piece.starts[1:], len(piece.data))
        last_words = piece.row_words[1:][np.diff(piece.row_words) > 0] - 1
        upto[last_words] = piece.ends[last_words]
        spans = upto - piece.starts
        byte_owner = np.repeat(owner, spans)
        shift = np.repeat(piece.starts - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans)
        kind = CLASS[piece.data[np.arange(len(byte_owner)) + shift]]
        single += _counts(size, byte_owner, kind, CLASSES)
        same = byte_owner[1:] == byte_owner[:-1]
        pair = kind[:-1].astype(np.int64) * CLASSES + kind[1:]
        pairs += _counts(size, byte_owner[1:][same], pair[same], CLASSES * CLASSES)
    words = np.bincount(passage, minlength=size)
    if len(passage):
        hashes, lengths = np.concatenate(hashes), np.concatenate(lengths)
        n_bytes = np.maximum(single.sum(axis=1, keepdims=True), 1)
        some = np.maximum(words, 1)[:, None]
        by_length = _counts(size, passage, np.searchsorted(LENGTHS, lengths, side="right"), len(LENGTHS) + 1)
        shares = _shares(hashes, passage, row_of, size)
        features = np.concatenate(
            [single / n_bytes, pairs / n_bytes, by_length / some, shares / some], axis=1
        )
    # Roots spread small shares out.
    return Passages(rows, words, np.sqrt(features))


def _shares(hashes: np.ndarray, passage: np.ndarray, row_of: np.ndarray, size: int) -> np.ndarray:
    """Words of each passage that equal the word before them or one before in the
    passage, and that begin a run which their text has twice, or three times."""
    out = np.zeros((size, SHARES), dtype=np.int64)
    same_row = row_of[1:] == row_of[:-1]
    stutter = np.flatnonzero(same_row & (hashes[1:] == hashes[:-1])) + 1
    out[:, 0] = np.bincount(passage[stutter], minlength=size)
    order = np.lexsort((hashes, passage))
    known = (passage[order][1:] == passage[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    out[:, 1] = np.bincount(passage[order[1:][known]], minlength=size)
    if len(hashes) >= RUN:
        run = hashes[: len(hashes) - RUN + 1].copy()
        for k in range(1, RUN):
            run = mixed(run) + hashes[k : len(hashes) - RUN + 1 + k]
        inside = np.flatnonzero(row_of[: len(run)] == row_of[RUN - 1 :])
        order = inside[np.lexsort((run[inside], row_of[inside]))]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (row_of[order[1:]] != row_of[order[:-1]]) | (run[order[1:]] != run[order[:-1]])
        starts = np.flatnonzero(new)
        times = np.repeat(np.diff(np.append(starts, len(order))), np.diff(np.append(starts, len(order))))
        for column, least in ((2, 2), (3, 3)):
            out[:, column] = np.bincount(passage[order[times >= least]], minlength=size)
    return out


def text_passages(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, Passages]]:
    """Yield (first row, row after the last, passages); every text whole, null as empty."""
    for first, last, found in pieces(column):
        yield first, last, _passages(first, last, found)
