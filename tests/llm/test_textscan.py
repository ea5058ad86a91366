"""Word hashes on Arrow buffers."""

import numpy as np
import pyarrow as pa
import pytest

from genoframe.llm.textscan import pieces, row_words

TEXTS = ["a b  a", None, "", " \t\n", "B\x0bÀ à b", "x" * 50 + " y", " lead trail "]


def words_by_row(column, piece_bytes=1 << 20):
    rows = []
    for first, last, found in pieces(column, piece_bytes=piece_bytes):
        hashes, bounds = row_words(first, last, found)
        rows += [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return rows


@pytest.mark.parametrize("piece_bytes", [4, 16, 1 << 20])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_equal_words_have_equal_hashes_and_others_do_not(piece_bytes, kind):
    rows = words_by_row(pa.array(TEXTS, kind), piece_bytes)
    expected = [(text or "").encode().lower().split() for text in TEXTS]
    assert [len(row) for row in rows] == [len(row) for row in expected]
    by_word = {}
    for hashes, words in zip(rows, expected):
        for value, word in zip(hashes, words):
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_slice_of_a_column():
    column = pa.array(TEXTS)
    assert words_by_row(column[4:6]) == words_by_row(column)[4:6]


def test_one_word_longer_than_a_piece():
    (row,) = words_by_row(pa.array(["q" * 1000]), piece_bytes=64)
    assert len(row) == 1
    assert row == words_by_row(pa.array(["q" * 1000]))[0]


def test_no_rows():
    assert words_by_row(pa.array([], pa.string())) == []
    assert np.array(words_by_row(pa.array([None], pa.string()))).size == 0
