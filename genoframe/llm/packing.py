"""Packing documents into fixed-length sequences by multiway differencing.

A document's ids are cut into whole sequences and a rest of short pieces. Pieces
are dealt out by hash into groups of a bounded number of tokens, and each group is
split into near-equal windows: every piece starts as a partition of its own, and
the two partitions with the greatest difference between largest and smallest
window are merged again and again, large windows of one onto small ones of the
other. If a window is over capacity, the group gets one window more.
"""

from __future__ import annotations

import heapq
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import returning_memory, small_batches
from genoframe.llm.textscan import Piece, pieces
from genoframe.llm.tokens import byte_symbols
from genoframe.plans.shared import shared_folder

CAPACITY = 4096
# Longest piece of what is left of a document beside whole sequences.
PIECE = 512
END_ID = 2
TOKENS_PER_GROUP = 1 << 21
# What a worker remembers: words and ids of all of them, some 60 MB at most.
MEMO_WORDS = 1 << 20
MEMO_IDS = 1 << 22
MARKS = np.zeros(256, dtype=bool)
MARKS[[ord("."), ord(",")]] = True
ASCII_LETTERS = np.zeros(256, dtype=bool)
ASCII_LETTERS[[*range(65, 91), *range(97, 123)]] = True
# Letters of two UTF-8 bytes that are no sign, and the distance of small ones.
LATIN_LEAD = 0xC3
LATIN_LETTERS = np.zeros(256, dtype=bool)
LATIN_LETTERS[[i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)]] = True
LATIN_CAPITALS = np.zeros(256, dtype=bool)
LATIN_CAPITALS[0x80:0x9F] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
# Sequence ids of a group; no group can have as many windows.
GROUP_STRIDE = 1 << 24

PIECES = (
    "piece_id bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
    "doc_tokens bigint"
)
PACKED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class HashPlaces:
    """Places of 64-bit hashes in open addressing, for whole arrays at once."""

    def __init__(self, bits: int = 16):
        self.count, self.mask = 0, (1 << bits) - 1
        self.hashes = np.zeros(1 << bits, dtype=np.uint64)
        self.places = np.full(1 << bits, -1, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for one that is not there."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            places = self.places[at]
            there = self.hashes[at] == hashes[left]
            found[left[there]] = places[there]
            on = ~there & (places >= 0)
            left, at = left[on], (at[on] + 1) & self.mask
        return found

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Add distinct hashes that are not there."""
        while 2 * (self.count + len(hashes)) > self.mask:
            held = self.places >= 0
            old, held_places = self.hashes[held], self.places[held]
            self.__init__((self.mask + 1).bit_length())
            self.add(old, held_places)
        self.count += len(hashes)
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(hashes):
            free = np.flatnonzero(self.places[at] < 0)
            self.places[at[free]] = places[free]
            # Of several on one free place the last has it.
            free = free[self.places[at[free]] == places[free]]
            self.hashes[at[free]] = hashes[free]
            on = np.ones(len(hashes), dtype=bool)
            on[free] = False
            hashes, places, at = hashes[on], places[on], (at[on] + 1) & self.mask


class WordEncoder:
    """Ids of whole text columns by the library, one call for all new words.

    ASCII white space ends pre-tokens, so the ids of a text are those of the words
    between; a full stop or comma behind a letter is a pre-token of its own. Words
    are told apart by 64-bit hashes, A-Z as a-z like the vocabulary does, and the
    library sees each word once while a worker remembers it. Texts with the start
    of a special string go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Small Latin letters, spelled byte by byte, need no rules before the merges.
        self.spelled = Tokenizer.from_file(path)
        self.spelled.normalizer = normalizers.Sequence([])
        self.spelled.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.spelling = np.array([ord(symbol) for symbol in byte_symbols()], dtype="<u4")
        self.spelling[32] = 32
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots = HashPlaces()
        self.ids = np.zeros(1 << 16, dtype="<u4")
        # Where each word's ids begin, and the last ones end.
        self.bounds = np.zeros(1 << 14, dtype=np.int64)
        self.words = 0

    def _remember(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Append words, given where their ids end; returns their places."""
        first, at = self.words, int(self.bounds[self.words])
        for name, needed in (("ids", at + len(ids)), ("bounds", first + len(ends) + 1)):
            held = getattr(self, name)
            if needed > len(held):
                more = np.zeros(max(needed, 2 * len(held)) - len(held), dtype=held.dtype)
                setattr(self, name, np.concatenate([held, more]))
        self.ids[at : at + len(ids)] = ids
        self.words += len(ends)
        self.bounds[first + 1 : self.words + 1] = at + ends
        return np.arange(first, self.words)

    def _ended(self, tokenizer, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text of words that are one pre-token each, and where each word's
        end: each has one id that ends a word, its last."""
        joined = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(joined[0].ids, dtype="<u4")
        return ids, np.flatnonzero(self.ends_word[ids]) + 1

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = self._ended(self.tokenizer, " ".join(words))
        return (ids, ends) if len(ends) == len(words) else self._others(words)

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._one_by_one(words)
        ends = np.cumsum([len(ids) for ids in found], dtype=np.int64)
        return np.concatenate([np.zeros(0, dtype="<u4"), *found]), ends

    def _one_by_one(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, dtype="<u4") for encoding in found]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Remember the words at these places of the bytes; returns their places."""
        lengths = ends - starts
        # The words behind each other, a space behind each.
        bounds = np.cumsum(lengths + 1)
        within = np.arange(bounds[-1]) - np.repeat(bounds - lengths - 1, lengths + 1)
        joined = data[np.minimum(np.repeat(starts, lengths + 1) + within, len(data) - 1)]
        joined[bounds - 1] = 32
        behind_lead = np.zeros(len(joined), dtype=bool)
        behind_lead[1:] = joined[:-1] == LATIN_LEAD
        latin = np.where(behind_lead, LATIN_LETTERS[joined], ASCII_LETTERS[joined] | (joined == LATIN_LEAD))
        latin[bounds - 1] = ~behind_lead[bounds - 1]
        spelled = np.logical_and.reduceat(latin, bounds - lengths - 1)
        places = np.empty(len(starts), dtype=np.int64)
        if spelled.any():
            small = SMALL[joined] + np.uint8(32) * (behind_lead & LATIN_CAPITALS[joined])
            text = self.spelling[small[np.repeat(spelled, lengths + 1)]].tobytes().decode("utf-32-le")
            ids, id_ends = self._ended(self.spelled, text)
            if len(id_ends) == spelled.sum():
                places[spelled] = self._remember(ids, id_ends)
            else:
                spelled[:] = False
        rest = np.flatnonzero(~spelled)
        if len(rest):
            whole = data.tobytes()
            words = [whole[a:b].decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
            plain = np.array([w.isalpha() and unicodedata.is_normalized("NFC", w) for w in words])
            for wanted, encode in ((True, self._letters), (False, self._others)):
                some = np.flatnonzero(plain == wanted)
                if len(some):
                    places[rest[some]] = self._remember(*encode([words[i] for i in some]))
        return places

    def _word_slots(self, piece: Piece, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each word among the remembered ones; new words are learnt."""
        hashes = piece.hashes(starts, ends)
        if self.bounds[self.words] > MEMO_IDS:
            self._forget()
        slots = self.slots.find(hashes)
        new = np.flatnonzero(slots < 0)
        if self.words + len(new) > MEMO_WORDS and self.words:
            self._forget()
            slots[:], new = -1, np.arange(len(slots))
        if len(new):
            distinct, first, inverse = np.unique(hashes[new], return_index=True, return_inverse=True)
            places = self._learn(piece.data, starts[new[first]], ends[new[first]])
            self.slots.add(distinct, places)
            slots[new] = places[inverse]
        return slots

    def _piece_ids(self, piece: Piece, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a piece and the offsets of its rows in them."""
        starts, ends = piece.starts, piece.ends
        marked = (ends - starts > 1) & MARKS[piece.data[ends - 1]] & ASCII_LETTERS[piece.data[ends - 2]]
        marks = ends[marked] - 1
        all_starts = np.concatenate([starts, marks])
        all_ends = np.concatenate([ends - marked, marks + 1])
        order = np.argsort(all_starts, kind="stable")
        all_starts, all_ends = all_starts[order], all_ends[order]
        slots = self._word_slots(piece, all_starts, all_ends)
        lengths = self.bounds[slots + 1] - self.bounds[slots]
        word_bounds = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(word_bounds[-1]) + np.repeat(self.bounds[slots] - word_bounds[:-1], lengths)
        return self.ids[places], word_bounds[np.searchsorted(all_starts, rows)]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each row; null counts as empty."""
        special = pc.match_substring(column, "<|").fill_null(False).to_numpy(zero_copy_only=False)
        for first, last, found in pieces(column):
            parts = [self._piece_ids(piece, piece.rows) for piece in found]
            if len(parts) > 1:
                parts = [(np.concatenate([ids for ids, _ in parts]), np.array([0, sum(len(ids) for ids, _ in parts)]))]
            ids, bounds = parts[0]
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if special[first + i]:
                    yield self._one_by_one([column[first + i].as_py()])[0]
                else:
                    yield ids[a:b]


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this worker, which outlives tasks with the words it remembers."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[int]:
    """Places at which n ids are cut: whole sequences first, then short pieces."""
    whole = n // capacity * capacity
    return [*range(0, whole, capacity), *range(whole, n, piece), n]


def difference(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item by multiway differencing.

    A partition is kept as the sums of its non-empty windows, ascending, and one
    item of each; items of a window are linked to each other.
    """
    parent = np.arange(len(lengths))
    order = np.argsort(-lengths, kind="stable")
    heap = [
        (-int(lengths[i]), rank, np.array([lengths[i]]), np.array([i]))
        for rank, i in enumerate(order)
    ]
    rank = len(heap)
    if windows == 1:
        return np.zeros(len(lengths), dtype=np.int64)
    while len(heap) > 1:
        _, _, sums, items = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        # Largest onto smallest: the windows past the empty ones of both overlap.
        both = max(0, len(sums) + len(other) - windows)
        joined = sums[:both] + other[:both][::-1]
        parent[others[:both][::-1]] = items[:both]
        sums = np.concatenate([joined, sums[both:], other[both:]])
        items = np.concatenate([items[:both], items[both:], others[both:]])
        by_sum = np.argsort(sums, kind="stable")
        sums, items = sums[by_sum], items[by_sum]
        least = int(sums[0]) if len(sums) == windows else 0
        heapq.heappush(heap, (least - int(sums[-1]), rank, sums, items))
        rank += 1
    # Follow the links to the item that stands for the window.
    while True:
        above = parent[parent]
        if (above == parent).all():
            break
        parent = above
    _, window = np.unique(parent, return_inverse=True)
    return window


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each piece, none over capacity; whole sequences have their own."""
    window = np.empty(len(lengths), dtype=np.int64)
    whole = lengths == capacity
    window[whole] = np.arange(whole.sum())
    rest = lengths[~whole]
    if len(rest):
        count = -(-int(rest.sum()) // capacity)
        while True:
            found = difference(rest, count)
            if np.bincount(found, rest).max() <= capacity:
                break
            count += 1
        window[~whole] = found + whole.sum()
    return window


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    # The order of arrival depends on the shuffle; the ids do not.
    group = group.sort_values(["piece_id", "start"], ignore_index=True)
    window = pack_group(group["length"].to_numpy())
    group["sequence_id"] = group["group"] * GROUP_STRIDE + window
    group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
    return group[[column.split()[0] for column in PACKED.split(", ")]]


def _cut_documents(path: str, end_id: int):
    tail = np.array([end_id], dtype="<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        names = [column.split()[0] for column in PIECES.split(", ")]
        for batch in batches:
            rows = zip(batch["piece_id"].to_pylist(), batch["doc_id"].to_pylist())
            found: list[tuple] = []
            for ids, (piece_id, doc_id) in zip(encoder.encode(batch["text"]), rows):
                data = np.append(ids, tail).tobytes()
                n = len(data) // 4
                places = cuts(n)
                found += (
                    (piece_id, doc_id, a, b - a, zlib.crc32(data[4 * a : 4 * b]), n)
                    for a, b in zip(places, places[1:])
                )
            columns = zip(*found) if found else [()] * len(names)
            yield pa.RecordBatch.from_pydict(
                {name: pa.array(values, pa.int64()) for name, values in zip(names, columns)}
            )

    return cut


def pack(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the vocabulary file ``path``, which every
    executor has, and then ``end_id``; a null or empty text has that id alone. Each
    id lies in one piece, each piece in one sequence of at most ``CAPACITY`` ids.
    Repeated rows and ids are packed row by row. No documents give no rows; other
    columns are not read. The pieces, about a row per ``PIECE`` ids, are written to
    the shared folder before they are dealt out, so sequences agree after a retry.
    """
    shared_folder(docs.sparkSession)
    small_batches(docs.sparkSession)
    numbered = docs.select(
        F.monotonically_increasing_id().alias("piece_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
    )
    pieces = numbered.mapInArrow(returning_memory(_cut_documents(path, end_id)), PIECES).checkpoint()
    tokens = pieces.agg(F.sum("length").alias("n")).first()["n"] or 0
    groups_needed = int(tokens // TOKENS_PER_GROUP) + 1
    dealt = F.pmod(F.xxhash64("piece_id", "start"), F.lit(groups_needed)).alias("group")
    return pieces.select("*", dealt).groupBy("group").applyInPandas(_pack, PACKED)
