"""Token counts by rank-synchronous merging of byte-pair symbols.

The distinct pre-tokens of a batch lie behind each other in one ragged array of
symbols. Each step looks the rank of every neighbouring pair up, finds the lowest
rank of each pre-token, and merges that pair in all pre-tokens at once. A pair's
merge result never ranks before the pair itself, so this gives what merging one
pair at a time gives. The symbols that are left are counted.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import small_batches

LIMIT = 2048
# Chunks whose count a worker remembers, and their greatest length.
MEMO_CHUNKS = 400_000
MEMO_CHARS = 48

# Unicode white space, and the split pattern of this vocabulary.
WHITE = regex.compile(
    "[\t-\r \x85\xa0  -     　]+"
)
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
)
# Separators of str.split that are no white space in Unicode.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def vocabulary() -> str:
    """The tokenizer file that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PairMerger:
    """Byte-pair merges of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocabulary[s + suffix] for s in symbols], dtype=np.int64)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        keys = np.array([self._key(vocabulary[a], vocabulary[b]) for a, b in pairs])
        results = np.array([vocabulary[a + b] for a, b in pairs])
        # Of a pair listed twice the first rank holds.
        order = np.argsort(keys, kind="stable")
        first = np.concatenate([[True], np.diff(keys[order]) != 0])
        self.ranks = order[first]
        self.keys, self.results = keys[self.ranks], results

    @staticmethod
    def _key(left, right):
        return left * (1 << 20) + right

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each word; words are not empty."""
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        left = lengths.copy()
        no_rank = len(self.results)
        while len(symbols) > 1:
            keys = self._key(symbols[:-1], symbols[1:])
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            together = (self.keys[place] == keys) & (owner[:-1] == owner[1:])
            rank = np.where(together, self.ranks[place], no_rank)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(np.append(rank, no_rank), starts)
            sizes = np.diff(np.append(starts, len(owner)))
            wanted = np.repeat(lowest, sizes)[:-1]
            merge = np.flatnonzero((rank == wanted) & (rank < no_rank))
            if not len(merge):
                break
            # In a row of equal symbols every other pair merges, from the left.
            fresh = np.concatenate([[True], np.diff(merge) != 1])
            run_start = merge[np.maximum.accumulate(np.where(fresh, np.arange(len(merge)), 0))]
            merge = merge[(merge - run_start) % 2 == 0]
            symbols[merge] = self.results[rank[merge]]
            stays = np.ones(len(symbols), dtype=bool)
            stays[merge + 1] = False
            np.subtract.at(left, owner[merge], 1)
            # Words without a pair are done.
            stays &= np.repeat(lowest < no_rank, sizes)
            symbols, owner = symbols[stays], owner[stays]
        return left


def chunks_of(text: str) -> list[str]:
    """Runs of other than Unicode white space."""
    if SEPARATORS.search(text):
        return [chunk for chunk in WHITE.split(text) if chunk]
    return text.split()


class ChunkCounter:
    """Tokens of white-space separated chunks.

    White space ends pre-tokens and special strings hold none, so the count of a
    text is the sum over its chunks.
    """

    def __init__(self, path: str):
        self.merger = PairMerger(path)
        self.special = regex.compile("|".join(map(regex.escape, self.merger.special)) or r"(?!)")
        self.memo: dict[str, int] = {}

    def pre_tokens(self, chunk: str) -> list[str]:
        text = unicodedata.normalize("NFC", chunk)
        # Letter by letter, as a final sigma has no rule of its own here.
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return PRE_TOKEN.findall(text)

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        words: dict[str, int] = {}
        parts, owners, totals = [], [], [0] * len(chunks)
        for i, chunk in enumerate(chunks):
            totals[i] = len(self.special.findall(chunk)) if "<|" in chunk else 0
            for plain in self.special.split(chunk) if totals[i] else (chunk,):
                for word in self.pre_tokens(plain):
                    parts.append(words.setdefault(word, len(words)))
                    owners.append(i)
        if words:
            counts = self.merger.counts([word.encode() for word in words])
            sums = np.bincount(owners, counts[parts], minlength=len(chunks)).astype(int)
            totals = [a + b for a, b in zip(totals, sums.tolist())]
        return dict(zip(chunks, totals))

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null counts as empty."""
        if len(self.memo) > MEMO_CHUNKS:
            self.memo = {}
        split = [chunks_of(text) if text else [] for text in texts]
        missing = set().union(*split) - self.memo.keys()
        learnt = self._learn(list(missing)) if missing else {}
        self.memo.update(learnt)
        counts = [sum(map(self.memo.__getitem__, chunks)) for chunks in split]
        for chunk in learnt:
            if len(chunk) > MEMO_CHARS:
                del self.memo[chunk]
        return counts


def groups(texts: list[str | None], chars: int = 1 << 20) -> Iterator[list[str | None]]:
    """Consecutive texts of about a megabyte in all, or a longer one by itself."""
    group, held = [], 0
    for text in texts:
        size = len(text or "")
        if group and held + size > chars:
            yield group
            group, held = [], 0
        group.append(text)
        held += size
    if group:
        yield group


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is a vocabulary file that every executor has. Counts are those of the
    file's library without added special tokens; special strings inside a text
    count as one token. Null counts as empty: 0 tokens. Documents are independent
    of each other; no documents give no rows, other columns are not read.
    """

    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ChunkCounter(path)
        for batch in batches:
            found: list[int] = []
            for group in groups(batch["text"].to_pylist()):
                found += counter.count(group)
            tokens = np.array(found, dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": batch["n_bytes"],
                    "n_tokens": pa.array(tokens),
                    "over_limit": pa.array(tokens > limit),
                }
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select("doc_id", "text", size).mapInArrow(count, schema)
