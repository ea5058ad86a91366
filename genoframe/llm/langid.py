"""Language identification as inference in a mixture of languages.

Letter trigrams give each word a likelihood under each language. A text is a
mixture: expectation-maximisation finds the proportions of languages that make its
words most likely, for growing sets of languages, and the set with the best
likelihood less a penalty for each language is its language set. Sets grow up to
all languages, for each text until no larger set can be better.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import small_batches
from genoframe.llm.tokens import groups
from genoframe.llm.toxicity import fold

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
# Trigrams are hashed into so many buckets per language: half a megabyte each.
BUCKET_BITS = 16
SMOOTHING = 0.5
# Steps of each fit.
STEPS = 8

_letters: dict[str, np.ndarray] = {}


def _folded(text: str) -> np.ndarray:
    """Code points of the text in lower case, everything but letters as 0."""
    if not _letters:
        table = np.zeros(0x110000, dtype=np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                lower = letter.lower()
                table[code] = ord(lower) if len(lower) == 1 else code
        _letters["table"] = table
    return _letters["table"][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


class Words:
    """Words of some texts with the trigram buckets of their letters."""

    def __init__(self, texts: list[str | None]):
        joined = " ".join(text or "" for text in texts)
        codes = _folded(joined + " ")
        padded = np.concatenate([[0], codes]).astype(np.uint64)
        letters = np.flatnonzero(codes)
        left, here, right = (padded[letters + k] for k in (0, 1, 2))
        z = left * np.uint64(0x9E3779B97F4A7C15) + here * np.uint64(0xC2B2AE3D27D4EB4F)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z + right) * np.uint64(0x94D049BB133111EB)
        self.buckets = ((z ^ (z >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(
            64 - BUCKET_BITS
        )
        self.buckets = self.buckets.astype(np.int64)
        # Letters at which a word starts, as places in the letters.
        self.starts = np.flatnonzero(np.diff(letters, prepend=-2) > 1)
        ends = np.cumsum([len(text or "") + 1 for text in texts])
        self.letter_ends = np.searchsorted(letters, ends)
        # Words of each text.
        self.word_ends = np.searchsorted(self.starts, self.letter_ends)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a task by language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
        at = 0
        for group in groups(texts):
            words = Words(group)
            names = langs[at : at + len(group)]
            at += len(group)
            index = {name: i for i, name in enumerate(sorted(set(names)))}
            code = np.array([index[name] for name in names])
            sizes = np.diff(words.letter_ends, prepend=0)
            keys = (np.repeat(code, sizes) << BUCKET_BITS) + words.buckets
            found = np.bincount(keys, minlength=len(index) << BUCKET_BITS)
            for name, i in index.items():
                part = found[i << BUCKET_BITS : (i + 1) << BUCKET_BITS]
                counts[name] = counts.get(name, 0) + part
    for name, found in counts.items():
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.repeat(pa.scalar(name, pa.string()), len(used)),
                "bucket": pa.array(used.astype(np.int32)),
                "n": pa.array(found[used].astype(np.int64)),
            }
        )


def _pack(table: pa.Table) -> pa.Table:
    """The sums of one language, a row for each of its buckets at most, as one array."""
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    total[table["bucket"].to_numpy()] = table["n"].to_numpy()
    packed = pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())
    return pa.table({"lang": table["lang"][:1], "counts": packed})


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities of trigrams, one column each.

    All texts outside the held-out fold count. Spark adds the counts of tasks up by
    language and bucket, so no group grows with the number of tasks. The driver gets one row per
    language. Codes of languages are few by nature; a thousand would be 512 MB.
    """
    known = docs.where((fold(folds=FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    parts = known.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n bigint")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = sums.groupBy("lang").applyInArrow(_pack, "lang string, counts binary").collect()
    rows = sorted(rows, key=lambda row: row["lang"])
    counts = np.array(
        [np.frombuffer(zlib.decompress(bytes(row["counts"])), dtype=np.int64) for row in rows]
    ).reshape(len(rows), 1 << BUCKET_BITS)
    smooth = counts + SMOOTHING
    logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    return [row["lang"] for row in rows], np.ascontiguousarray(logs.T)


def proportions(
    likelihood: np.ndarray, owner: np.ndarray, allowed: np.ndarray, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each text, and log likelihoods.

    ``likelihood`` has words as rows, languages as columns, scaled to a maximum of
    1 in each row; ``owner`` is the text of each word; ``allowed`` is boolean, text
    by language.
    """
    texts = len(allowed)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    starts = np.searchsorted(owner, np.arange(texts))
    filled = np.flatnonzero(np.diff(np.append(starts, len(owner))))
    sizes = np.diff(np.append(starts, len(owner)))[filled, None]
    log_sum = np.zeros(texts)
    for step in range(steps + 1):
        joint = likelihood * share.astype(np.float32)[owner]
        total = np.maximum(joint.sum(axis=1), np.float32(1e-30))
        if step == steps:
            log_sum[filled] = np.add.reduceat(np.log(total, dtype=np.float64), starts[filled])
            break
        joint /= total[:, None]
        share[filled] = np.add.reduceat(joint, starts[filled], axis=0) / sizes
    return share, log_sum


def _ceiling(
    likelihood: np.ndarray, owner: np.ndarray, share: np.ndarray, log_sum: np.ndarray
) -> np.ndarray:
    """What no log likelihood of a text can exceed, whatever its proportions.

    The log likelihood is concave: its tangent at ``share`` lies above it.
    """
    counts = np.bincount(owner, minlength=len(share))
    filled = np.flatnonzero(counts)
    total = np.maximum((likelihood * share.astype(np.float32)[owner]).sum(axis=1), np.float32(1e-30))
    starts = np.searchsorted(owner, filled)
    slope = np.add.reduceat(likelihood / total[:, None], starts, axis=0, dtype=np.float64)
    ceiling = log_sum.copy()
    # A little more, for sums in single precision.
    ceiling[filled] += slope.max(axis=1) - counts[filled] * (1 - 1e-4)
    # The best language of each word has likelihood 1.
    return np.minimum(ceiling, 0)


def identify(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's main language, -1 for none, and its proportion."""
    words = Words(texts)
    counts = np.diff(words.word_ends, prepend=0)
    best = np.full(len(texts), -1)
    score = np.zeros(len(texts))
    if not len(words.starts) or not logs.shape[1]:
        return best, score
    by_word = np.add.reduceat(logs[words.buckets], words.starts, axis=0)
    likelihood = np.exp(by_word - by_word.max(axis=1, keepdims=True))
    owner = np.repeat(np.arange(len(texts)), counts)
    everything = np.ones((len(texts), logs.shape[1]), dtype=bool)
    share, log_all = proportions(likelihood, owner, everything)
    ceiling = _ceiling(likelihood, owner, share, log_all)
    # Sets are the first languages by proportion; ties go by name.
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    penalty = 0.5 * np.log(np.maximum(counts, 2))
    highest = np.full(len(texts), -np.inf)
    result = share.copy()
    for size in range(1, logs.shape[1] + 1):
        # Texts for which a set of this size or a larger one can still be the best.
        going = np.flatnonzero((counts > 0) & (ceiling - size * penalty > highest))
        if not len(going):
            break
        if size == logs.shape[1]:
            fitted, log_sum = share[going], log_all[going]
        else:
            chosen = np.zeros(len(texts), dtype=bool)
            chosen[going] = True
            rows = chosen[owner]
            fitted, log_sum = proportions(
                likelihood[rows], (np.cumsum(chosen) - 1)[owner[rows]], rank[going] < size
            )
        penalised = log_sum - size * penalty[going]
        better = penalised > highest[going]
        highest[going[better]] = penalised[better]
        result[going[better]] = fitted[better]
    some = counts > 0
    best[some] = result.argmax(axis=1)[some]
    score[some] = np.clip(result.max(axis=1)[some], 0, 1)
    return best, score


def predict_language(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learnt from the text and language of documents outside the held-out fold;
    predictions read the text alone. Null texts and texts without a letter are
    ``und`` with score 0, and so is every text where nothing could be learnt. The
    score is the proportion of the main language. Equal texts have equal results.
    No documents give no rows.
    """
    small_batches(docs.sparkSession)
    languages, logs = train(docs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*languages, UNKNOWN], pa.string())
        for batch in batches:
            found = [identify(group, logs) for group in groups(batch["text"].to_pylist())]
            best = np.concatenate([f[0] for f in found] or [np.zeros(0, dtype=np.int64)])
            score = np.concatenate([f[1] for f in found] or [np.zeros(0)])
            best[best < 0] = len(languages)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": names.take(pa.array(best)),
                    "score": pa.array(score),
                }
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, held_out boolean, lang_pred string, score double"
    held_out = (fold(folds=FOLDS) == HELD_OUT).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(predict, schema)
