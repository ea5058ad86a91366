"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled ones train a linear classifier in numpy. The
risk of calling a text clean is estimated from the unlabelled texts, less the
share of toxic ones among them, which the class prior gives; where that estimate
falls below zero the classifier has begun to fit noise, and the step is undone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import returning_memory, small_batches
from genoframe.llm.textscan import mixed, pieces
from genoframe.plans.shared import remove, shared_path

FOLDS = 5
# Rows that the classifier is fitted on, at most.
MAX_POSITIVE = 4000
MAX_UNLABELLED = 12_000
# Features that the classifier may use, and how sure their excess must be. They bound
# the model, not the rows; with fewer toxic texts than that there is no feature.
MAX_FEATURES = 1024
MIN_POSITIVE_TEXTS = 5
MIN_Z = 5.0
PREFIX_BYTES = (4, 5, 6)
# Features that a task sums up at once.
FEATURES_AT_ONCE = 500_000
STEPS = 400
LEARNING_RATE = 0.05
PENALTY = 1e-4

# Occurrences in a text that count as features of their own, and what tells their
# hashes from that of the first.
LEVELS = {n: mixed(np.array([n], dtype=np.uint64))[0] for n in (2, 3, 5)}

# Words are runs of letters and digits, and of bytes beyond ASCII.
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(0))


def text_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, last row, row of each feature, feature), with repeats.

    Features are the words of a text and the beginnings of longer ones, as 64-bit
    hashes; A-Z counts as a-z. ``_distinct`` adds how often they come.
    """
    for first, last, found in pieces(column, space=SEPARATOR):
        rows, values = [], []
        for piece in found:
            row = np.repeat(np.arange(last - first), np.diff(piece.row_words))
            length = piece.ends - piece.starts
            rows.append(row)
            values.append(piece.words())
            for n in PREFIX_BYTES:
                longer = length > n
                starts = piece.starts[longer]
                # Another hash than that of the same letters as a word.
                values.append(piece.hashes(starts, starts + n) ^ np.uint64(n))
                rows.append(row[longer])
        yield first, last, np.concatenate(rows), np.concatenate(values)


def _distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per row, and once more for each level of its count."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(rows)))
    found = [(rows[starts], values[starts])]
    for level, mark in LEVELS.items():
        often = starts[counts >= level]
        found.append((rows[often], values[often] ^ mark))
    all_rows, all_values = (np.concatenate(part) for part in zip(*found))
    by_row = np.argsort(all_rows, kind="stable")
    return all_rows[by_row], all_values[by_row]


@dataclass(frozen=True)
class Classifier:
    """Sorted features with their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        # Most features of a text are not used: a bit table turns them away.
        known = np.zeros(1 << 20, dtype=bool)
        for mark in (np.uint64(0), *LEVELS.values()):
            known[(self.features ^ mark) >> np.uint64(44)] = True
        object.__setattr__(self, "_known", known)

    def used(self, rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and index of the features in use, each once per row."""
        maybe = np.flatnonzero(self._known[values >> np.uint64(44)])
        rows, values = _distinct(rows[maybe], values[maybe])
        place = np.searchsorted(self.features, values)
        place = np.minimum(place, max(len(self.features) - 1, 0))
        same = self.features[place] == values if len(self.features) else values != values
        return rows[same], place[same]

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of each text; an empty one has that of the bias alone."""
        sums = np.zeros(len(column))
        for first, last, rows, values in text_features(column):
            rows, place = self.used(rows, values)
            sums[first:last] += np.bincount(rows, self.weights[place], minlength=last - first)
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -50, 50)))


# Without toxic texts to learn from: calls all clean.
NOTHING = Classifier(np.zeros(0, dtype=np.uint64), np.zeros(0), -5.0)


def fit_risk(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk of logistic loss.

    Both matrices have texts as rows and feature presence as columns.
    """
    width = positive.shape[1]
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(matrix: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        slope = per_row.astype(np.float32) / max(len(matrix), 1)
        return np.append(slope @ matrix, slope.sum())

    def margin(matrix: np.ndarray) -> np.ndarray:
        return matrix @ theta[:-1].astype(np.float32) + theta[-1]

    for step in range(1, steps + 1):
        g_positive, g_unlabelled = margin(positive), margin(unlabelled)
        p_positive, p_unlabelled = 1 / (1 + np.exp(-g_positive)), 1 / (1 + np.exp(-g_unlabelled))
        clean_risk = np.logaddexp(0, g_unlabelled).mean() - prior * np.logaddexp(0, g_positive).mean()
        clean = gradient(unlabelled, p_unlabelled) - prior * gradient(positive, p_positive)
        toxic = prior * gradient(positive, p_positive - 1)
        slope = toxic + clean if clean_risk >= 0 else -clean
        slope[:-1] += PENALTY * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= LEARNING_RATE * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    return theta[:-1], float(theta[-1])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many positive and unlabelled texts have each feature, summed up for some
    texts at a time."""

    def summed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, is_positive = (np.concatenate(part) for part in zip(*found))
        distinct, inverse = np.unique(values, return_inverse=True)
        both = np.bincount(inverse, minlength=len(distinct))
        p = np.bincount(inverse, is_positive, minlength=len(distinct)).astype(np.int64)
        return pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(distinct.view(np.int64)),
                "p": pa.array(p),
                "u": pa.array(both - p),
            }
        )

    found: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        positive = batch["positive"].to_numpy(zero_copy_only=False).astype(bool)
        for first, _, rows, values in text_features(batch["text"]):
            rows, values = _distinct(rows, values)
            found.append((values, positive[rows + first]))
            if sum(len(values) for values, _ in found) > FEATURES_AT_ONCE:
                yield summed(found)
                found = []
    if found:
        yield summed(found)


def _used_features(classifier: Classifier):
    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [np.zeros(0, dtype=np.int64)] * batch.num_rows
            for first, last, rows, values in text_features(batch["text"]):
                rows, place = classifier.used(rows, values)
                ends = np.searchsorted(rows, np.arange(last - first + 1))
                for i in range(last - first):
                    places[first + i] = place[ends[i] : ends[i + 1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "positive": batch["positive"],
                    "places": pa.array([p.tolist() for p in places], pa.list_(pa.int32())),
                }
            )

    return use


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(positive, text): confirmed toxic and unlabelled texts outside fold 0.

    Both are the ids with the smallest hashes, so a sample does not depend on the
    order of rows. Texts without a label and those with one are unlabelled alike. Of
    rows that share an id the least text counts.
    """
    toxic = labels.where((F.col("toxic") == 1) & (fold() != 0)).select("doc_id").distinct()
    others = docs.where(fold() != 0).select("doc_id").distinct()

    def smallest(ids: DataFrame, seed: int, n: int) -> DataFrame:
        return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)

    in_docs = toxic.join(others, "doc_id", "left_semi")
    positive = smallest(in_docs, 1, MAX_POSITIVE).withColumn("positive", F.lit(True))
    unlabelled = smallest(others, 2, MAX_UNLABELLED).withColumn("positive", F.lit(False))
    # At most MAX_POSITIVE + MAX_UNLABELLED ids.
    chosen = positive.union(unlabelled).select(F.col("doc_id").alias("_id"), "positive")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return texts.groupBy("_id", "positive").agg(F.min("text").alias("text")).drop("_id")


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit the classifier; without a confirmed toxic text it calls all clean.

    The texts of the sample are written to the shared folder once and read from there.
    Counts that choose the features are made by Spark; the driver gets a thousand
    features and, for each sample text, the few of them that it has.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where((fold() != 0) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"]
    if not prior:
        return NOTHING
    prior = min(max(prior, 1e-4), 0.9)
    folder = shared_path(spark, "toxicity-sample")
    try:
        _sample(docs, labels).write.parquet(folder)
        return _fit(spark.read.schema("positive boolean, text string").parquet(folder), prior)
    finally:
        remove(spark, folder)


def _fit(sample: DataFrame, prior: float) -> Classifier:
    """The classifier of a sample (positive, text) at a class prior."""
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return NOTHING
    counts = (
        sample.mapInArrow(returning_memory(_feature_counts), "feature bigint, p bigint, u bigint")
        .groupBy("feature")
        .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    )
    rate = (F.col("p") + F.col("u")) / F.lit(n_p + n_u)
    spread = F.sqrt(rate * (1 - rate) * F.lit(1 / n_p + 1 / n_u) + F.lit(1e-12))
    z = (F.col("p") / F.lit(n_p) - F.col("u") / F.lit(n_u)) / spread
    chosen = (
        counts.where(F.col("p") >= MIN_POSITIVE_TEXTS)
        .withColumn("z", z)
        .where(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    features = np.sort(np.array([row["feature"] for row in chosen], dtype=np.int64).view(np.uint64))
    blank = Classifier(features, np.zeros(len(features)), 0.0)
    rows = sample.mapInArrow(returning_memory(_used_features(blank)), "positive boolean, places array<int>").toPandas()
    matrices = []
    for wanted in (True, False):
        places = rows.loc[rows["positive"] == wanted, "places"]
        matrix = np.zeros((len(places), len(features)), dtype=np.float32)
        for i, used in enumerate(places):
            matrix[i, used] = 1
        matrices.append(matrix)
    weights, bias = fit_risk(*matrices, prior)
    return Classifier(features, weights, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` as doc_id, held_out, score, predicted.

    Labels are learnt from ids outside fold 0 only, and the text alone is scored.
    Null counts as empty; an empty text has the score of no evidence. Equal texts
    have equal scores. Without toxic labels every score is near zero. No documents
    give no rows.
    """
    classifier = train(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = classifier.scores(batch["text"])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": pa.array(scores),
                    "predicted": pa.array((scores >= 0.5).astype(np.int32)),
                }
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, held_out boolean, score double, predicted int"
    return docs.select("doc_id", (fold() == 0).alias("held_out"), "text").mapInArrow(returning_memory(score), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with all columns.

    One pass in place: rows are filtered where they are read, not joined back.
    """
    classifier = train(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(classifier.scores(batch["text"]) < 0.5))

    return docs.mapInArrow(returning_memory(keep), docs.schema)
