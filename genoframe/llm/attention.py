"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Each passage is encoded,
gated attention says how much it weighs in its document, and the weighted sum of the
encodings is scored. Encoder, attention and scorer are learnt together from the labels
of documents; no passage is labelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import returning_memory, small_batches
from genoframe.llm.passages import FEATURES, text_passages
from genoframe.llm.toxicity import fold

FOLDS, HELD_OUT = 3, 1
# Labelled documents that the model is fitted on, at most for each label, and passages
# of one of them, evenly spread over it. Scores read every passage.
MAX_LABELLED = 2500
MAX_PASSAGES = 32
# Sizes of encodings and of attention.
ENCODING, ATTENTION = 32, 16
EPOCHS, BAGS, LEARNING_RATE, PENALTY = 24, 128, 0.005, 1e-4
# Words of a passage at which its features count half: few words say little.
HALF = 5
# Digits of a score: sums in another order differ behind them.
DIGITS = 6

Parameters = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def initial(rng: np.random.Generator, width: int) -> Parameters:
    """Random weights."""

    def drawn(rows: int, columns: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(rows), (rows, columns))

    return {
        "encoder": drawn(width, ENCODING), "encoder_bias": np.zeros(ENCODING),
        "value": drawn(ENCODING, ATTENTION), "gate": drawn(ENCODING, ATTENTION),
        "attention": drawn(ATTENTION, 1)[:, 0],
        "scorer": drawn(ENCODING, 1)[:, 0], "bias": np.zeros(1),
    }


def forward(p: Parameters, x: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Everything on the way from features to the probability of each bag.

    ``rows`` are the offsets of the bags, none of them empty.
    """
    h = np.tanh(x @ p["encoder"] + p["encoder_bias"])
    value, gate = np.tanh(h @ p["value"]), _sigmoid(h @ p["gate"])
    logit = (value * gate) @ p["attention"]
    bag = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    top = np.maximum.reduceat(logit, rows[:-1])
    raised = np.exp(logit - top[bag])
    weight = raised / np.add.reduceat(raised, rows[:-1])[bag]
    z = np.add.reduceat(weight[:, None] * h, rows[:-1], axis=0)
    probability = _sigmoid(z @ p["scorer"] + p["bias"][0])
    return {
        "h": h, "value": value, "gate": gate, "bag": bag, "weight": weight, "z": z,
        "probability": probability,
    }


def gradients(
    p: Parameters, x: np.ndarray, rows: np.ndarray, label: np.ndarray, importance: np.ndarray
) -> Parameters:
    """Slopes of the weighted mean logistic loss."""
    f = forward(p, x, rows)
    bag, weight, h = f["bag"], f["weight"], f["h"]
    d_score = importance * (f["probability"] - label) / importance.sum()
    d_z = d_score[:, None] * p["scorer"]
    d_h = weight[:, None] * d_z[bag]
    d_weight = (h * d_z[bag]).sum(axis=1)
    mean = np.add.reduceat(weight * d_weight, rows[:-1])
    d_logit = weight * (d_weight - mean[bag])
    d_product = d_logit[:, None] * p["attention"]
    d_value = d_product * f["gate"] * (1 - f["value"] ** 2)
    d_gate = d_product * f["value"] * f["gate"] * (1 - f["gate"])
    d_h += d_value @ p["value"].T + d_gate @ p["gate"].T
    d_in = d_h * (1 - h**2)
    return {
        "encoder": x.T @ d_in, "encoder_bias": d_in.sum(axis=0),
        "value": h.T @ d_value, "gate": h.T @ d_gate,
        "attention": (f["value"] * f["gate"]).T @ d_logit,
        "scorer": f["z"].T @ d_score, "bias": np.array([d_score.sum()]),
    }


@dataclass(frozen=True)
class Model:
    """Scaling of the features and learnt weights."""

    mean: np.ndarray
    scale: np.ndarray
    parameters: Parameters

    def scaled(self, features: np.ndarray, words: np.ndarray) -> np.ndarray:
        # What the sample has never seen stays within reach of what it has.
        trust = words / (words + HALF)
        return np.clip((features - self.mean) / self.scale, -4, 4) * trust[:, None]

    def scores(self, column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Probability and number of passages of each text."""
        score, n = np.zeros(len(column)), np.zeros(len(column), dtype=np.int64)
        for first, last, found in text_passages(column):
            bags = forward(self.parameters, self.scaled(found.features, found.words), found.rows)
            score[first:last] = np.round(bags["probability"], DIGITS)
            n[first:last] = np.diff(found.rows)
        return score, n

    def weights(self, column: pa.Array) -> Iterator[list[tuple[int, int, float, float]]]:
        """For each text its passages: first word, words, attention weight, own score."""
        for _, _, found in text_passages(column):
            x = self.scaled(found.features, found.words)
            bags = forward(self.parameters, x, found.rows)
            alone = forward(self.parameters, x, np.arange(len(x) + 1))["probability"]
            for low, high in zip(found.rows[:-1], found.rows[1:]):
                words = found.words[low:high]
                starts = np.cumsum(words) - words
                weight, own = (np.round(a[low:high], DIGITS) for a in (bags["weight"], alone))
                yield list(zip(starts.tolist(), words.tolist(), weight.tolist(), own.tolist()))


def fit(
    bags: list[np.ndarray], labels: np.ndarray, importance: np.ndarray, epochs: int = EPOCHS
) -> Model:
    """Fit to bags of passages by Adam, in an order that a fixed seed draws.

    The last column of a bag is the number of words of each passage.
    """
    # In single precision and one copy: 180 MB at most with the bounds above.
    every = np.concatenate([bag.astype(np.float32) for bag in bags])
    every, words = every[:, :-1], every[:, -1]
    mean = every.mean(axis=0, dtype=np.float64)
    scale = np.sqrt(((every - mean.astype(np.float32)) ** 2).mean(axis=0, dtype=np.float64)) + 1e-3
    every -= mean.astype(np.float32)
    every /= scale.astype(np.float32)
    np.clip(every, -4, 4, out=every)
    every *= (words / (words + HALF))[:, None]
    offsets = np.concatenate([[0], np.cumsum([len(bag) for bag in bags])])
    rng = np.random.default_rng(0)
    p = initial(rng, every.shape[1])
    rate = np.average(labels, weights=importance)
    p["bias"][0] = np.log(rate / (1 - rate))
    first = {name: np.zeros_like(v) for name, v in p.items()}
    second = {name: np.zeros_like(v) for name, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        pace = LEARNING_RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BAGS):
            chosen = order[at : at + BAGS]
            sizes = offsets[chosen + 1] - offsets[chosen]
            rows = np.concatenate([[0], np.cumsum(sizes)])
            index = np.arange(rows[-1]) + np.repeat(offsets[chosen] - rows[:-1], sizes)
            slopes = gradients(p, every[index], rows, labels[chosen], importance[chosen])
            step += 1
            for name, slope in slopes.items():
                slope = slope + PENALTY * p[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                p[name] = p[name] - pace * (first[name] / (1 - 0.9**step)) / (
                    np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                )
    return Model(mean, scale, p)


def constant(rate: float) -> Model:
    """A model that knows the share of good documents alone."""
    p = {name: np.zeros_like(v) for name, v in initial(np.random.default_rng(0), FEATURES).items()}
    rate = min(max(rate, 1e-4), 1 - 1e-4)
    p["bias"][0] = np.log(rate / (1 - rate))
    return Model(np.zeros(FEATURES), np.ones(FEATURES), p)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and words of the passages of each text, in half precision."""
    for batch in batches:
        packed: list[bytes] = []
        for _, _, found in text_passages(batch["text"]):
            every = np.column_stack([found.features, found.words]).astype(np.float16)
            for low, high in zip(found.rows[:-1], found.rows[1:]):
                n = min(high - low, MAX_PASSAGES)
                spread = low + (np.arange(n) * (high - low)) // n
                packed.append(every[spread].tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "id": batch["_id"].cast(pa.string()),
                "label": batch["label"],
                "bag": pa.array(packed, pa.binary()),
            }
        )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model to labelled documents outside the held-out fold.

    Of each label the ``MAX_LABELLED`` ids with the smallest hashes are used, and from
    each ``MAX_PASSAGES`` passages at most. An id with both labels counts as low, and
    of several texts of one id the smallest counts. Without examples of both labels
    every document gets the share of good ones.
    """
    small_batches(docs.sparkSession)
    known = (
        labels.where((fold(folds=FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1))
        .where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
    )
    present = docs.where(fold(folds=FOLDS) != HELD_OUT).select("doc_id").distinct()
    known = known.join(present, "doc_id", "left_semi")
    totals = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return constant(0.5 if not totals else float(next(iter(totals))))
    chosen = None
    for label in (0, 1):
        ids = known.where(F.col("label") == label).orderBy(F.xxhash64(F.lit(label), "doc_id"), "doc_id")
        part = ids.limit(MAX_LABELLED).select(F.col("doc_id").alias("_id"), "label")
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * MAX_LABELLED ids.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    texts = texts.groupBy("_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = (
        texts.select("_id", "label", "text")
        .mapInArrow(returning_memory(_encoded), "id string, label int, bag binary")
        .collect()
    )
    rows.sort(key=lambda row: row["id"])
    label = np.array([row["label"] for row in rows], dtype=np.float64)
    bags = [np.frombuffer(row["bag"], dtype=np.float16).reshape(-1, FEATURES + 1) for row in rows]
    sampled = np.bincount(label.astype(int), minlength=2)
    # Each example stands for as many documents as its label has per example.
    importance = np.where(label == 1, totals[1] / max(sampled[1], 1), totals[0] / max(sampled[0], 1))
    return fit(bags, label, importance)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` as doc_id, held_out, score, predicted, n_passages.

    Labels are learnt from ids outside the held-out fold only, and the text alone is
    scored, all passages of it. Null counts as empty; a text without words is one
    passage of nothing. Equal texts have equal scores. No documents give no rows.
    """
    model = train(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, n = model.scores(batch["text"])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": pa.array(scores),
                    "predicted": pa.array((scores >= 0.5).astype(np.int32)),
                    "n_passages": pa.array(n),
                }
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, held_out boolean, score double, predicted int, n_passages bigint"
    held_out = (fold(folds=FOLDS) == HELD_OUT).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(returning_memory(score), schema)


def attended_passages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per passage: doc_id, first_word, n_words, weight in its document, and the
    score that it would have alone. A text without words has one passage of none."""
    small_batches(docs.sparkSession)
    names = ("first_word", "n_words", "weight", "score")

    def attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(model.weights(batch["text"]))
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = [passage for f in found for passage in f]
            columns = zip(names, zip(*flat)) if flat else ((name, []) for name in names)
            ids = batch["doc_id"].take(pa.array(owner, pa.int64()))
            kinds = dict(zip(names, (pa.int64(), pa.int64(), pa.float64(), pa.float64())))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": ids} | {name: pa.array(v, kinds[name]) for name, v in columns}
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, first_word bigint, n_words bigint, weight double, score double"
    return docs.select("doc_id", "text").mapInArrow(returning_memory(attend), schema)
