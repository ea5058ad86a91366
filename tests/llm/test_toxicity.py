"""Toxicity by positive-unlabelled learning."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import VOCABULARY, clashing, documents, rows_of

from genoframe.llm import toxicity

BAD_WORDS = ("blorgish", "snarfest", "quixel")


def corpus(n, seed=1):
    """A tenth is toxic: bad words, whole or as the beginning of another word."""
    pick = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        words = pick.choices(VOCABULARY + [f"r{k}" for k in range(400)], k=pick.randint(5, 80))
        toxic.append(int(pick.random() < 0.1))
        for _ in range(3 * toxic[-1]):
            words.insert(pick.randrange(len(words)), pick.choice(BAD_WORDS) + pick.choice(["", "ly", "s,"]))
        texts.append(" ".join(words))
    return texts, toxic


@pytest.fixture(scope="module")
def tables(spark):
    texts, toxic = corpus(3000)
    labels = [(i, 1, t) for i, t in enumerate(toxic) if i % 2 == 0]
    return (
        documents(spark, enumerate(texts)),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        toxic,
    )


def test_held_out_accuracy(spark, tables):
    docs, labels, toxic = tables
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(toxic)
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)
    held = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in held)
    assert right >= 0.98 * len(held)


def test_held_out_labels_are_not_read(spark, tables):
    docs, labels, _ = tables
    flipped = labels.selectExpr(
        "doc_id", "quality",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic",
    )
    assert rows_of(toxicity.score_toxicity(docs, labels)) == rows_of(
        toxicity.score_toxicity(docs, flipped)
    )


def test_drop_keeps_clean_rows_whole(spark, tables):
    docs, labels, toxic = tables
    docs = clashing(docs)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    scores = toxicity.score_toxicity(docs, labels)
    assert ids == {r["doc_id"] for r in scores.where("predicted = 0").collect()}


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, 1, None)], [(77, 1, 1)]])
def test_without_toxic_labels_nothing_is_called_toxic(spark, labelled):
    rows = [(1, "a b"), (2, None), (2, ""), (None, "c " * 9), (3, " ")]
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int")
    found = toxicity.score_toxicity(documents(spark, rows), labels).collect()
    assert [r["predicted"] for r in found] == [0] * 5
    assert toxicity.drop_toxic(documents(spark, rows), labels).count() == 5
    assert toxicity.score_toxicity(documents(spark, []), labels).count() == 0


def test_risk_is_corrected_by_the_prior():
    """Half of the unlabelled texts with the feature are toxic at this prior."""
    rng = np.random.default_rng(0)
    positive = np.ones((200, 1), dtype=np.float32)
    unlabelled = (rng.random((2000, 1)) < 0.4).astype(np.float32)
    weights, bias = toxicity.fit_risk(positive, unlabelled, prior=0.2)
    probability = 1 / (1 + np.exp(-(weights[0] + bias)))
    assert probability == pytest.approx(0.5, abs=0.08)
    assert bias < -3


def test_long_text_is_read_to_its_end():
    model = toxicity.Classifier(
        np.sort(np.concatenate([v for _, _, _, v in toxicity.text_features(pa.array(["zz"]))])),
        np.array([9.0]), -5.0,
    )
    scores = model.scores(pa.array(["a " * 2_000_000 + "ZZ", "a", None, "zz zz"]))
    assert (scores > 0.5).tolist() == [True, False, False, True]
    assert scores[0] == scores[3]


def plain_features(text):
    """Words, beginnings of longer ones, and how often each comes, as sets of Python."""
    word, words = "", []
    for letter in (text or "").lower() + " ":
        if letter.isalnum():
            word += letter
        else:
            words += [word] if word else []
            word = ""
    counts = {}
    for word in words:
        found = [("word", word)] + [(n, word[:n]) for n in toxicity.PREFIX_BYTES if len(word) > n]
        for feature in found:
            counts[feature] = counts.get(feature, 0) + 1
    levels = (1, *toxicity.LEVELS)
    return {(*feature, level) for feature, n in counts.items() for level in levels if n >= level}


def hash_of(feature):
    kind, letters, level = feature
    ((_, _, _, values),) = toxicity.text_features(pa.array([letters]))
    value = values[0] if kind == "word" else values[0] ^ np.uint64(kind)
    return int(value if level == 1 else value ^ toxicity.LEVELS[level])


def test_features_equal_a_plain_count(spark, tables):
    docs, labels, _ = tables
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = [i for i in texts if zlib.crc32(str(i).encode()) % 5]
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    counts, n_p, n_u = {}, sum(i in toxic for i in known), len(known)
    for i in known:
        for feature in plain_features(texts[i]):
            p, u = counts.get(feature, (0, 0))
            counts[feature] = (p + (i in toxic), u + 1)
    expected = set()
    for feature, (p, u) in counts.items():
        rate = (p + u) / (n_p + n_u)
        spread = (rate * (1 - rate) * (1 / n_p + 1 / n_u) + 1e-12) ** 0.5
        if p >= toxicity.MIN_POSITIVE_TEXTS and (p / n_p - u / n_u) / spread >= toxicity.MIN_Z:
            expected.add(hash_of(feature))
    found = toxicity.train(docs, labels).features.tolist()
    assert len(expected) < toxicity.MAX_FEATURES
    assert set(found) == expected and len(found) == len(expected)


def plain_risk_fit(positive, unlabelled, prior, steps):
    """The non-negative risk and Adam, number by number."""
    from math import exp, log, sqrt

    width = len(positive[0]) + 1
    theta, first, second = [0.0] * width, [0.0] * width, [0.0] * width
    theta[-1] = log(prior / (1 - prior))

    def margins(rows):
        return [sum(t * x for t, x in zip(theta, [*row, 1])) for row in rows]

    def mean_slope(rows, per_row):
        return [sum(s * [*row, 1][k] for row, s in zip(rows, per_row)) / len(rows) for k in range(width)]

    for step in range(1, steps + 1):
        g_p, g_u = margins(positive), margins(unlabelled)
        sigma_p, sigma_u = ([1 / (1 + exp(-g)) for g in part] for part in (g_p, g_u))
        loss_p, loss_u = (sum(log(1 + exp(g)) for g in part) / len(part) for part in (g_p, g_u))
        up, down = mean_slope(unlabelled, sigma_u), mean_slope(positive, sigma_p)
        pull = mean_slope(positive, [s - 1 for s in sigma_p])
        for k in range(width):
            clean = up[k] - prior * down[k]
            slope = prior * pull[k] + clean if loss_u - prior * loss_p >= 0 else -clean
            if k < width - 1:
                slope += toxicity.PENALTY * theta[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            theta[k] -= toxicity.LEARNING_RATE * (first[k] / (1 - 0.9**step)) / (
                sqrt(second[k] / (1 - 0.999**step)) + 1e-8
            )
    return theta


def plain_risk(theta, positive, unlabelled, prior):
    from math import exp, log

    def loss(rows):
        return sum(log(1 + exp(sum(t * x for t, x in zip(theta, [*row, 1])))) for row in rows) / len(rows)

    def loss_if_toxic(rows):
        return sum(log(1 + exp(-sum(t * x for t, x in zip(theta, [*row, 1])))) for row in rows) / len(rows)

    return prior * loss_if_toxic(positive) + max(0, loss(unlabelled) - prior * loss(positive))


@pytest.mark.parametrize("prior", [0.1, 0.3, 0.8])
def test_risk_is_that_of_a_plain_fit(prior):
    """Weights are not compared: the first step's slope of the bias is zero but for
    rounding, which Adam scales up, so single steps differ while the risk reached does not."""
    rng = np.random.default_rng(1)
    positive = (rng.random((12, 4)) < 0.7).astype(np.float32)
    unlabelled = (rng.random((40, 4)) < 0.3).astype(np.float32)
    weights, bias = toxicity.fit_risk(positive, unlabelled, prior, steps=400)
    tables = positive.tolist(), unlabelled.tolist(), prior
    start = plain_risk([0.0] * 4 + [np.log(prior / (1 - prior))], *tables)
    plain = plain_risk(plain_risk_fit(*tables, 400), *tables)
    found = plain_risk([*weights, bias], *tables)
    assert plain < start
    # Near a risk of zero both go to and fro; 0.01 of the way down is close.
    assert found == pytest.approx(plain, rel=0.02, abs=0.01 * start)


def test_repeated_ids_are_one_row_of_the_sample(spark):
    texts, toxic = corpus(400)
    rows = [(i, text) for i, text in enumerate(texts)]
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id bigint, toxic int")
    once = toxicity._sample(documents(spark, rows), labels)
    again = toxicity._sample(documents(spark, rows * 3), labels)
    assert rows_of(once) == rows_of(again)


def test_sample_leaves_nothing_behind(spark, tables):
    import glob

    from genoframe.plans.shared import shared_folder

    docs, labels, _ = tables
    toxicity.train(docs, labels)
    folder = shared_folder(spark).removeprefix("file:")
    assert not glob.glob(f"{folder}/toxicity-sample-*")
