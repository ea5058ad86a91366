"""Quality by attention over passages."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from genoframe.llm import attention, passages

WHITE = " \t\n\v\f\r"
WORDS = "the of and river stone walked slowly under bright clouds toward evening".split()


def plain_features(text):
    """Words and features of each passage, counted one by one."""
    data = text.encode()
    spans, at = [], 0
    while at < len(data):
        while at < len(data) and chr(data[at]) in WHITE:
            at += 1
        start = at
        while at < len(data) and chr(data[at]) not in WHITE:
            at += 1
        if at > start:
            spans.append((start, at))
    words = [data[a:b] for a, b in spans]
    runs = [tuple(words[i : i + passages.RUN]) for i in range(len(words) - passages.RUN + 1)]
    n = max((len(words) + 25) // 50, 1)
    kinds = {}
    for i, letters in enumerate(passages.SETS):
        kinds |= dict.fromkeys(letters, i)
    result = []
    for k in range(n):
        low, high = 50 * k, len(words) if k == n - 1 else 50 * (k + 1)
        mine = range(low, min(high, len(words)))
        if not mine:
            result.append((0, [0.0] * passages.FEATURES))
            continue
        end = spans[high][0] if high < len(spans) else spans[mine[-1]][1]
        part = data[spans[low][0] : end]
        codes = [kinds.get(b, len(passages.SETS) + (b >= 128)) for b in part]
        c = passages.CLASSES
        single = [codes.count(i) / len(part) for i in range(c)]
        pairs = [0.0] * c * c
        for a, b in zip(codes, codes[1:]):
            pairs[a * c + b] += 1 / len(part)
        lengths = [0.0] * (len(passages.LENGTHS) + 1)
        for i in mine:
            lengths[sum(len(words[i]) >= least for least in passages.LENGTHS)] += 1 / len(mine)
        shares = [
            sum(i > 0 and words[i] == words[i - 1] for i in mine),
            sum(words[i] in words[low:i] for i in mine),
            sum(i < len(runs) and runs.count(runs[i]) >= 2 for i in mine),
            sum(i < len(runs) and runs.count(runs[i]) >= 3 for i in mine),
        ]
        features = single + pairs + lengths + [s / len(mine) for s in shares]
        result.append((len(mine), np.sqrt(features)))
    return result


def same_as_plain(texts, column):
    seen = 0
    for first, last, found in passages.text_passages(column):
        for i in range(first, last):
            low, high = found.rows[i - first], found.rows[i - first + 1]
            wanted = plain_features(texts[i] or "")
            assert found.words[low:high].tolist() == [w for w, _ in wanted]
            np.testing.assert_allclose(found.features[low:high], [f for _, f in wanted], atol=1e-12)
            seen += 1
    assert seen == len(texts)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 \n.!é|", max_size=400)), max_size=6))
@settings(max_examples=60, deadline=None)
def test_features(texts):
    same_as_plain(texts, pa.array(texts, pa.string()))


def test_features_of_a_text_cut_into_pieces(monkeypatch):
    pick = random.Random(3)
    texts = [" ".join(pick.choices(WORDS, k=k)) for k in (700, 3, 0, 74, 75, 124, 2000)]
    column = pa.array(texts)
    whole = [found.features for _, _, found in passages.text_passages(column)]
    monkeypatch.setattr(
        passages, "pieces", lambda c, f=passages.pieces: f(c, piece_bytes=256)
    )
    cut = list(passages.text_passages(column))
    assert len(cut) > len(whole)
    same = np.concatenate([found.words for _, _, found in cut])
    assert same.sum() == 700 + 3 + 74 + 75 + 124 + 2000
    # Pairs of bytes across a cut are not seen; everything else is.
    parts = np.concatenate([found.features for _, _, found in cut])
    others = [*range(passages.CLASSES), *range(passages.FEATURES - 12, passages.FEATURES)]
    np.testing.assert_allclose(parts[:, others], np.concatenate(whole)[:, others], atol=0.12)


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    x, rows = rng.normal(size=(9, 5)), np.array([0, 1, 4, 9])
    label, importance = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    p = attention.initial(rng, 5)

    def loss(p):
        q = attention.forward(p, x, rows)["probability"]
        each = -(label * np.log(q) + (1 - label) * np.log(1 - q))
        return (importance * each).sum() / importance.sum()

    slopes = attention.gradients(p, x, rows, label, importance)
    for name, value in p.items():
        for place in list(np.ndindex(value.shape))[:: max(value.size // 7, 1)]:
            moved = {k: v.copy() for k, v in p.items()}
            moved[name][place] += 1e-6
            up = loss(moved)
            moved[name][place] -= 2e-6
            assert slopes[name][place] == pytest.approx((up - loss(moved)) / 2e-6, abs=1e-7)


def corpus(n, seed=1):
    """Good prose; a fifth has one bad passage at any place of the text."""
    pick = random.Random(seed)
    texts, quality = [], []
    for _ in range(n):
        words = pick.choices(WORDS, k=pick.randint(5, 600))
        quality.append(int(pick.random() < 0.8))
        if not quality[-1]:
            at = pick.randrange(len(words))
            words[at:at] = [w.upper() + "!!" for w in pick.choices(WORDS, k=60)]
        texts.append(" ".join(words))
    return texts, quality


@pytest.fixture(scope="module")
def tables(spark):
    texts, quality = corpus(1500)
    labels = [(i, q, 0) for i, q in enumerate(quality) if i % 2 == 0]
    return (
        documents(spark, enumerate(texts)),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        quality,
    )


def test_held_out_accuracy(spark, tables):
    docs, labels, quality = tables
    found = attention.score_quality(clashing(docs), labels).collect()
    assert len(found) == len(quality)
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)
    held = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == quality[r["doc_id"]] for r in held)
    assert right >= 0.97 * len(held)


def test_attention_finds_the_bad_passage(spark, tables):
    docs, labels, quality = tables
    rows = attention.attended_passages(docs, attention.train(docs, labels)).collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], []).append(row)
    hit = tried = 0
    for doc_id, found in by_id.items():
        assert sum(r["weight"] for r in found) == pytest.approx(1, abs=1e-4)
        if not quality[doc_id] and len(found) >= 5:
            tried += 1
            worst = min(found, key=lambda r: r["score"])
            hit += worst["weight"] > 1 / len(found) and worst["score"] < 0.5
    assert tried > 50 and hit >= 0.9 * tried


def test_held_out_labels_are_not_read(spark, tables):
    docs, labels, _ = tables
    flipped = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality",
        "toxic",
    )
    first, second = (rows_of(attention.score_quality(docs, x)) for x in (labels, flipped))
    assert first == second


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, 0, None)], [(1, None, 1)], [(77, 1, 1), (78, 0, 1)]])
def test_labels_of_one_kind(spark, labelled):
    rows = [(1, "a b"), (2, None), (2, ""), (None, "c " * 9), (3, " ")]
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int")
    found = attention.score_quality(documents(spark, rows), labels).collect()
    assert len({r["score"] for r in found}) == 1
    assert [r["n_passages"] for r in found] == [1] * 5
    assert attention.score_quality(documents(spark, []), labels).count() == 0


def test_odd_texts(spark, tables):
    docs, labels, _ = tables
    model = attention.train(docs, labels)
    junk = " ".join(w.upper() + "!!" for w in WORDS * 40)
    prose = " ".join(WORDS * 40)
    texts = [None, "", " \n", "the", prose, junk, prose * 60 + "\n" + junk * 60, prose * 120]
    scores, n = model.scores(pa.array(texts))
    assert scores[0] == scores[1] == scores[2]
    assert scores[4] >= 0.5 > scores[5]
    assert scores[6] < 0.5 <= scores[7]
    assert n[6] > 500
    again, _ = model.scores(pa.array(texts[::-1]))
    assert again[::-1].tolist() == scores.tolist()


def test_ids_with_two_labels_and_two_texts(spark, tables):
    docs, labels, quality = tables
    both = labels.union(labels.selectExpr("doc_id", "quality", "toxic"))
    twice = docs.union(docs)
    found = attention.score_quality(twice, both)
    assert found.count() == 2 * len(quality)
    assert found.select("doc_id", "score").distinct().count() == len(quality)
