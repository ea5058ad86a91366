"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = "the of and to lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def clashing(docs):
    """The same table with more columns, named like working columns of operators."""
    from pyspark.sql import functions as F

    names = """size rate copies words lines windows norm digest node n counts block group start
        source_size target _mix_rate _mix_salt _mix_row _near_id _exact_norm _exact_range
        _exact_row _exact_sha256 carrier piece_id held_out positive key root"""
    return docs.select("*", *(F.lit(i).alias(name) for i, name in enumerate(names.split())))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_texts(n, seed, vocabulary=VOCABULARY):
    """Texts of 0 to 60 words with odd white space."""
    pick = random.Random(seed)
    texts = []
    for _ in range(n):
        words = pick.choices(vocabulary, k=pick.choice([0, 1, 2, 3, 5, 12, 30, 60]))
        texts.append("".join(w + pick.choice([" ", " ", "  ", "\n", "\t ", "\r\n"]) for w in words))
    return texts
