"""Quality rules as a short-circuit cascade of SQL expressions.

Each rule's rejections are counted and its time is taken on a sample; the rule that
rejects most per cost is asked first, and a document that it rejects is asked no other.
The order decides what is computed and which rule is named, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space of the word definition, window length of repeats.
WORD = r"[^\\x20\\x09-\\x0D]+"
WHITE = r"[\\x20\\x09-\\x0D]"
WINDOW = 5
# Rows on which rules are estimated, at most.
SAMPLE_ROWS = 2000
SAMPLE_SEED = 7
# Runs that a rule is timed in; the first one compiles it.
TIMED_RUNS = 3


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL condition over the measures and ``text``."""

    name: str
    rejects: str


RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    Rule("shouting", r"2 * regexp_count(text, '\\p{Lu}') > regexp_count(text, '\\p{L}')"),
    Rule("exclamations", "10 * regexp_count(text, '!!') > 3 * n_words"),
    Rule("no_letters", r"NOT coalesce(text, '') RLIKE '\\p{L}'"),
)
BASE_RULES = ("few_words", "repeated_words")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the measures of each whole text; null counts as empty.

    n_repeat_words: words inside a window of five words that occurs at least twice
    in the text. Windows are compared by a 64-bit hash of their words. Only texts
    with equal windows go on: their windows are sorted by hash, and the places of
    those with an equal neighbour are laid over each other.
    """
    n, w = WINDOW, ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    read = docs.selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr(
        "*",
        f"regexp_extract_all(text, '{WORD}', 0) AS words",
        f"filter(split(text, '\\n', -1), x -> x RLIKE '{WORD}') AS lines",
    )
    hashed = read.selectExpr(
        "*",
        f"""CASE WHEN size(words) < {n} THEN array()
            ELSE transform(sequence(0, size(words) - {n}), i -> xxhash64({w})) END AS windows""",
    )
    again = hashed.selectExpr(
        "*",
        """CASE WHEN size(array_distinct(windows)) < size(windows) THEN
             array_sort(transform(windows, (h, i) -> struct(h, i)))
           END AS by_hash""",
    ).selectExpr(
        "*",
        """sort_array(transform(
             filter(by_hash, (x, k) -> coalesce(x.h = get(by_hash, k - 1).h, false)
                                    OR coalesce(x.h = get(by_hash, k + 1).h, false)),
             x -> x.i)) AS places""",
    )
    covered = f"""aggregate(places, struct(0 AS words, 0 AS reached),
        (a, p) -> struct(a.words + p + {n} - greatest(p, a.reached) AS words,
                         p + {n} AS reached), a -> a.words)"""
    return again.selectExpr(
        "doc_id",
        "text",
        "CAST(size(words) AS BIGINT) AS n_words",
        f"CAST(length(text) - regexp_count(text, '{WHITE}') AS BIGINT) AS word_chars",
        "CAST(regexp_count(text, '[#*$%&|<>]') AS BIGINT) AS n_symbols",
        "CAST(size(lines) AS BIGINT) AS n_lines",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines",
        f"CAST(coalesce({covered}, 0) AS BIGINT) AS n_repeat_words",
    )


def _seconds(rows: DataFrame, condition: str) -> list[float]:
    """Times of asking the condition for all rows, without the first run."""
    asked = rows.agg(F.count_if(F.expr(condition)))
    times = []
    for _ in range(TIMED_RUNS):
        begin = time.perf_counter()
        asked.first()
        times.append(time.perf_counter() - begin)
    return times[1:]


def rule_costs(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> dict[str, float]:
    """Seconds that each rule takes on the rows, beyond those of a job that asks next
    to nothing; ``measured`` is read many times and should be cached.

    The least of some runs counts, which other work disturbs least. What is less than the spread of the empty job counts as
    that spread, so rules too cheap to tell apart cost the same.
    """
    empty = _seconds(measured, "n_words < 0")
    least = max(max(empty) - min(empty), 1e-6)
    return {
        rule.name: max(min(_seconds(measured, rule.rejects)) - min(empty), least)
        for rule in rules
    }


def ordered_rules(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejections per cost, both from the rows given, highest first.

    ``measured`` is a sample of ``SAMPLE_ROWS`` rows at most; it is cached meanwhile.
    Equal estimates keep the order given.
    """
    measured = measured.persist()
    try:
        rejected = [F.count_if(F.expr(rule.rejects)).alias(rule.name) for rule in rules]
        found = measured.agg(F.lit(0), *rejected).first()
        costs = rule_costs(measured, rules)
    finally:
        measured.unpersist()
    return sorted(rules, key=lambda rule: found[rule.name] / costs[rule.name], reverse=True)


def cascade(rules: list[Rule]) -> str:
    """SQL of the name of the first rule that rejects, NULL if none does."""
    cases = " ".join(f"WHEN {rule.rejects} THEN '{rule.name}'" for rule in rules)
    return f"CASE {cases} END"


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, measures, base_failed, kept, rejected_by.

    A null or empty text has no words and fails. ``rejected_by`` names the first
    rule of the cascade that rejects, in an order that depends on measured times;
    documents of one text get one verdict. No documents give no rows; columns other than doc_id and text are not read.
    """
    rows = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    sample = docs.sample(False, share, SAMPLE_SEED).limit(SAMPLE_ROWS)
    order = ordered_rules(measures(sample), rules)
    base = " OR ".join(f"({rule.rejects})" for rule in rules if rule.name in BASE_RULES)
    judged = measures(docs).selectExpr(
        "*", f"coalesce({base or 'false'}, false) AS base_failed", f"{cascade(order)} AS rejected_by"
    )
    return judged.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "rejected_by IS NULL AS kept", "rejected_by",
    )
