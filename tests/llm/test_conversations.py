"""Repaired conversations against a plain search, one conversation at a time."""

import hashlib
import random
import re
import zlib

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from genoframe.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORD = r"[^\x20\x09-\x0D]"


def hurt(rows):
    """Rows by conversation after damage; each original conversation is there."""
    found = {}
    for conv_id, turn, role, text in rows:
        mine = found.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        shown = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        part = zlib.crc32(shown.encode()) % 20
        if part == 0:
            continue
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        mine += [(turn, "user" if part == 4 else role, text)] * (2 if part == 3 else 1)
    return found


def ahead(state, initial):
    return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)


def cheapest(rows):
    """(cost, letters, lines) for rows of (role, text, forced, truncated): all states forward."""
    best = {"": (0, "", ())}

    def insert(table):
        for _ in range(3):
            for state, (cost, letters, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    to = ahead(state, role[0])
                    new = (cost + 5, letters + "I", (*lines, f"{role}:"))
                    if to is not None and (to not in table or new[:2] < table[to][:2]):
                        table[to] = new
        return table

    for role, text, forced, truncated in rows:
        after = {}

        def offer(state, new):
            if state is not None and (state not in after or new[:2] < after[state][:2]):
                after[state] = new

        for state, (cost, letters, lines) in insert(dict(best)).items():
            offer(state, (cost + 2, letters + "D", lines))
            if not forced:
                left = 5 * truncated
                offer(ahead(state, role[:1]), (cost + left, letters + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    offer(ahead(state, new[0]), (cost + 1 + left, letters + "R", (*lines, f"{new}:{text}")))
        best = after
    best = insert(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def expected(rows):
    result = []
    for conv_id, mine in hurt(rows).items():
        mine.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        blank = duplicate = truncated = illegal = 0
        for i, (_, role, text) in enumerate(mine):
            words = re.findall(WORD, text)
            if not words:
                kind = "blank"
            elif (role, text) in seen:
                kind = "duplicate"
            else:
                kind = "" if words[-1] in ".!?" else "truncated"
            seen.add((role, text))
            blank, duplicate, truncated = (
                n + (kind == name) for n, name in ((blank, "blank"), (duplicate, "duplicate"), (truncated, "truncated"))
            )
            marked.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
            illegal += i > 0 and mine[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, letters, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result.append((conv_id, gaps, blank, duplicate, truncated, illegal, cost, letters, digest))
    return sorted(result, key=repr)


ROLES = ["user", "assistant", "user", "assistant", "user", "assistant", "system", "tool", None, "", "a", "User"]
TEXTS = ["Yes.", "No!", "Why?", "it goes on", " \t", "", None, "Ends. ", "é…", "Tab.\t\n", "　", "x" * 50 + "."]


def random_rows(n, seed, length=12):
    pick = random.Random(seed)
    rows = []
    for conv_id in range(n):
        for turn in range(pick.randrange(length)):
            text = pick.choice(TEXTS) if pick.random() < 0.5 else f"Turn {pick.random()}."
            role = pick.choice(ROLES) if pick.random() < 0.4 else ("user", "assistant")[turn % 2]
            shown = None if pick.random() < 0.03 else turn if pick.random() < 0.95 else pick.randrange(9)
            rows.append((conv_id, shown, role, text))
    return rows


def digests(spark, rows, held_bytes=conversations.HELD_BYTES, columns=()):
    table = spark.createDataFrame(rows, SCHEMA).select("*", *columns)
    return rows_of(conversations.repair_digests(conversations.damaged(table), held_bytes))


@pytest.mark.parametrize("held_bytes", [1, conversations.HELD_BYTES])
def test_digests(spark, held_bytes):
    rows = random_rows(250, 3)
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (-5, -(1 << 40), "user", "Ah."), (-5, 1 << 40, "assistant", "Oh.")]
    # Repeated rows, in one turn and in others.
    rows += [(900, 1, "user", "Same.")] * 7 + [(900, t, "user", "Same.") for t in range(30)]
    extra = [F.lit(i).alias(n) for i, n in enumerate(("pid", "idx", "gone", "kind", "digest", "is_open", "code"))]
    assert digests(spark, rows, held_bytes, extra) == expected(rows)


def test_one_conversation_holds_most_rows(spark):
    """It spreads over all partitions; some of them hold deleted rows alone."""
    pick = random.Random(5)
    rows = random_rows(30, 4)
    for turn in range(3000):
        text = "" if 700 < turn < 2100 else f"Turn {turn}" + pick.choice([".", ".", ".", ""])
        rows.append((1000, turn, pick.choice(["user", "assistant", "assistant", "tool"]), text))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert digests(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dropped_conversations(spark):
    """Conversations whose rows all go."""
    gone = [(i, t) for i in range(400) for t in range(3) if zlib.crc32(f"{i}:{t}".encode()) % 20 == 0]
    rows = [(i, t, "user", "Hello.") for i, t in gone[:9]]
    nothing = hashlib.sha256().hexdigest()
    assert digests(spark, rows) == sorted(
        ((i, 0, 0, 0, 0, 0, 0, "", nothing) for i in {i for i, _ in gone[:9]}), key=repr
    )
    assert digests(spark, []) == []


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 1_000_000 + "."), (1, 1, "assistant", "x" * 4_000_000), (2, 0, "user", " " * 3_000_000)]
    assert digests(spark, rows) == expected(rows)


@pytest.mark.parametrize("held_bytes", [1, conversations.HELD_BYTES])
def test_turns(spark, held_bytes):
    """The repaired turns are those that the digests are made of."""
    rows = random_rows(80, 8)
    table = conversations.damaged(spark.createDataFrame(rows, SCHEMA))
    lines = conversations.repaired_turns(table, held_bytes).orderBy("conv_id", "pid", "idx", "sub").collect()
    by_id = {}
    for line in lines:
        by_id.setdefault(line["conv_id"], []).append(line)
        assert line["edit"] in "KRI"
    for conv_id, *_, audit, digest in expected(rows):
        mine = by_id.get(conv_id, [])
        assert "".join(r["edit"] for r in mine) == audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == digest


def test_text_ids(spark):
    rows = [("é", 0, "user", "Hi."), ("b", 0, "user", "Hi."), (None, 0, "user", "Hi.")]
    table = spark.createDataFrame(rows, SCHEMA.replace("conv_id bigint", "conv_id string"))
    found = conversations.repair_digests(table).collect()
    assert {r["conv_id"] for r in found} == {"é", "b", None}
    assert {r["audit"] for r in found} == {"D"}
