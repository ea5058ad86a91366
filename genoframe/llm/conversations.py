"""Repair of conversation structure: faults, and the cheapest edits that mend the turns.

Rows are range-partitioned and sorted by conversation and turn, so that a conversation
of any length spreads over as many tasks as its rows need. A task settles what lies
whole in it. The conversations at the two ends of a task, and such as outgrow the
memory of one, are open: their parts are stored, and small tables of one row per part
carry costs backward and states forward between them. Within a task and a part,
``viterbi`` works on chunks of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.llm import viterbi
from genoframe.llm.batches import returning_memory, small_batches
from genoframe.plans.shared import shared_path

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
NO_FAULT, BLANK, TRUNCATED = range(3)
# Bytes of a conversation that a task holds before it stores the rest as open.
HELD_BYTES = 32 << 20
# Marks of rows that have no choice of edits: deleted, and not there.
FORCED, GONE = 8, 9

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LONGS = pa.int64()
NAMES = {viterbi.USER: "user", viterbi.ASSISTANT: "assistant"}
LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[[viterbi.SYSTEM, viterbi.USER, viterbi.ASSISTANT], [viterbi.USER, viterbi.ASSISTANT, viterbi.USER]] = True


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as ``conv_id, turn, role, text, gone``, hurt by the hash of conversation and
    turn: of twenty parts one goes, one loses its text, one its ends of sentences, one
    comes twice, one is given to the user. Nulls read as one space, turns stay null.
    A dropped row is marked ``gone``, so its conversation stays known.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    part = F.crc32(key.cast("binary")) % 20
    hurt = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), part.alias("part"))
    text = (
        F.when(F.col("part") == 1, F.lit(""))
        .when(F.col("part") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.select(
        "conv_id", "turn",
        F.when(F.col("part") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("part") == 0).alias("gone"), F.explode(times).alias("copy"),
    ).drop("copy")


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows with what the edits depend on, in order. Rows of one turn are ordered by
    role and digest of the text; such as agree in all may go to several tasks."""
    gone = F.coalesce("gone", F.lit(False)) if "gone" in rows.columns else F.lit(False)
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    words = F.expr(f"rtrim('{SPACE}', text)")
    fault = (
        F.when(words == "", BLANK)
        .when(F.substring(words, -1, 1).isin(*ENDS), NO_FAULT)
        .otherwise(TRUNCATED)
    )
    initial = F.substring("role", 1, 1)
    kind = F.lit(viterbi.OTHER)
    for letter, code in (("s", viterbi.SYSTEM), ("u", viterbi.USER), ("a", viterbi.ASSISTANT)):
        kind = F.when(initial == letter, code).otherwise(kind)
    read = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone"))
    keyed = read.select(
        "conv_id", "turn", "role", "text", "gone",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        kind.cast("tinyint").alias("kind"), fault.cast("tinyint").alias("fault"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    order = ("conv_id", "turn", "role", "digest", "tie")
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")


def _changes(column: pa.Array) -> np.ndarray:
    """Places at which a sorted column takes another value; nulls are one value."""
    if len(column) < 2:
        return np.zeros(0, dtype=np.int64)
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return np.flatnonzero(~(same | (nulls[1:] & nulls[:-1]))) + 1


def _repeated(owner: np.ndarray, roles: pa.Array, digests: pa.Array) -> np.ndarray:
    """Whether the same role and text stand above in the same conversation."""
    role, digest = (c.dictionary_encode() for c in (roles, digests))
    key = owner * max(len(role.dictionary), 1) + role.indices.to_numpy(zero_copy_only=False)
    key = key * max(len(digest.dictionary), 1) + digest.indices.to_numpy(zero_copy_only=False)
    again = np.ones(len(key), dtype=bool)
    again[np.unique(key, return_index=True)[1]] = False
    return again


class Examined:
    """Conversations in a table of sorted rows: faults, edits and lines."""

    def __init__(self, table: pa.Table, offsets: np.ndarray):
        self.all_rows, self.offsets = table, offsets
        there = ~table["gone"].to_numpy()
        count = np.concatenate([[0], np.cumsum(there)])
        self.places = np.flatnonzero(there)
        self.starts = count[offsets]
        self.rows = table.filter(pa.array(there)).combine_chunks()
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.starts))
        self.kind, fault = (self.rows[n].to_numpy().astype(np.int64) for n in ("kind", "fault"))
        roles, digests = (_whole(self.rows[n]) for n in ("role", "digest"))
        self.blank = fault == BLANK
        self.duplicate = ~self.blank & _repeated(self.owner, roles, digests)
        self.truncated = ~self.blank & ~self.duplicate & (fault == TRUNCATED)
        self.free = ~self.blank & ~self.duplicate
        codes = 2 * self.kind + self.truncated
        free_starts = np.concatenate([[0], np.cumsum(self.free)])[self.starts]
        self.solution = viterbi.solve(codes[self.free], free_starts)
        self.op = np.full(len(codes), viterbi.D, dtype=np.int8)
        self.inserted, self.state = np.zeros((2, len(codes)), dtype=np.int64)
        self.op[self.free] = self.solution.op
        self.inserted[self.free] = self.solution.inserted
        self.state[self.free] = self.solution.state

    def per_conversation(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def counts(self) -> dict[str, np.ndarray]:
        """The numbers of the result, by conversation."""
        new_pair = np.zeros(len(self.kind), dtype=np.int64)
        pairs = np.flatnonzero(self.owner[1:] == self.owner[:-1]) + 1
        new_pair[pairs] = ~LEGAL[self.kind[pairs - 1], self.kind[pairs]]
        extra = viterbi.ENDING[self.solution.last]
        cost = self.per_conversation(row_costs(self.op, self.inserted, self.truncated))
        return {
            "gaps": self.gaps(),
            "blank": self.per_conversation(self.blank),
            "duplicate": self.per_conversation(self.duplicate),
            "truncated": self.per_conversation(self.truncated),
            "illegal": self.per_conversation(new_pair),
            "cost": cost + viterbi.INSERT * extra,
        }

    def gaps(self) -> np.ndarray:
        turns = self.rows["turn"].to_pylist()
        found = []
        for low, high in zip(self.starts[:-1], self.starts[1:]):
            known = {t for t in turns[low:high] if t is not None}
            found.append(max(known) - min(known) + 1 - len(known) if known else 0)
        return np.minimum(np.array(found, dtype=object), (1 << 63) - 1).astype(np.int64)

    def audits(self) -> list[str]:
        pieces = audit_pieces(self.op, self.inserted)
        extra = viterbi.ENDING[self.solution.last]
        bounds = zip(self.starts[:-1], self.starts[1:], extra)
        return ["".join(pieces[low:high]) + "I" * int(n) for low, high, n in bounds]

    def lines(self) -> list[list[tuple]]:
        """By conversation: (row of the table, place in it, edit, role, text)."""
        roles, texts = (self.rows[n].to_pylist() for n in ("role", "text"))
        by_conversation = []
        for c, (low, high) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            lines = []
            for i in range(low, high):
                place = int(self.places[i])
                for sub, edit, role in row_lines(self.op[i], self.inserted[i], self.state[i]):
                    kept = roles[i] if role is None else role
                    lines.append((place, sub, edit, kept, "" if edit == "I" else texts[i]))
            # Behind the last row of the conversation.
            for sub, edit, role in ending_lines(self.solution.last[c]):
                lines.append((int(self.offsets[c + 1]) - 1, sub, edit, role, ""))
            by_conversation.append(lines)
        return by_conversation


# Places of the lines of one row: insertions before it, itself, insertions behind the last.
ITSELF, BEHIND = 8, 16


def row_costs(op: np.ndarray, inserted: np.ndarray, truncated: np.ndarray) -> np.ndarray:
    edits = viterbi.DELETE * (op == viterbi.D) + viterbi.REROLE * (op == viterbi.R)
    left = viterbi.LEFT_TRUNCATED * (truncated & (op != viterbi.D))
    return edits + viterbi.INSERT * inserted.astype(np.int64) + left


def audit_pieces(op: np.ndarray, inserted: np.ndarray) -> list[str]:
    return ["I" * n + viterbi.OPS[k] for n, k in zip(inserted.tolist(), op.tolist())]


def row_lines(op: int, inserted: int, state: int) -> Iterator[tuple[int, str, str | None]]:
    """(place, edit, role) of the lines that a row gives; no role means its own."""
    for n in range(inserted):
        state = viterbi.NEXT_TURN[state]
        yield n, "I", NAMES[viterbi.USER if state == 2 else viterbi.ASSISTANT]
    if op == viterbi.K:
        yield ITSELF, "K", None
    elif op == viterbi.R:
        to = viterbi.NEXT_TURN[state]
        yield ITSELF, "R", NAMES[viterbi.USER if to == 2 else viterbi.ASSISTANT]


def ending_lines(state: int) -> Iterator[tuple[int, str, str]]:
    for n in range(viterbi.ENDING[state]):
        state = viterbi.NEXT_TURN[state]
        yield BEHIND + n, "I", NAMES[viterbi.USER if state == 2 else viterbi.ASSISTANT]


def _whole(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _digest(lines: list[tuple]) -> str:
    found = hashlib.sha256()
    for n, (_, _, _, role, text) in enumerate(lines):
        found.update(f"{chr(10) if n else ''}{role}:{text}".encode())
    return found.hexdigest()


OPEN_COLUMNS = ("turn", "role", "text", "gone", "digest", "kind", "fault")


def _settle(digests: bool, held_bytes: int, id_type: pa.DataType):
    """Task over sorted rows: results or lines of whole conversations, rows of open ones."""
    made = [(n, LONGS) for n in COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    fields = [
        ("conv_id", id_type), ("is_open", pa.bool_()), ("pid", pa.int32()), ("idx", LONGS),
        *(made if digests else [("sub", pa.int32()), ("edit", pa.string())]),
        ("turn", LONGS), ("role", pa.string()), ("text", pa.string()), ("gone", pa.bool_()),
        ("digest", pa.binary()), ("kind", pa.int8()), ("fault", pa.int8()),
    ]
    schema = pa.schema(fields)

    def filled(columns: dict[str, object], n: int) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            values = columns.get(field.name)
            if values is None:
                arrays.append(pa.nulls(n, field.type))
            elif isinstance(values, (pa.Array, pa.ChunkedArray)):
                values = _whole(values) if isinstance(values, pa.ChunkedArray) else values
                arrays.append(values.cast(field.type))
            else:
                arrays.append(pa.array(values, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def open_rows(table: pa.Table, pid: int, first: int) -> pa.RecordBatch:
        n = table.num_rows
        columns = {name: table[name] for name in ("conv_id", *OPEN_COLUMNS)}
        columns |= {"is_open": [True] * n, "pid": [pid] * n, "idx": np.arange(first, first + n)}
        return filled(columns, n)

    def settled(table: pa.Table, offsets: np.ndarray, pid: int, first: int) -> pa.RecordBatch:
        found = Examined(table, offsets)
        ids = _whole(table["conv_id"])
        if digests:
            columns: dict[str, object] = found.counts()
            columns |= {
                "conv_id": ids.take(pa.array(offsets[:-1])),
                "audit": found.audits(),
                "repaired_sha256": [_digest(lines) for lines in found.lines()],
            }
            n = len(offsets) - 1
        else:
            lines = [line for lines in found.lines() for line in lines]
            place, sub, edit, role, text = zip(*lines) if lines else [()] * 5
            place = np.array(place, dtype=np.int64)
            columns = {
                "conv_id": ids.take(pa.array(place)), "idx": first + place,
                "sub": sub, "edit": edit, "role": role, "text": text,
            }
            n = len(lines)
            columns["pid"] = [pid] * n
        columns["is_open"] = [False] * n
        return filled(columns, n)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        # Rows of the conversation that may go on, and their place. The first one of a
        # task may have begun in another: it is open.
        held: list[pa.Table] = []
        held_first = at = 0
        current, is_open = None, True
        for batch in batches:
            table = pa.Table.from_batches([batch])
            n = table.num_rows
            if not n:
                continue
            ids = _whole(table["conv_id"])
            bounds = np.concatenate([[0], _changes(ids), [n]]).astype(np.int64)
            done, last = 0, int(bounds[-2])
            goes_on = at == 0 or ids[0].as_py() == current
            if goes_on and is_open:
                done = int(bounds[1])
                yield open_rows(table.slice(0, done), pid, at)
            if goes_on and last == 0:
                held += [] if is_open else [table]
            else:
                whole = pa.concat_tables([*held, table.slice(done, last - done)])
                if whole.num_rows:
                    marks = [0], _changes(_whole(whole["conv_id"])), [whole.num_rows]
                    yield settled(whole, np.concatenate(marks).astype(np.int64), pid, held_first if held else at + done)
                held, held_first, is_open = [table.slice(last)], at + last, False
            current = ids[n - 1].as_py()
            at += n
            if not is_open and sum(part.nbytes for part in held) > held_bytes:
                yield open_rows(pa.concat_tables(held), pid, held_first)
                held, is_open = [], True
        if held:
            yield open_rows(pa.concat_tables(held), pid, held_first)

    return task, schema


def _sql_schema(schema: pa.Schema, conv_id: str) -> str:
    names = {pa.bool_(): "boolean", pa.int32(): "int", LONGS: "bigint", pa.string(): "string",
             pa.binary(): "binary", pa.int8(): "tinyint"}
    return ", ".join(
        f"{f.name} {conv_id if f.name == 'conv_id' else names[f.type]}" for f in schema
    )


def _stored(rows: DataFrame, name: str) -> DataFrame:
    folder = shared_path(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _examined(conversations: DataFrame, digests: bool, held_bytes: int) -> DataFrame:
    """Results or lines of settled conversations and the rows of open ones, stored."""
    small_batches(conversations.sparkSession)
    rows = _sorted_rows(conversations)
    empty = conversations.sparkSession.createDataFrame([], rows.select("conv_id").schema)
    task, schema = _settle(digests, held_bytes, empty.toArrow().schema.field("conv_id").type)
    conv_id = conversations.schema["conv_id"].dataType.simpleString()
    return _stored(rows.mapInArrow(returning_memory(task), _sql_schema(schema, conv_id)), "turns")


PART = (
    "pid int, base bigint, codes binary, steps array<bigint>, n_turns bigint, first_turn bigint, "
    "last_turn bigint, first_kind int, last_kind int, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint"
)
BLANK_ROW = 10


def _part(table: pa.Table) -> pa.Table:
    """One row for the rows of an open conversation in one task."""
    table = table.sort_by("idx").combine_chunks()
    code, kind = (table[n].to_numpy().astype(np.int64) for n in ("code", "kind"))
    there = code != GONE
    kinds = kind[there]
    turns = [t for t in table["turn"].filter(pa.array(there)).to_pylist() if t is not None]
    columns = {
        "pid": table["pid"][0].as_py(),
        "base": table["idx"][0].as_py(),
        "codes": code.astype(np.uint8).tobytes(),
        "steps": viterbi.transfer(code[code < FORCED]).ravel().tolist(),
        "n_turns": len(set(turns)),
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "first_kind": int(kinds[0]) if len(kinds) else None,
        "last_kind": int(kinds[-1]) if len(kinds) else None,
        "blank": int((code == BLANK_ROW).sum()),
        "duplicate": int((code == FORCED).sum()),
        "truncated": int(((code < FORCED) & (code % 2 == 1)).sum()),
        "illegal": int((~LEGAL[kinds[:-1], kinds[1:]]).sum()),
    }
    kinds_of = {"pid": pa.int32(), "codes": pa.binary(), "steps": pa.list_(LONGS),
                "first_kind": pa.int32(), "last_kind": pa.int32()}
    arrays = {n: pa.array([v], kinds_of.get(n, LONGS)) for n, v in columns.items()}
    return pa.table({"conv_id": table["conv_id"][:1]} | arrays)


def _backward(table: pa.Table) -> pa.Table:
    """Costs behind each part of a conversation, from the last to the first."""
    table = table.sort_by("pid")
    vector, ends = viterbi.END, []
    for steps in reversed(table["steps"].to_pylist()):
        ends.append(vector.tolist())
        vector = (np.array(steps).reshape(viterbi.STATES, -1) + vector).min(axis=1)
        vector = np.minimum(vector - vector.min(), viterbi.FAR)
    n = len(ends)
    first = (table["pid"][0].as_py() << 32) + table["base"][0].as_py()
    return pa.table(
        {
            "pid": table["pid"], "base": table["base"], "conv_no": pa.array([first] * n, LONGS),
            "ends": pa.array(ends[::-1], pa.list_(LONGS)),
            "is_last": pa.array([i == n - 1 for i in range(n)]),
        }
    )


def _forward(table: pa.Table) -> pa.Table:
    """State before each part of a conversation."""
    table = table.sort_by("pid")
    state, entries = 0, []
    for out in table["exits"].to_pylist():
        entries.append(state)
        state = out[state]
    return pa.table({"pid": table["pid"], "base": table["base"], "entry": pa.array(entries, pa.int32())})


def _codes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.uint8).astype(np.int64)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for packed, end in zip(batch["codes"].to_pylist(), batch["ends"].to_pylist()):
            codes = _codes(packed)
            found.append(viterbi.exits(codes[codes < FORCED], np.array(end)).tolist())
        columns = {name: batch[name] for name in ("conv_no", "pid", "base")}
        yield pa.RecordBatch.from_pydict(columns | {"exits": pa.array(found, pa.list_(pa.int32()))})


def _traced(row: dict) -> tuple[np.ndarray, ...]:
    """Codes, edits, insertions and states of all rows of a part, and the last state."""
    codes = _codes(row["codes"])
    free = codes < FORCED
    found = viterbi.solve(
        codes[free], np.array([0, free.sum()]), np.array([row["ends"]]), np.array([row["entry"]])
    )
    op = np.full(len(codes), viterbi.D, dtype=np.int8)
    inserted, state = np.zeros((2, len(codes)), dtype=np.int64)
    op[free], inserted[free], state[free] = found.op, found.inserted, found.state
    return codes, op, inserted, state, int(found.last[0])


def _part_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of each part."""
    for batch in batches:
        costs, audits = [], []
        for row in batch.select(["codes", "ends", "entry", "is_last"]).to_pylist():
            codes, op, inserted, _, last = _traced(row)
            there = codes != GONE
            op, inserted = op[there], inserted[there]
            truncated = (codes[there] < FORCED) & (codes[there] % 2 == 1)
            extra = int(viterbi.ENDING[last]) if row["is_last"] else 0
            costs.append(int(row_costs(op, inserted, truncated).sum()) + viterbi.INSERT * extra)
            audits.append("".join(audit_pieces(op, inserted)) + "I" * extra)
        kept = [n for n in batch.schema.names if n not in ("base", "codes", "ends", "entry", "is_last")]
        yield pa.RecordBatch.from_pydict(
            {n: batch[n] for n in kept}
            | {"cost": pa.array(costs, LONGS), "audit": pa.array(audits, pa.string())}
        )


def _part_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each part without their texts; no role means that of the row."""
    for batch in batches:
        for row in batch.select(["conv_no", "pid", "base", "codes", "ends", "entry", "is_last"]).to_pylist():
            _, op, inserted, state, last = _traced(row)
            lines = [
                (row["base"] + int(i), *line)
                for i in np.flatnonzero((op != viterbi.D) | (inserted > 0))
                for line in row_lines(op[i], inserted[i], state[i])
            ]
            if row["is_last"]:
                lines += [(row["base"] + len(op) - 1, *line) for line in ending_lines(last)]
            idx, sub, edit, role = zip(*lines) if lines else [()] * 4
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_no": pa.array([row["conv_no"]] * len(lines), LONGS),
                    "pid": pa.array([row["pid"]] * len(lines), pa.int32()),
                    "idx": pa.array(idx, LONGS), "sub": pa.array(sub, pa.int32()),
                    "edit": pa.array(edit, pa.string()), "new_role": pa.array(role, pa.string()),
                }
            )


def _total(table: pa.Table) -> pa.Table:
    """The result of a conversation from its parts."""
    parts = table.sort_by("pid").to_pylist()
    total = {n: sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated", "illegal", "cost")}
    kinds = [(p["first_kind"], p["last_kind"]) for p in parts if p["first_kind"] is not None]
    total["illegal"] += sum(not LEGAL[a[1], b[0]] for a, b in zip(kinds, kinds[1:]))
    turns = [(p["first_turn"], p["last_turn"], p["n_turns"]) for p in parts if p["n_turns"]]
    total["gaps"] = 0
    if turns:
        distinct = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
        total["gaps"] = min(turns[-1][1] - turns[0][0] + 1 - distinct, (1 << 63) - 1)
    columns = {n: pa.array([int(total[n])], LONGS) for n in COUNTS}
    audit = pa.array(["".join(p["audit"] for p in parts)], pa.string())
    return pa.table({"conv_id": table["conv_id"][:1], "conv_no": table["conv_no"][:1], **columns, "audit": audit})


def _line_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted lines of each conversation, line by line: a digest over a
    text is made in its order, so a conversation has one task here, which keeps nothing."""
    current, found = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"conv_no": pa.array([current], LONGS), "repaired_sha256": pa.array([found.hexdigest()])}
        )

    for batch in batches:
        for conv_no, role, text in zip(*(batch[n].to_pylist() for n in ("conv_no", "role", "text"))):
            if conv_no != current:
                if found is not None:
                    yield row()
                current, found = conv_no, hashlib.sha256()
            else:
                found.update(b"\n")
            found.update(f"{role}:{text}".encode())
    if found is not None:
        yield row()


class _Open:
    """What follows for the conversations that no task has whole."""

    def __init__(self, examined: DataFrame, conv_id: str):
        self.rows, self.conv_id = examined.where("is_open"), conv_id
        seen = self.rows.where(~F.col("gone") & (F.col("fault") != BLANK))
        firsts = seen.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("pid", "idx")).alias("first"))
        firsts = firsts.select("first.pid", "first.idx", F.lit(True).alias("is_first"))
        code = (
            F.when(F.col("gone"), GONE).when(F.col("fault") == BLANK, BLANK_ROW)
            .when(F.col("is_first").isNull(), FORCED)
            .otherwise(2 * F.col("kind") + F.when(F.col("fault") == TRUNCATED, 1).otherwise(0))
        )
        coded = self.rows.select("conv_id", "pid", "idx", "turn", "kind", "fault", "gone").join(
            firsts, ["pid", "idx"], "left"
        )
        coded = coded.select("conv_id", "pid", "idx", "turn", "kind", code.cast("int").alias("code"))
        parts = coded.groupBy("conv_id", "pid").applyInArrow(_part, f"conv_id {conv_id}, {PART}")
        parts = _stored(parts, "parts")
        narrow = parts.select("conv_id", "pid", "base", "steps")
        ends = narrow.groupBy("conv_id").applyInArrow(
            _backward, "pid int, base bigint, conv_no bigint, ends array<bigint>, is_last boolean"
        )
        self.ended = parts.drop("steps").join(ends, ["pid", "base"])
        exits = self.ended.select("conv_no", "pid", "base", "codes", "ends").mapInArrow(
            _exits, "conv_no bigint, pid int, base bigint, exits array<int>"
        )
        entries = exits.groupBy("conv_no").applyInArrow(_forward, "pid int, base bigint, entry int")
        self.known = _stored(self.ended.join(entries, ["pid", "base"]), "entered")

    def lines(self) -> DataFrame:
        """conv_no, conv_id, pid, idx, sub, edit, role, text of all lines."""
        lines = self.known.mapInArrow(
            _part_lines, "conv_no bigint, pid int, idx bigint, sub int, edit string, new_role string"
        )
        rows = self.rows.select("conv_id", "pid", "idx", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
        joined = lines.join(rows, ["pid", "idx"])
        return joined.select(
            "conv_no", "conv_id", "pid", "idx", "sub", "edit",
            F.coalesce("new_role", "old_role").alias("role"),
            F.when(F.col("edit") == "I", "").otherwise(F.col("old_text")).alias("text"),
        )

    def results(self) -> DataFrame:
        carried = [f for f in self.known.schema.fields if f.name not in ("base", "codes", "ends", "entry", "is_last")]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
        edits = self.known.mapInArrow(_part_edits, f"{schema}, cost bigint, audit string")
        counts = ", ".join(f"{n} bigint" for n in COUNTS)
        totals = edits.groupBy("conv_no").applyInArrow(
            _total, f"conv_id {self.conv_id}, conv_no bigint, {counts}, audit string"
        )
        lines = self.lines().repartition("conv_no").sortWithinPartitions("conv_no", "pid", "idx", "sub")
        digests = lines.select("conv_no", "role", "text").mapInArrow(
            _line_digests, "conv_no bigint, repaired_sha256 string"
        )
        nothing = F.lit(hashlib.sha256().hexdigest())
        joined = totals.join(digests, "conv_no", "left")
        return joined.select(
            "conv_id", *COUNTS, "audit", F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
        )


def repair_digests(conversations: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per conversation: gaps, faults, cost and letters of the cheapest edits, and
    the SHA-256 of the repaired ``role:text`` lines.

    Rows are taken by turn, nulls first; rows of one turn by role and digest of the text.
    Null role and text read as one space, null conversation ids are one conversation, and
    rows marked ``gone`` (a column that may be missing) count for nothing but for the
    existence of their conversation. Conversations without rows have zeros, no letters
    and the digest of nothing. Other columns are not read. No rows give no rows.
    ``audit`` has a letter per edit, which Spark holds up to 2 GB for one conversation.
    """
    examined = _examined(conversations, True, held_bytes)
    result = ("conv_id", *COUNTS, "audit", "repaired_sha256")
    conv_id = conversations.schema["conv_id"].dataType.simpleString()
    return examined.where("NOT is_open").select(*result).union(_Open(examined, conv_id).results())


def repaired_turns(conversations: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The repaired conversations: conv_id, pid, idx, sub, edit, role, text.

    ``pid, idx, sub`` is the order of the lines of a conversation; ``edit`` is K for a
    turn that was kept, R for one with another role, I for an inserted one without text.
    Deleted turns are absent. Rows as in ``repair_digests``.
    """
    examined = _examined(conversations, False, held_bytes)
    names = ("conv_id", "pid", "idx", "sub", "edit", "role", "text")
    conv_id = conversations.schema["conv_id"].dataType.simpleString()
    lines = _Open(examined, conv_id).lines().select(*names)
    return examined.where("NOT is_open").select(*names).union(lines)
