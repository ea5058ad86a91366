"""Cheapest edits that give a conversation legal turns, by parallel Viterbi in numpy.

Legal role initials are ``(s?(ua)+)?``. Costs to the end are min-plus products of one
small matrix per row. Rows stand in chunks that all step back together, each from a
speculative vector of costs; fix-up passes run chunks again from the vector that the
next chunk has found, until what they find differs only by a constant from what they
had. The moves that such vectors allow do not depend on the constant, so they are
stitched as they are, and the least string of edits is traced forward.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Role initials by code; rows with another one cannot be kept as they are.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
# States: at the start, behind a system, a user and an assistant turn.
STATES = 4
NEXT_TURN = np.array([2, 2, 3, 2])
KEPT_TO = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
# Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
FAR = 1 << 40
SHORTEST_CHUNK, LONGEST_CHUNK = 32, 1024

# Edits in the order of their letters, D, I, K and R.
OPS = "DIKR"
D, I, K, R = range(4)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product over the last axis of ``a`` and the second to last of ``b``."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _insertions() -> np.ndarray:
    """Costs of reaching a state by insertions alone."""
    table = np.full((STATES, STATES), FAR)
    for state in range(STATES):
        at = state
        for n in range(STATES):
            table[state, at] = min(table[state, at], INSERT * n)
            at = NEXT_TURN[at]
    return table


def _edits() -> np.ndarray:
    """Costs of D, K and R by code of the row and state; ``FAR`` where not allowed."""
    table = np.full((8, 4, STATES), FAR)
    for kind in range(4):
        for truncated in range(2):
            left = LEFT_TRUNCATED * truncated
            edits = table[2 * kind + truncated]
            edits[D], edits[R] = DELETE, REROLE + left
            edits[K, KEPT_TO[:, kind] >= 0] = left
    return table


EDITS = _edits()
# State behind each edit, by kind of the row; what cannot be kept stays where it is.
STAYS = np.arange(STATES)
BEHIND = np.array([[STAYS, NEXT_TURN, np.where(k >= 0, k, STAYS), NEXT_TURN] for k in KEPT_TO.T])


def _steps() -> np.ndarray:
    """Costs from state to state over one row and the insertions before it."""
    table = np.full((8, STATES, STATES), FAR)
    for code in range(8):
        for op in (D, K, R):
            for state in range(STATES):
                to = BEHIND[code // 2, op, state]
                table[code, state, to] = min(table[code, state, to], EDITS[code, op, state])
    return _times(_insertions(), table)


STEPS = _steps()
# Costs at the end of a conversation: insertions up to a legal end.
END = np.minimum(_insertions()[:, 0], _insertions()[:, 3])
ENDING = END // INSERT


@dataclass(frozen=True)
class Chunks:
    """Runs of rows, none empty; ``follows`` says that the next one continues it."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    follows: np.ndarray


def chunked(offsets: np.ndarray, size: int | None = None) -> Chunks:
    """Cut each conversation, which are ranges of rows, into chunks."""
    lengths = np.diff(offsets)
    if size is None:
        longest = int(lengths.max(initial=0))
        size = min(max(int(np.sqrt(longest)), SHORTEST_CHUNK), LONGEST_CHUNK)
    n = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[:-1][owner] + place * size
    return Chunks(starts, np.minimum(starts + size, offsets[1:][owner]), owner, place + 1 < n[owner])


def backward(codes: np.ndarray, chunks: Chunks, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Costs to the end before each row and at the end of each chunk, less their least.

    ``ends`` are the costs behind each conversation. Also returns how many fix-up
    passes there were.
    """
    costs = np.zeros((len(codes), STATES), dtype=np.int64)
    used = np.where(chunks.follows[:, None], END, ends[chunks.owner])
    used = used - used.min(axis=1, keepdims=True)

    def run(which: np.ndarray, fix_up: bool) -> None:
        vector, at, first = used[which], chunks.ends[which] - 1, chunks.starts[which]
        while len(at):
            vector = (STEPS[codes[at]] + vector[:, None, :]).min(axis=2)
            vector -= vector.min(axis=1, keepdims=True)
            going = at > first
            if fix_up:
                going &= (vector != costs[at]).any(axis=1)
            costs[at] = vector
            vector, at, first = vector[going], at[going] - 1, first[going]

    run(np.arange(len(chunks.starts)), False)
    before = np.flatnonzero(chunks.follows)
    passes = 0
    while True:
        found = costs[chunks.starts[before + 1]]
        wrong = (found != used[before]).any(axis=1)
        if not wrong.any():
            return costs, used, passes
        used[before[wrong]] = found[wrong]
        run(before[wrong], True)
        passes += 1


def transfer(codes: np.ndarray) -> np.ndarray:
    """Costs from state to state over all rows: the product of their matrices, halved
    and halved again."""
    tables = STEPS[codes]
    if not len(tables):
        return np.where(np.eye(STATES, dtype=bool), 0, FAR)
    while len(tables) > 1:
        odd = tables[len(tables) - 1 :] if len(tables) % 2 else tables[:0]
        even = len(tables) - len(odd)
        tables = np.concatenate([_times(tables[0:even:2], tables[1:even:2]), odd])
    return tables[0]


@dataclass(frozen=True)
class Moves:
    """For each row and state: insertions before the row, its edit, the state behind."""

    inserted: np.ndarray
    op: np.ndarray
    to: np.ndarray


def least_moves(codes: np.ndarray, costs: np.ndarray, chunks: Chunks, used: np.ndarray) -> Moves:
    """The cheapest move with the least letter, from each state before each row."""
    behind = np.empty_like(costs)
    if len(costs):
        behind[:-1] = costs[1:]
        behind[chunks.ends - 1] = used
    best = (STEPS[codes] + behind[:, None, :]).min(axis=2)
    rows = np.arange(len(codes))[:, None]
    op = np.full(best.shape, R, dtype=np.int8)
    for name in (K, I, D):
        to = BEHIND[codes // 2, name]
        if name == I:
            cost = INSERT + best[rows, to]
        else:
            cost = EDITS[codes, name] + behind[rows, to]
        op[cost == best] = name
    inserted = np.zeros(best.shape, dtype=np.int8)
    state = np.broadcast_to(STAYS, best.shape).copy()
    for _ in range(STATES):
        more = op[rows, state] == I
        inserted += more
        state = np.where(more, NEXT_TURN[state], state)
    edit = op[rows, state]
    return Moves(inserted, edit, BEHIND[(codes // 2)[:, None], edit, state].astype(np.int8))


def trace(moves: Moves, chunks: Chunks, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State before each row, and behind each conversation, from their first states.

    All chunks step together from all states; where each of them is entered follows
    chunk by chunk, and then all step once more.
    """
    exits = np.broadcast_to(STAYS, (len(chunks.starts), STATES)).copy()
    lengths = chunks.ends - chunks.starts
    for step in range(int(lengths.max(initial=0))):
        going = np.flatnonzero(lengths > step)
        at = chunks.starts[going] + step
        exits[going] = moves.to[at[:, None], exits[going]]
    into = np.zeros(len(chunks.starts), dtype=np.int64)
    last = entry.astype(np.int64)
    heads = np.flatnonzero(np.diff(chunks.owner, prepend=-1))
    while len(heads):
        into[heads] = last[chunks.owner[heads]]
        last[chunks.owner[heads]] = exits[heads, into[heads]]
        heads = heads[chunks.follows[heads]] + 1
    state = np.zeros(len(moves.op), dtype=np.int64)
    for step in range(int(lengths.max(initial=0))):
        going = np.flatnonzero(lengths > step)
        at = chunks.starts[going] + step
        state[at] = into[going]
        into[going] = moves.to[at, into[going]]
    return state, last


@dataclass(frozen=True)
class Solution:
    """By free row: insertions before it, edit, state before it. By conversation: state
    behind its rows."""

    inserted: np.ndarray
    op: np.ndarray
    state: np.ndarray
    last: np.ndarray
    passes: int


def solve(
    codes: np.ndarray,
    offsets: np.ndarray,
    ends: np.ndarray | None = None,
    entry: np.ndarray | None = None,
    size: int | None = None,
) -> Solution:
    """Least edits of conversations, each a range of ``codes`` (2 * kind + truncated)."""
    conversations = len(offsets) - 1
    ends = np.broadcast_to(END, (conversations, STATES)) if ends is None else ends
    entry = np.zeros(conversations, dtype=np.int64) if entry is None else entry
    chunks = chunked(offsets, size)
    costs, used, passes = backward(codes, chunks, ends)
    moves = least_moves(codes, costs, chunks, used)
    state, last = trace(moves, chunks, entry)
    rows = np.arange(len(codes))
    return Solution(moves.inserted[rows, state], moves.op[rows, state], state, last, passes)


def exits(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """State behind the rows of one conversation part, from each first state."""
    offsets = np.array([0, len(codes)])
    chunks = chunked(offsets)
    costs, used, _ = backward(codes, chunks, end[None, :])
    moves = least_moves(codes, costs, chunks, used)
    return np.array([trace(moves, chunks, np.array([s]))[1][0] for s in range(STATES)])
