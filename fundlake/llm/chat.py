"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn, then user and
assistant in turn, beginning with a user and ending with an assistant. Turns
can be kept, merged with the turn before (``MERGE``), relabelled (``RELABEL``; a
missing or unknown role costs ``UNKNOWN``), and empty turns can be put between
(``INSERT`` each). Dynamic programming over the automaton's states finds the
cheapest repair; of equal ones, that whose last turns come first in the order
system, user, assistant.

A step of the program is a product of (min, +) matrices, which may be bracketed
at will. A conversation is cut into parts by turn number, and where many rows
share a number or have none, after every ``PART_ROWS`` rows; each part's matrix is
computed where its turns are, the short chain of matrices of a conversation
gives the state at each cut, and each part is then traced back and rendered by
itself. So a conversation of any length is spread over many tasks, and the
rendered parts of a conversation, joined in order, are its text.

Edge cases: rows alike in conversation, turn, role and text are one turn, but
where conversation or turn number is null each row is a turn of its own. Other
turns of equal number stand in the order of role, then text, missing ones
first. A null turn number comes last. A null text is empty. A null conv_id is a
conversation of its own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.scratch import Scratch

MERGE, RELABEL, UNKNOWN, INSERT = 1, 2, 1, 3
#: Turn numbers of one part, and its rows at most.
PART, PART_ROWS = 256, 1024
ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 40
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _inserted(state: int, goal: int) -> list[int] | None:
    """The fewest empty turns after which goal may follow state; None if it never may."""
    paths = [[state]]
    for _ in range(4):
        for p in paths:
            if goal in _NEXT[p[-1]]:
                return p[1:]
        paths = [[*p, n] for p in paths for n in _NEXT[p[-1]]]
    return None


#: Empty turns between two states, by (from, to); and those needed to end.
BETWEEN = {(s, g): _inserted(s, g) for s in range(4) for g in (SYSTEM, USER, ASSISTANT)}
ENDING = {START: [], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}


def _step(state: int, label: int) -> tuple[int, str]:
    """Cost and kind of going from state to a turn of this label."""
    way = BETWEEN[state, label]
    costs = [(len(way) * INSERT, "follow")] if way is not None else []
    if state == label:
        costs.append((MERGE, "merge"))
    return min(costs, default=(_FAR, "never"))


_STEPS = {(s, g): _step(s, g) for s in range(4) for g in (SYSTEM, USER, ASSISTANT)}


def _labels(role: str | None) -> list[int]:
    """Cost of each label for a turn of this role."""
    return [_FAR] + [0 if role == r else (RELABEL if role in ROLES else UNKNOWN) for r in ROLES]


def _matrix_of(role: str | None) -> np.ndarray:
    cost = _labels(role)
    return np.array([[min(_FAR, _STEPS[s, g][0] + cost[g]) if g else _FAR for g in range(4)] for s in range(4)], dtype=np.int64)


_MATRICES = {r: _matrix_of(r) for r in (*ROLES, None)}


def _matrix(role: str | None) -> np.ndarray:
    return _MATRICES[role if role in ROLES else None]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of (min, +) matrices."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


def product(roles: list[str | None]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int64)
    for r in roles:
        out = times(out, _matrix(r))
    return out


def trace(matrices: list[np.ndarray], start: int, end: int) -> list[int]:
    """States after each matrix on the cheapest way from start to end."""
    costs = [np.where(np.arange(4) == start, 0, _FAR)]
    for m in matrices:
        costs.append(np.minimum((costs[-1][:, None] + m).min(axis=0), _FAR))
    path = [end]
    for m, before in zip(reversed(matrices), reversed(costs[:-1]), strict=True):
        path.append(int((before + m[:, path[-1]]).argmin()))
    return path[-2::-1] if len(path) > 1 else []


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at both ends of each part of a conversation, and whether it is the last."""
    for batch in batches:
        rows = []
        for conv, parts in zip(batch["conv_id"].to_pylist(), batch["parts"].to_pylist(), strict=True):  # parts in order
            matrices = [np.array(p["m"], dtype=np.int64).reshape(4, 4) for p in parts]
            whole = np.where(np.arange(4) == START, 0, _FAR)
            for m in matrices:
                whole = np.minimum((whole[:, None] + m).min(axis=0), _FAR)
            cost = [int(c) + INSERT * len(ENDING[s]) for s, c in enumerate(whole)]
            states = trace(matrices, START, int(np.argmin(cost)))
            for i, p in enumerate(parts):
                rows.append((conv, p["turns_part"], p["cut"], i, states[i - 1] if i else START, states[i], i == len(parts) - 1, min(cost)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["c", "tp", "ct", "part", "begin", "finish", "last", "cost"])


def repair(turns: list[tuple[str | None, str | None]], begin: int, finish: int, last: bool) -> tuple[list[tuple[str, str, str]], dict[str, int]]:
    """(role, text, what was done) of each turn of a part, and how often each was done."""
    out, state = [], begin
    done = {"kept": 0, "merged": 0, "relabeled": 0, "inserted": 0}
    for (role, text), label in zip(turns, trace([_matrix(r) for r, _ in turns], begin, finish), strict=True):
        kind = _STEPS[state, label][1]
        for empty in BETWEEN[state, label] if kind == "follow" else ():
            out.append((ROLES[empty - 1], "", "insert"))
            done["inserted"] += 1
        same = role == ROLES[label - 1]
        done["merged" if kind == "merge" else "kept"] += 1
        done["relabeled"] += not same
        out.append((ROLES[label - 1], text or "", "merge" if kind == "merge" else "turn"))
        state = label
    for empty in ENDING[state] if last else ():
        out.append((ROLES[empty - 1], "", "insert"))
        done["inserted"] += 1
    return out, done


def render(turns: list[tuple[str, str, str]]) -> str:
    """A header line for each turn but merged ones, then its text and a newline."""
    return "".join(("" if what == "merge" else f"<|{role}|>\n") + text + "\n" for role, text, what in turns)


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            turns, done = repair([(t["role"], t["text"]) for t in r["turns"]], r["begin"], r["finish"], r["last"])
            heads = sum(what != "merge" for _, _, what in turns)
            rows.append((r["conv_id"], r["part"], len(r["turns"]), heads, done["merged"], done["relabeled"], done["inserted"], r["cost"], render(turns)))
        names = ["conv_id", "part", "n_turns", "n_out", "n_merged", "n_relabeled", "n_inserted", "cost", "rendered"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string() if k == 8 else pa.int64()) for k in range(9)], names=names)


def format_chats(conversations: DataFrame) -> DataFrame:
    """For each part of a conversation: conv_id, part (from 0), turns before and after, repairs made, the whole repair's cost, rendered."""
    work = Scratch(conversations.sparkSession)
    turn = F.col("turn").cast("long")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(turn, F.lit((1 << 62) - 1)).alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), (turn.isNotNull() & F.col("conv_id").isNotNull()).alias("known"))
    every = rows.where("known").distinct().unionByName(rows.where("NOT known")).withColumn("turns_part", F.floor(F.col("turn") / PART).cast("long"))
    # Rows of one part are counted in order; a long run of equal turn numbers is only sorted in one place, never gathered.
    place = F.row_number().over(Window.partitionBy("conv_id", "turns_part").orderBy("turn", "role", "text"))
    key = ["conv_id", "turns_part", "cut"]
    dealt = every.withColumn("cut", F.floor((place - 1) / PART_ROWS).cast("long"))
    parts = work.keep(dealt.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")), "chat-parts")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [product(r).ravel().tolist() for r in batch["roles"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in key], pa.array(m, pa.list_(pa.int64()))], names=[*key, "m"])

    chains = parts.select(*key, F.col("turns.role").alias("roles")).mapInArrow(matrices, "conv_id long, turns_part long, cut long, m array<long>")
    chains = chains.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turns_part", "cut", "m"))).alias("parts"))
    cuts = chains.mapInArrow(_cuts, "c long, tp long, ct long, part long, begin int, finish int, last boolean, cost long")
    met = parts.join(cuts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turns_part") == F.col("tp")) & (F.col("cut") == F.col("ct"))).drop("c", "tp", "ct", "turns_part", "cut")
    return met.mapInArrow(_rendered, "conv_id long, part long, n_turns long, n_out long, n_merged long, n_relabeled long, n_inserted long, cost long, rendered string")
