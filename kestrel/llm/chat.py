"""Chat formatting with minimum-cost role repair.

Legal conversations are: an optional system turn, then user and assistant in turn, the
assistant last. An automaton with four states (start, system, user, assistant) accepts
them. Dynamic programming over it chooses for every turn to keep it, relabel it, merge it
into the turn before, or to put empty turns before it, at the lowest total cost; then the
repaired turns are rendered.

A turn acts on costs as a (min, +) matrix over the states, so the program splits anywhere:
conversations are range-sorted by id and turn and cut into blocks of bounded size, and only
the blocks' matrices are combined (in two levels, within tasks and across them) to give
each block its first and last state. A conversation of any length is spread over
many tasks.

Defined results: roles are compared in lower case without outer white space, ``human`` and ``bot``-like names
as in ALIASES, others and null as unknown; null text is empty and stays a turn; turns are ordered by turn
(null first), then role and text; repeated rows stay repeated turns; rows without conv_id form one
conversation; among equal costs keeping comes before merging, relabelling and inserting; an empty
table stays empty; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_arrow
from kestrel.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in ROLES.items()}
UNKNOWN = 0
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
#: What each repair costs. Merging a turn of another role also costs its relabelling.
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1.0, 3.0, 1.0, 2.0
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
BLOCK_TURNS, BLOCK_CHARS = 256, 1 << 20
_INF = float("inf")


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.get(ALIASES.get(name, name), UNKNOWN)


def _insertions() -> dict:
    """state -> {state: (cost, roles inserted)}: the cheapest empty turns between two states."""
    out = {}
    for s in range(4):
        out[s] = {s: (0.0, ())}
        ring = [s]
        while ring:
            now = ring.pop(0)
            for t in NEXT[now]:
                if t not in out[s]:
                    out[s][t] = (out[s][now][0] + INSERT, (*out[s][now][1], t))
                    ring.append(t)
    return out


INSERTIONS = _insertions()


def _moves(role: int) -> dict:
    """(from, to) -> (cost, inserted roles, merged, relabelled) for a turn of this role."""
    out: dict = {}
    for s in range(4):
        options = []
        if s != START:
            other = role != s
            options.append((s, MERGE + (0 if not other else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL), (), True, other))
        for between, (cost, inserted) in INSERTIONS[s].items():
            for t in NEXT[between]:
                other = role != t
                options.append((t, cost + (0 if not other else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL), inserted, False, other))
        for t, cost, inserted, merged, other in options:
            rank = (cost, len(inserted) > 0, other, merged)
            if (s, t) not in out or rank < out[(s, t)][0]:
                out[(s, t)] = (rank, inserted, merged, other)
    return {k: (v[0][0], *v[1:]) for k, v in out.items()}


MOVES = {r: _moves(r) for r in range(4)}
MATRIX = {r: np.array([[MOVES[r].get((s, t), (_INF,))[0] for t in range(4)] for s in range(4)]) for r in MOVES}
IDENTITY = np.where(np.eye(4, dtype=bool), 0.0, _INF)
#: Cost of ending: the empty turns that lead to an assistant turn.
CLOSING = np.array([INSERTIONS[s].get(ASSISTANT, (_INF,))[0] for s in range(4)])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def block_matrix(roles: list[int]) -> np.ndarray:
    out = IDENTITY
    for r in roles:
        out = product(out, MATRIX[r])
    return out


def best_path(matrices: list[np.ndarray], start: int, end: int | None) -> list[int]:
    """States before, between and after the steps, of lowest cost; ``end`` None: of the
    best ending including CLOSING. Ties go to the lower state."""
    costs = [np.where(np.arange(4) == start, 0.0, _INF)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(axis=0))
    state = int(np.argmin(costs[-1] + CLOSING)) if end is None else end
    path = [state]
    for m, c in zip(reversed(matrices), reversed(costs[:-1])):
        state = int(np.argmin(c + m[:, state]))
        path.append(state)
    return path[::-1]


def repair(roles: list[int], texts: list[str], start: int = START, end: int | None = None, closes: bool = True):
    """The repaired turns of a block: [[role, text, merged into the turn before the block]], and
    (cost, merges, relabels, inserts). ``end`` None: the best one; ``closes``: the conversation ends here."""
    path = best_path([MATRIX[r] for r in roles], start, end)
    turns: list = []
    cost, merges, relabels, inserts = 0.0, 0, 0, 0
    for r, text, s, t in zip(roles, texts, path, path[1:]):
        step, inserted, merged, other = MOVES[r][(s, t)]
        cost, merges, relabels, inserts = cost + step, merges + merged, relabels + other, inserts + len(inserted)
        turns += [[q, "", False] for q in inserted]
        if merged and turns:
            turns[-1][1] += _joined(text)
        else:
            turns.append([t, _joined(text) if merged else text, merged])
    if closes:
        step, inserted = INSERTIONS[path[-1]][ASSISTANT]
        cost, inserts = cost + step, inserts + len(inserted)
        turns += [[q, "", False] for q in inserted]
    return turns, (cost, merges, relabels, inserts)


def _joined(text: str) -> str:
    """What a merged turn adds to the turn before it."""
    return f"\n\n{text}" if text else ""


_MARK = re.compile(r"<(\\*)\|")


def escape(text: str) -> str:
    """Text that cannot be taken for a marker; undone by ``unescape``."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns, first: bool = True, closes: bool = True) -> str:
    """Turns as ``<|role|>\\ntext<|end|>\\n``. A turn is ended by what follows it, so a block of a longer
    conversation leaves its last turn open for the next block to continue or end."""
    out = []
    for role, text, continued in turns:
        if not continued:
            out.append(("" if first and not out else "<|end|>\n") + f"<|{NAMES[role]}|>\n")
        out.append(escape(text))
    return "".join(out) + ("<|end|>\n" if closes else "")


def _blocks(batches):
    """The sorted rows of a task in blocks; ``whole`` marks conversations that certainly lie in one block."""
    part, nth = TaskContext.get().partitionId(), 0
    now, roles, texts, chars, runs = object(), [], [], 0, 0
    pending: list = []

    def row(first, whole):
        nonlocal nth
        nth += 1
        return {"conv_id": now, "part": part, "nth": nth, "whole": whole, "roles": roles, "texts": texts, "matrix": block_matrix(roles).ravel().tolist()}

    first_of_task, started = True, False
    for batch in batches:
        schema = batch.schema.field(0).type
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if not started or conv != now:
                if started:
                    pending.append(row(runs == 0, whole=runs == 0 and not first_of_task))
                    first_of_task = False
                now, roles, texts, chars, runs, started = conv, [], [], 0, 0, True
            elif len(roles) >= BLOCK_TURNS or chars >= BLOCK_CHARS:
                pending.append(row(runs == 0, whole=False))
                roles, texts, chars, runs = [], [], 0, runs + 1
            roles.append(role_code(role))
            texts.append(text or "")
            chars += len(text or "")
        if pending:
            yield _block_rows(pending, schema)
            pending = []
    if started:
        pending.append(row(runs == 0, whole=False))  # the conversation may go on in the next task
        yield _block_rows(pending, schema)


def _block_rows(rows, id_type):
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("conv_id", id_type), ("part", pa.int32()), ("nth", pa.int32()), ("whole", pa.bool_()), ("roles", pa.list_(pa.int32())),
        ("texts", pa.list_(pa.string())), ("matrix", pa.list_(pa.float64()))]))


def _matrices(table: pa.Table) -> list[np.ndarray]:
    return [np.array(m).reshape(4, 4) for m in table.column("matrix").to_pylist()]


def _run_matrix(table: pa.Table) -> pa.Table:
    """The blocks of a conversation in one task as one matrix."""
    table = table.sort_by([("nth", "ascending")])
    out = IDENTITY
    for m in _matrices(table):
        out = product(out, m)
    return pa.table({"conv_id": table.column("conv_id").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "matrix": pa.array([out.ravel().tolist()], pa.list_(pa.float64()))})


def _part_states(table: pa.Table) -> pa.Table:
    """First and last state of each task's run; one row per task at most."""
    table = table.sort_by([("part", "ascending")])
    path = best_path(_matrices(table), START, None)
    n = table.num_rows
    return pa.table({"conv_id": table.column("conv_id"), "part": table.column("part"), "enter": pa.array(path[:-1], pa.int32()),
                     "leave": pa.array(path[1:], pa.int32()), "last": pa.array([i == n - 1 for i in range(n)])})


def _block_states(table: pa.Table) -> pa.Table:
    table = table.sort_by([("nth", "ascending")])
    enter, leave, last = (table.column(c)[0].as_py() for c in ("enter", "leave", "last"))
    path = best_path(_matrices(table), enter, leave)
    n = table.num_rows
    return pa.table({"part": table.column("part"), "nth": table.column("nth"), "first_state": pa.array(path[:-1], pa.int32()),
                     "last_state": pa.array(path[1:], pa.int32()), "closes": pa.array([last and i == n - 1 for i in range(n)])})


def format_conversations(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per block of a repaired conversation: conv_id, segment (ascending), n_turns, n_out (turns
    that start in it), cost, n_merges, n_relabels, n_inserts, text. A conversation's texts in
    the order of its segments, put together, are its rendering; most have one segment."""
    src = turns.select("conv_id", "turn", "role", "text")
    spark, kind = turns.sparkSession, dict(src.dtypes)["conv_id"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = src.repartitionByRange(n, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    blocks = materialize(map_arrow(ordered, _blocks, f"conv_id {kind}, part int, nth int, whole boolean, roles array<int>, "
                                   "texts array<string>, matrix array<double>"), "chat-blocks")
    parted = blocks.where("NOT whole").select("conv_id", "part", "nth", "matrix")
    runs = parted.groupBy("conv_id", "part").applyInArrow(_run_matrix, f"conv_id {kind}, part int, matrix array<double>")
    ends = (runs.groupBy("conv_id").applyInArrow(_part_states, f"conv_id {kind}, part int, enter int, leave int, last boolean")
            .withColumnRenamed("conv_id", "c").withColumnRenamed("part", "p"))
    inside = parted.join(ends, parted["conv_id"].eqNullSafe(ends["c"]) & (parted["part"] == ends["p"])).drop("c", "p")
    states = inside.groupBy("conv_id", "part").applyInArrow(_block_states, "part int, nth int, first_state int, last_state int, closes boolean")
    columns = ("conv_id", "part", "nth", "roles", "texts", "first_state", "last_state", "closes")
    single = blocks.where("whole").select(*columns[:5], F.lit(START).alias("first_state"), F.lit(None).cast("int").alias("last_state"),
                                          F.lit(True).alias("closes"))
    multi = blocks.where("NOT whole").join(states, ["part", "nth"]).select(*columns)
    schema = (f"conv_id {kind}, part int, nth int, n_turns bigint, n_out bigint, cost double, n_merges bigint, n_relabels bigint, "
              "n_inserts bigint, text string")
    out = map_arrow(single.unionByName(multi), _rendered, schema)
    return out.select("conv_id", (F.shiftleft(F.col("part").cast("bigint"), 32) + F.col("nth")).alias("segment"), "n_turns", "n_out", "cost",
                      "n_merges", "n_relabels", "n_inserts", "text")


def _rendered(batches):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            turns, (cost, merges, relabels, inserts) = repair(r["roles"], r["texts"], r["first_state"], r["last_state"], r["closes"])
            joined = bool(turns) and turns[0][2]
            rows.append({"conv_id": r["conv_id"], "part": r["part"], "nth": r["nth"], "n_turns": len(r["roles"]), "n_out": len(turns) - joined,
                         "cost": cost, "n_merges": merges, "n_relabels": relabels, "n_inserts": inserts, "text": render(turns, r["first_state"] == START, r["closes"])})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("nth", pa.int32()), ("n_turns", pa.int64()), ("n_out", pa.int64()),
            ("cost", pa.float64()), ("n_merges", pa.int64()), ("n_relabels", pa.int64()), ("n_inserts", pa.int64()), ("text", pa.string())]))
