"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn and then user and assistant
turns in alternation, begun by the user. Each given turn may be kept, merged
into the turn before it, relabelled, or kept after an empty turn was inserted;
dynamic programming over the automaton's states finds the cheapest repair.

The costs of a run of turns are a matrix from entry to exit state, and matrices
compose by (min, +). So turns are sorted over all tasks by conversation and
place, and cut into segments of SEGMENT turns at most, whatever their numbers
are: each gives its matrix, entry costs are carried along a conversation's
segments, exit states are carried back, and every segment then repairs its own
turns. No task holds more than one segment's texts, however long a conversation
is. A segment that is a whole conversation needs neither and skips that step, so
only the parts of long conversations meet by conversation. Ties go to the first option in the order keep, merge, insert, relabel, then
to the lower state; the result doesn't depend on where segments end.

The result has a row for each given turn with the piece of rendered text it
contributes; the pieces of a conversation in order of turn are the rendered
conversation. render() joins them into one text per conversation.

Rows that repeat conversation, turn, role and text are one turn. Turns with one
number are ordered by role and text; null numbers come last. Null texts are
empty, null and unknown roles fit any role at cost UNKNOWN. Null ids make up one
conversation. An empty table gives an empty result. No column but the four named
is read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import NO_ID, id_key, materialize

SEGMENT = 256
#: Leading characters by which texts are dealt to tasks; those that share them stay in one task, where all characters sort them.
PREFIX = 200
MERGE, INSERT, RELABEL, UNKNOWN = 1, 2, 3, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
TURN_BEGIN, TURN_END = "<|im_start|>{role}\n", "<|im_end|>\n"
FAR = 1 << 40
#: Costs by state before the first turn.
ENTRY = [0, FAR, FAR, FAR]


def _options(role: int) -> list[list[tuple[int, int, str, int]]]:
    """By entry state: (cost, exit state, action, inserted role), in order of preference. Role 0 is unknown."""
    out = []
    for state in range(4):
        found = []
        if role and role in FOLLOWS[state]:
            found.append((0, role, "keep", 0))
        if state != START and role == state:
            found.append((MERGE, state, "merge", 0))
        if role:
            found += [(INSERT, role, "insert", q) for q in FOLLOWS[state] if role in FOLLOWS[q]]
        found += [(RELABEL if role else UNKNOWN, q, "relabel", 0) for q in FOLLOWS[state] if q != role]
        out.append(found)
    return out


OPTIONS = [_options(role) for role in range(4)]
#: By role and exit state: (entry state, cost, action, inserted role), in order of preference.
INTO = [
    [sorted(((p, c, a, q) for p in range(4) for c, s, a, q in OPTIONS[role][p] if s == state), key=lambda x: (("keep", "merge", "insert", "relabel").index(x[2]), x[0])) for state in range(4)]
    for role in range(4)
]


def _forward(costs: list[int], roles: list[int]) -> list[list[int]]:
    """Least costs by state before the first turn and after each."""
    out = [costs]
    for role in roles:
        last = out[-1]
        out.append([min((last[p] + c for p, c, _, _ in INTO[role][s]), default=FAR) for s in range(4)])
    return out


def matrix(roles: list[int]) -> list[list[int]]:
    """Least cost from each entry state to each exit state."""
    return [_forward([0 if s == entry else FAR for s in range(4)], roles)[-1] for entry in range(4)]


def backward(costs: list[int], roles: list[int], exit_state: int) -> tuple[int, list[tuple[int, str, int]]]:
    """Entry state of the cheapest way to exit_state, and each turn's (state after it, action, inserted role)."""
    ways, state, out = _forward(costs, roles), exit_state, []
    for k in range(len(roles) - 1, -1, -1):
        best = ways[k + 1][state]
        p, _, action, inserted = next(x for x in INTO[roles[k]][state] if ways[k][x[0]] + x[1] == best)
        out.append((state, action, inserted))
        state = p
    return state, out[::-1]


def _cut(size: int):
    """Segments of one task's sorted turns: a new one with each conversation and after `size` turns. Segment numbers grow with the tasks.

    whole: the segment is its conversation. At a task's edges that isn't known, and so not said.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, open_rows, before = TaskContext.get().partitionId() << 33, None, None

        def built(rows: pa.Table, starts: np.ndarray, first: int, after: int | None) -> pa.RecordBatch:
            nonlocal before
            rows = rows.combine_chunks()
            turns = pa.StructArray.from_arrays([rows.column(c).combine_chunks() for c in ("place", "role", "text", "turn")], names=["place", "role", "text", "turn"])
            ends = np.append(starts, rows.num_rows).astype(np.int32)
            conv = rows.column("conv").combine_chunks().take(pa.array(starts, pa.int64()))
            numbers = pa.array(first + np.arange(len(starts)), pa.int64())
            around = [before, *conv.to_pylist(), after]
            whole = [None not in (a, c) and b not in (a, c) for a, b, c in zip(around[:-2], around[1:-1], around[2:], strict=True)]
            before = around[-2]
            return pa.RecordBatch.from_arrays([conv, numbers, pa.array(whole), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), turns)], names=["conv", "segment", "whole", "turns"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if open_rows is not None:
                rows = pa.concat_tables([open_rows, rows])
            conv = rows.column("conv").to_numpy()
            at = np.arange(len(conv))
            fresh = np.append(True, conv[1:] != conv[:-1])
            starts = np.flatnonzero((at - np.maximum.accumulate(np.where(fresh, at, 0))) % size == 0)
            # The last segment may go on in the next batch.
            if len(starts) > 1:
                yield built(rows.slice(0, int(starts[-1])), starts[:-1], segment, int(conv[starts[-1]]))
                segment += len(starts) - 1
            open_rows = rows.slice(int(starts[-1]))
        if open_rows is not None:
            yield built(open_rows, np.array([0]), segment, None)

    return run


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        m = [[x for row in matrix(roles) for x in row] for roles in batch.column(2).to_pylist()]
        n = pa.array([len(roles) for roles in batch.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], n, pa.array(m, pa.list_(pa.int64()))], names=["conv", "segment", "n", "m"])


def _carry(rows: pa.Table) -> pa.Table:
    """Turns before each segment of a conversation and least costs on entry to it; the exit state of its last one."""
    rows = rows.sort_by("segment")
    costs, entries = ENTRY, []
    for m in rows.column("m").to_pylist():
        entries.append(costs)
        costs = [min(FAR, *(costs[p] + m[4 * p + s] for p in range(4))) for s in range(4)]
    last = costs.index(min(costs))
    ends = [None] * (len(entries) - 1) + [last]
    before = np.cumsum(rows.column("n").to_numpy()) - rows.column("n").to_numpy()
    return pa.table({"conv": rows.column("conv"), "segment": rows.column("segment"), "before": pa.array(before, pa.int64()), "entry": pa.array(entries, pa.list_(pa.int64())), "last": pa.array(ends, pa.int32())})


def _ways_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        back = []
        for roles, costs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            ends = _forward(costs, roles)[-1]
            back.append([backward(costs, roles, s)[0] if ends[s] < FAR else -1 for s in range(4)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(4), pa.array(back, pa.list_(pa.int32()))], names=["conv", "segment", "last", "back"])


def _carry_back(rows: pa.Table) -> pa.Table:
    """Exit state of each segment of a conversation."""
    rows = rows.sort_by([("segment", "descending")])
    state, exits = rows.column("last")[0].as_py(), []
    for back in rows.column("back").to_pylist():
        exits.append(state)
        state = back[state]
    return pa.table({"conv": rows.column("conv"), "segment": rows.column("segment"), "exit": pa.array(exits, pa.int32())})


PIECES = "conv long, turn long, given_role string, role string, action string, inserted string, starts boolean, at long, piece string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in range(9)]
        for conv, roles, first, costs, last, exit_state, turns in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
            if exit_state is None:  # a whole conversation
                first, costs = 0, ENTRY
                ends = _forward(costs, roles)[-1]
                last = exit_state = ends.index(min(ends))
            before, path = backward(costs, roles, exit_state)
            for k, ((state, action, inserted), turn) in enumerate(zip(path, turns, strict=True)):
                starts = action != "merge"
                piece = TURN_END if starts and before != START else ""
                if inserted:
                    piece += TURN_BEGIN.format(role=NAMES[inserted]) + TURN_END
                piece += (TURN_BEGIN.format(role=NAMES[state]) if starts else "\n") + turn["text"]
                if last is not None and k == len(path) - 1:
                    piece += TURN_END
                for col, x in zip(cols, (conv, turn["turn"], turn["role"], NAMES[state], action, NAMES[inserted] or None, starts, first + k, piece), strict=True):
                    col.append(x)
                before = state
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])


def _role_number(role: Column) -> Column:
    plain = F.lower(F.trim(role))
    names = F.create_map(*[F.lit(x) for k, name in enumerate(NAMES) if k for x in (name, k)], *[F.lit(x) for name, of in ALIASES.items() for x in (name, NAMES.index(of))])
    return F.coalesce(F.try_element_at(names, F.coalesce(plain, F.lit("?"))), F.lit(0))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per given turn: conv_id, turn, given_role, role, action, inserted, starts, at (place in the conversation), piece."""
    rows = conversations.select(id_key(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    place = F.coalesce("turn", F.lit(NO_ID))
    rows = rows.select("conv", place.alias("place"), "role", "text", "turn")
    dealt = rows.repartitionByRange("conv", "place", "role", F.substring("text", 1, PREFIX)).sortWithinPartitions("conv", "place", "role", "text")
    segments = dealt.mapInArrow(_cut(SEGMENT), "conv long, segment long, whole boolean, turns array<struct<place: long, role: string, text: string, turn: long>>")
    segments = segments.withColumn("roles", F.transform("turns", lambda t: _role_number(t.role)))
    segments = materialize(segments, "segments")
    roles = segments.filter(~F.col("whole")).select("conv", "segment", "roles")
    entries = roles.mapInArrow(_matrices, "conv long, segment long, n long, m array<long>").groupBy("conv").applyInArrow(_carry, "conv long, segment long, before long, entry array<long>, last int")
    entries = materialize(entries, "entries")
    keys = ["conv", "segment"]
    back = roles.join(entries, keys).select("conv", "segment", "roles", "entry", "last").mapInArrow(_ways_in, "conv long, segment long, last int, back array<int>")
    exits = back.groupBy("conv").applyInArrow(_carry_back, "conv long, segment long, exit int")
    columns = ["conv", "roles", "before", "entry", "last", "exit", "turns"]
    parts = segments.filter(~F.col("whole")).join(entries, keys).join(exits, keys).select(columns)
    alone = segments.filter("whole").withColumns({c: F.lit(None).cast(t) for c, t in (("before", "long"), ("entry", "array<long>"), ("last", "int"), ("exit", "int"))}).select(columns)
    out = parts.unionByName(alone).mapInArrow(_pieces, PIECES)
    return out.select(F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), "turn", "given_role", "role", "action", "inserted", "starts", "at", "piece")


def render(pieces: DataFrame) -> DataFrame:
    """conv_id and the whole rendered text, for conversations that fit into one row."""
    place = F.struct("at", "piece")
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("all"))
    return whole.select("conv_id", F.array_join(F.transform("all", lambda p: p.piece), "").alias("text"))
