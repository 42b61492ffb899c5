"""Repairs the roles of conversations at least cost and renders them.

A legal conversation is an optional system turn and then user and assistant turns in alternation,
ending with an assistant turn. For each given turn the repair keeps it, gives it another role,
merges it with the turn before, or first inserts empty turns. Dynamic programming over the states
of this automaton finds the cheapest sequence.

The rows are dealt out by ranges of (conversation, turn), so a conversation of any length is cut
into segments of bounded size. Costs between states are matrices under (min, +): a cut
conversation's segments give one matrix each, their product fixes the states at the cuts, and then
all segments are repaired on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, INSERT = 1, 2, 3
#: States: start, and behind a turn of each role. Which role may follow which state.
START = 0
NEXT = {0: ("system", "user"), 1: ("user",), 2: ("assistant",), 3: ("user",)}
STATE = {role: k + 1 for k, role in enumerate(ROLES)}
FINAL = 3
NEVER = 1 << 40


def _ways(state: int, role: str, inserted: tuple[str, ...] = ()) -> Iterator[tuple[int, tuple[str, ...]]]:
    """(state before ``role``, turns inserted) of the ways to have ``role`` follow; at most two."""
    if role in NEXT[state]:
        yield state, inserted
    if len(inserted) < 2:
        for between in NEXT[state]:
            yield from _ways(STATE[between], role, (*inserted, between))


def _choices(role: str | None) -> list[list[tuple[int, int, str, tuple[str, ...], str]]]:
    """For each state, (cost, next state, role, inserted, action) of a given turn; the best of each."""
    out = []
    for state in range(4):
        best: dict[int, tuple] = {}
        for new in ROLES:
            relabel = RELABEL * (new != role)
            found = [(relabel + INSERT * len(i), STATE[new], new, i, "relabel" if relabel else "keep") for _, i in _ways(state, new)]
            if state == STATE[new]:
                found.append((relabel + MERGE, state, new, (), "relabel and merge" if relabel else "merge"))
            for choice in found:
                if choice[1] not in best or choice[0] < best[choice[1]][0]:
                    best[choice[1]] = choice
        out.append(sorted(best.values()))
    return out


_CHOICES = {role: _choices(role) for role in (*ROLES, None)}
#: What ends a conversation from each state: the turns inserted.
ENDINGS = {1: ("user", "assistant"), 2: ("assistant",), 3: (), 0: ()}


def segment_costs(roles: list[str | None]) -> list[list[int]]:
    """Least cost from each state before the turns to each state behind them."""
    rows = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]
    for role in roles:
        rows = [_stepped(row, role) for row in rows]
    return rows


def _stepped(row: list[int], role: str | None) -> list[int]:
    new = [NEVER] * 4
    for state, cost in enumerate(row):
        for choice in _CHOICES[role][state]:
            new[choice[1]] = min(new[choice[1]], cost + choice[0])
    return new


def repair(roles: list[str | None], first: int = START, last: int | None = None) -> list[tuple[str, tuple[str, ...], str]]:
    """(role, turns inserted before, action) of each turn on the cheapest way from ``first``.

    ``last`` is the state to end in; by default the one with the cheapest ending. Among equals the
    first state and the first choice win, seen from the end.
    """
    costs = [[0 if s == first else NEVER for s in range(4)]]
    for role in roles:
        costs.append(_stepped(costs[-1], role))
    if last is None:
        last = min(range(4), key=lambda s: (costs[-1][s] + INSERT * len(ENDINGS[s]), s))
    out, state = [], last
    for k in range(len(roles) - 1, -1, -1):
        state, choice = next(
            (before, choice)
            for before in range(4)
            for choice in _CHOICES[roles[k]][before]
            if choice[1] == state and costs[k][before] + choice[0] == costs[k + 1][state] < NEVER
        )
        out.append(choice[2:])
    return out[::-1]


def cut_states(matrices: list[list[list[int]]]) -> list[tuple[int, int]]:
    """The states before and behind each segment of one conversation on its cheapest way."""
    costs = [[0 if s == START else NEVER for s in range(4)]]
    for m in matrices:
        costs.append([min(costs[-1][a] + m[a][b] for a in range(4)) for b in range(4)])
    state = min(range(4), key=lambda s: (costs[-1][s] + INSERT * len(ENDINGS[s]), s))
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = next(a for a in range(4) if costs[k][a] + matrices[k][a][state] == costs[k + 1][state])
        out.append((before, state))
        state = before
    return out[::-1]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of one (conversation, segment) at a time, as they are sorted."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, group in groupby(rows, key=lambda r: (r["conv"], r["segment"])):
        yield key, list(group)


def render(role: str, text: str, merged: bool = False) -> str:
    """A turn under its header, or a merged text behind the turn before."""
    return f"{text}\n" if merged else f"<|{role}|>\n{text}\n"


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired turns, in the order of (conv_id, segment, place):

    (conv_id, segment, place, turn, source_role, role, action, cost, rendered). A given turn is one
    row, with the action keep, relabel, merge or relabel and merge; an inserted one is a row with a
    null turn and source_role. ``rendered`` in this order gives the conversation's text; a merged
    turn has no header of its own, and ``<|end|>`` closes the last row.

    Turns are ordered by turn, then role, then a hash of the text, equal ones as they are stored; null comes first. Roles are
    compared in lower case without blanks around; a null or unknown role is relabelled. A null text
    is empty. Repeated rows are turns of their own. Rows with a null conv_id are one conversation.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = turns.sparkSession
    rows = turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    # the place in the input parts equal rows, so that very many of them are many tasks
    order = ["conv", "turn", "role", "tie", "place"]
    rows = materialise(rows.repartitionByRange(*order).withColumn("segment", F.spark_partition_id()), "turns")
    together = lambda df: df.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "turn", "role", "tie", "place")
    # a border between two ranges cuts one conversation at most, so these are no more than the ranges
    cut = rows.groupBy("conv").agg(F.min("segment").alias("a"), F.max("segment").alias("b")).where("a < b").select(F.col("conv").alias("c"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    matrices: dict = {}
    parts = together(rows.join(cut, F.col("conv").eqNullSafe(F.col("c"))).select("conv", "segment", "turn", "role", "tie", "place"))
    for row in parts.mapInArrow(_matrices, f"conv {kinds['conv']}, segment int, costs array<long>").collect():
        matrices.setdefault(row.conv, []).append((row.segment, [row.costs[4 * a : 4 * a + 4] for a in range(4)]))
    states = {}
    for conv, found in matrices.items():
        found.sort()
        ways = cut_states([m for _, m in found])
        for k, ((segment, _), way) in enumerate(zip(found, ways, strict=True)):
            states[conv, segment] = (*way, k == len(found) - 1)
    shared = spark.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (conv, segment), group in _runs(batches):
            first, last, ends = shared.value.get((conv, segment), (START, None, True))
            done = repair([_known(r["role"]) for r in group], first, last)
            place, state = 0, first
            for row, (new, inserted, action) in zip(group, done, strict=True):
                for empty in inserted:
                    out.append((conv, segment, place, None, None, empty, "insert", INSERT, render(empty, "")))
                    place += 1
                merged = action.endswith("merge")
                cost = MERGE * merged + RELABEL * action.startswith("relabel")
                out.append((conv, segment, place, row["turn"], row["role"], new, action, cost, render(new, row["text"], merged)))
                place, state = place + 1, STATE[new]
            if ends:
                for empty in ENDINGS[state]:
                    out.append((conv, segment, place, None, None, empty, "insert", INSERT, render(empty, "")))
                    place += 1
                out[-1] = (*out[-1][:-1], out[-1][-1] + "<|end|>\n")
            if len(out) > 2000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    schema = (
        f"{conv_id} {kinds['conv']}, segment int, place int, turn {kinds['turn']}, source_role {kinds['role']},"
        " role string, action string, cost int, rendered string"
    )
    arrow = _arrow_schema(spark, schema)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return together(rows).mapInArrow(run, schema)


def _known(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    return role if role in ROLES else None


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.column("conv").type
        break
    else:
        return
    convs, segments, costs = [], [], []
    for (conv, segment), group in _runs(chain([batch], batches)):
        convs.append(conv)
        segments.append(segment)
        costs.append([c for row in segment_costs([_known(r["role"]) for r in group]) for c in row])
    yield pa.RecordBatch.from_arrays(
        [pa.array(convs, kind), pa.array(segments, pa.int32()), pa.array(costs, pa.list_(pa.int64()))],
        ["conv", "segment", "costs"],
    )


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
