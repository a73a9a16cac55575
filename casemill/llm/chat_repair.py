"""Chat formatting: the cheapest repair of each conversation's roles by dynamic programming, then its rendering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import materialize, n_partitions

#: States: nothing yet, then the role of the last turn. A system turn may only come first; users and assistants
#: take turns, the user first; a conversation ends with the assistant.
STATES = ("start", "system", "user", "assistant")
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "ai": "assistant", "model": "assistant"}
#: Costs: of a merge with the turn before, an inserted empty turn, a changed role, and a role for a turn that has none.
MERGE, INSERT, RELABEL, NAME = 1, 2, 3, 2
FAR = 10**9


def fill(state: str, role: str) -> tuple[str, ...] | None:
    """The empty turns that must come between a state and a turn of that role, as few as possible; None if none help."""
    if role in NEXT[state]:
        return ()
    for a in NEXT[state]:
        if role in NEXT[a]:
            return (a,)
        for b in NEXT[a]:
            if role in NEXT[b] and "system" not in (a, b):
                return (a, b)
    return None


def _moves(role: str) -> list[list[tuple[int, str, str, tuple[str, ...]]]]:
    """For a turn's role, from each state to each: the cheapest cost, action, new role, empty turns before it.

    Of moves that cost the same, that with fewer inserted turns is taken, then keeping before relabelling before merging.
    """
    out = []
    for state in STATES:
        row = []
        for to in STATES:
            found = [(FAR, 9, "none", to, ())]
            if to != "start":
                change = 0 if to == role else RELABEL if role in STATES[1:] else NAME
                if (empty := fill(state, to)) is not None:
                    found.append((INSERT * len(empty) + change, len(empty), "keep" if to == role else "relabel", to, empty))
                if state == to:
                    found.append((MERGE + change, 5, "merge" if to == role else "relabel and merge", to, ()))
            cost, _, action, new, empty = min(found, key=lambda x: x[:2])
            row.append((cost, action, new, empty))
        out.append(row)
    return out


ROLES = ("system", "user", "assistant", "")
MOVES = {r: _moves(r) for r in ROLES}
COSTS = {r: np.array([[m[0] for m in row] for row in MOVES[r]], np.int64) for r in ROLES}
#: Of ending in each state: the empty turns up to the assistant's.
LAST = [() if s == "assistant" else (*(fill(s, "assistant") or ()), "assistant") for s in STATES]
LAST_COSTS = np.array([INSERT * len(x) for x in LAST], np.int64)


def path(roles: list[str], first: int, last: int | None) -> tuple[list[int], int]:
    """The states after each turn on the cheapest way from state first to last (None: to any, with its ending), and the cost.

    Of ways that cost the same, the one that takes the earlier state of STATES, from the end, is taken.
    """
    cost = np.full(len(STATES), FAR, np.int64)
    cost[first] = 0
    came = []
    for r in roles:
        through = cost[:, None] + COSTS[r]
        came.append(through.argmin(0))
        cost = np.minimum(through.min(0), FAR)
    at = int((cost + LAST_COSTS).argmin()) if last is None else last
    total, states = int(cost[at] + (LAST_COSTS[at] if last is None else 0)), []
    for before in reversed(came):
        states.append(at)
        at = int(before[at])
    return states[::-1], total


def transfer(roles: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
    """Over some turns, the cheapest cost from each state to each, and how the cheapest ways to one state rank by where they begin.

    Such tables of successive stretches can be put together. path() takes, of ways that cost the same, the one whose last states
    come first in STATES; the rank orders the ways to a state by just that, so that join() takes the same way as path() does uncut.
    """
    cost = np.where(np.eye(len(STATES), dtype=bool), 0, FAR).astype(np.int64)
    rank = np.zeros_like(cost)
    for r in roles:
        through = cost[:, :, None] + COSTS[r][None]
        via = through.argmin(1)
        cost = np.minimum(through.min(1), FAR)
        key = via * len(STATES) + np.take_along_axis(rank, via, 1)
        rank = np.stack([np.unique(k, return_inverse=True)[1] for k in key.T], 1)
    return cost, rank


def join(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], int]:
    """The states at the beginning of each stretch and at the end of the last, on the way that path() takes, and its cost."""
    cost, came = np.array([0] + [FAR] * (len(STATES) - 1)), []
    for table, rank in tables:
        through = cost[:, None] + table
        came.append(np.where(through == through.min(0), rank * len(STATES) + np.arange(len(STATES))[:, None], FAR).argmin(0))
        cost = np.minimum(through.min(0), FAR)
    states = [int((cost + LAST_COSTS).argmin())]
    total = int(cost[states[0]] + LAST_COSTS[states[0]])
    for before in reversed(came):
        states.append(int(before[states[-1]]))
    return states[::-1], total


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Makes each conversation legal at the least cost, by merges, relabels and inserted empty turns, and renders it.

    Returns a row for each turn and each inserted one: conv_id, turn (of an inserted one: that of the turn it stands
    before, or after at the end), place (0 and 1 inserted before, 2 the turn itself, 3 and 4 inserted at the end), action
    (keep, merge, relabel, relabel and merge, insert), role, piece, and cost (of the whole conversation, in the row of its last
    turn; else null). The rows don't depend on how turns are dealt to tasks. The pieces of a conversation in order of turn, copy and place,
    one behind the other, are its rendering.

    Turns are range-partitioned by conversation and turn, so that one very long conversation takes many tasks. Where
    one spans several, each stretch is first reduced to its table of costs and ranks between states; these few tables, of which
    there are two for each partition boundary at most, fix the states at the boundaries. Very long texts are rendered whole.

    Roles are trimmed, lower-cased, and known by ALIASES; a null or unknown role must be named. A null text is empty.
    Turns with equal numbers are ordered by role and text, and numbered in copy; a null number comes first. A null conversation id is a
    conversation of its own. An empty table gives no rows. Other columns aren't read.
    """
    name = F.lower(F.trim(F.coalesce(F.col(role_col), F.lit(""))))
    for alias, role in ALIASES.items():
        name = F.when(name == alias, role).otherwise(name)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), name.alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("role", F.when(F.col("role").isin("system", "user", "assistant"), F.col("role")).otherwise(""))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.col("text")]
    n = n_partitions(turns.sparkSession)
    # Long texts order turns only if all else is equal; ranges are dealt by the rest.
    parts = materialize(rows.repartitionByRange(n, *order[:4]).withColumn("part_no", F.spark_partition_id()), "turns")
    again = lambda df: df.repartition(n, "part_no").sortWithinPartitions("part_no", *order)

    ends = parts.groupBy("part_no").agg(F.min(F.struct(F.col("conv_id").isNotNull().alias("x"), "conv_id")).alias("low"), F.max(F.struct(F.col("conv_id").isNotNull().alias("x"), "conv_id")).alias("high"))
    spread = ends.select("part_no", F.explode(F.array_distinct(F.array("low", "high"))).alias("c")).select("part_no", F.col("c.conv_id").alias("conv_id"))
    several = spread.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").collect()  # one for each boundary at most
    shared = {r["conv_id"] for r in several}

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        def flat() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        return groupby(flat(), key=lambda r: (r[0], r[1]))

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), got in stretches(batches):
            if conv in shared:
                # Beside the table: the first and last turn's numbers, and how many turns at either end have them.
                ends = []

                def roles(got=got, ends=ends) -> Iterator[str]:
                    for r in got:
                        if not ends:
                            ends[:] = [r[3], 0, True, r[3], 0]
                        ends[1] += ends[2] and r[3] == ends[0]
                        ends[2] = ends[2] and r[3] == ends[0]
                        ends[3:] = [r[3], ends[4] + 1 if r[3] == ends[3] else 1]
                        yield r[2]

                cells = [x.reshape(-1).tolist() for x in transfer(roles())]
                row = {"part_no": part, "conv_id": conv, "cells": cells[0], "ranks": cells[1], "first_turn": ends[0], "leading": ends[1], "one_turn": ends[2], "last_turn": ends[3], "trailing": ends[4]}
                yield pa.RecordBatch.from_pylist([row], schema=stretch_schema)

    stretch_schema = pa.schema([
        ("part_no", pa.int32()), ("conv_id", pa.int64()), ("cells", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())), ("first_turn", pa.int64()), ("leading", pa.int64()),
        ("one_turn", pa.bool_()), ("last_turn", pa.int64()), ("trailing", pa.int64()),
    ])
    known = parts.filter(F.col("conv_id").isin([x for x in shared if x is not None]) | (F.col("conv_id").isNull() if None in shared else F.lit(False)))
    kinds = "part_no int, conv_id long, cells array<long>, ranks array<long>, first_turn long, leading long, one_turn boolean, last_turn long, trailing long"
    reduced = again(known).select("part_no", "conv_id", "role", "turn").mapInArrow(tables, kinds).collect() if shared else []
    #: Of each stretch of a conversation that has several: the states at both ends (None: it is the last one), the whole cost, and copies of its first turn before it.
    fixed: dict[tuple, tuple[int, int | None, int, int]] = {}
    for conv in shared:
        steps = sorted((r for r in reduced if r["conv_id"] == conv), key=lambda r: r["part_no"])
        states, total = join([tuple(np.array(r[c]).reshape(len(STATES), -1) for c in ("cells", "ranks")) for r in steps])
        copies, turn = 0, object()
        for k, r in enumerate(steps):
            copies = copies if r["first_turn"] == turn else 0
            fixed[r["part_no"], conv] = (states[k], None if k == len(steps) - 1 else states[k + 1], total, copies)
            copies, turn = (copies if r["one_turn"] else 0) + r["trailing"], r["last_turn"]

    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("copy", pa.int64()), ("place", pa.int32()), ("action", pa.string()), ("role", pa.string()), ("piece", pa.string()), ("cost", pa.int64())])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (part, conv), got in stretches(batches):
            got = list(got)
            at, last, whole, copy = fixed.get((part, conv), (0, None, None, 0))
            states, total = path([r[2] for r in got], at, last)
            total = total if whole is None else whole
            number, copy = got[0][3], copy - 1
            for k, (row, to) in enumerate(zip(got, states, strict=True)):
                _, action, role, empty = MOVES[row[2]][at][to]
                copy = copy + 1 if row[3] == number else 0
                number = row[3]
                for i, e in enumerate(empty):
                    out.append((conv, row[3], copy, i, "insert", e, ("<|end|>\n" if at or i else "") + f"<|{e}|>\n", None))
                head = "\n" if "merge" in action else ("<|end|>\n" if at or empty else "") + f"<|{role}|>\n"
                ending = LAST[to] if last is None and k == len(got) - 1 else ()
                tail = "" if ending or last is not None or k < len(got) - 1 else "<|end|>\n"
                out.append((conv, row[3], copy, 2, action, role, head + row[4] + tail, total if last is None and k == len(got) - 1 else None))
                for i, e in enumerate(ending):
                    out.append((conv, row[3], copy, 3 + i, "insert", e, f"<|end|>\n<|{e}|>\n" + "<|end|>\n" * (i == len(ending) - 1), None))
                at, size = to, size + len(row[4])
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return again(parts).select("part_no", "conv_id", "role", "turn", "text").mapInArrow(render, "conv_id long, turn long, copy long, place int, action string, role string, piece string, cost long")


def op8_chat_repair(spark, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
