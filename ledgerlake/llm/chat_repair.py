"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns
in alternation, the last one an assistant's. Each source turn is given a role
(its own, or another at the cost of a relabel) and either opens a turn or is
merged with the turn before it; empty turns may be inserted before a turn or
at the end. Dynamic programming over the automaton of legal turns finds the
cheapest repair; of equal repairs the first in a fixed order wins.

The automaton has few states, so the cheapest way through a run of turns from
every state to every state is a small (min, +) matrix, and runs are chained by
matrix products. A conversation of any length is cut into segments by a range
partitioning over (conversation, turn, ...): every task reduces its
segments to matrices, the matrices of a conversation (one a partition at most)
fix the state at each segment's border, and every task traces its segments
between those states. No conversation is ever in one task as a whole.

The result has one row per source turn with its piece of the rendered text:
opening and closing marks, inserted turns and the turn's text. The pieces of a
conversation in the order of (segment, position) are its rendered text.

Turns are ordered by (turn, role, first ``HEAD_CHARS`` of the text), nulls
first, then by a digest of a longer text, so that only equal rows are left as
they were read; equal rows all stay. A
null conv_id is a conversation of its own. Null roles and roles outside the
automaton are relabelled at a lower cost. Null text counts as empty. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions, stored

ROLES = ("system", "user", "assistant")
#: State: the role of the open turn, or none yet.
NONE = 3
STATES = 4
#: Legal next roles of a new turn, by state.
NEXT = {NONE: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1.0, 2.0, 0.5, 3.0
HEAD_CHARS = 64
#: Marks of the rendered text.
OPEN, CLOSE, JOIN = "<|{role}|>\n", "<|end|>\n", "\n"


def _paths() -> dict[int, dict[int, tuple[int, ...]]]:
    """state -> role -> the cheapest inserted turns before a turn of that role
    may open (none at all if it is a legal next role)."""
    out = {}
    for state in range(STATES):
        found, front = {}, [(state, ())]
        while front:
            later = []
            for at, way in front:
                for role in NEXT[at]:
                    if role not in found:
                        found[role] = way
                        later.append((role, (*way, role)))
            front = later
        out[state] = found
    return out


PATHS = _paths()
#: Inserted turns that make an ending legal, by state of the last turn.
ENDING = {2: (), 1: (2,), 0: (1, 2), NONE: (1, 2)}


def moves(own: int | None) -> list[tuple[float, int, int, bool, tuple[int, ...]]]:
    """(cost, state before, state after, merged, inserted) for a turn."""
    out = []
    for role in range(len(ROLES)):
        label = 0.0 if role == own else (RELABEL_UNKNOWN if own is None else RELABEL)
        for state in range(STATES):
            if state == role:
                out.append((label + MERGE, state, role, True, ()))
            if (way := PATHS[state].get(role)) is not None:
                out.append((label + INSERT * len(way), state, role, False, way))
    return sorted(out)


MOVES = {own: moves(own) for own in (None, 0, 1, 2)}


def _step(own: int | None) -> np.ndarray:
    m = np.full((STATES, STATES), np.inf)
    for cost, a, b, _, _ in MOVES[own]:
        m[a, b] = min(m[a, b], cost)
    return m


STEPS = {own: _step(own) for own in MOVES}


def role_number(role) -> int | None:
    return ROLES.index(role) if role in ROLES else None


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product."""
    return (a[:, :, None] + b[None, :, :]).min(1)


def through(roles) -> np.ndarray:
    """The matrix of a run of turns."""
    m = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
    for r in roles:
        m = chain(m, STEPS[r])
    return m


def trace(roles: list[int | None], start: int, end: int) -> list[tuple]:
    """The cheapest moves of a run from one state to another."""
    best = np.full((len(roles) + 1, STATES), np.inf)
    best[0, start] = 0
    came = []
    for k, r in enumerate(roles):
        how: list = [None] * STATES
        for move in MOVES[r]:
            cost = best[k, move[1]] + move[0]
            if cost < best[k + 1, move[2]]:
                best[k + 1, move[2]], how[move[2]] = cost, move
        came.append(how)
    out, state = [], end
    for how in reversed(came):
        out.append(how[state])
        state = how[state][1]
    return out[::-1]


def borders(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, state after) of every segment of a conversation on the
    cheapest legal way through all of them."""
    best = [np.where(np.arange(STATES) == NONE, 0.0, np.inf)]
    for m in matrices:
        best.append((best[-1][:, None] + m).min(0))
    last = best[-1] + [INSERT * len(ENDING[s]) for s in range(STATES)]
    state, out = int(np.argmin(last)), []
    for k in range(len(matrices) - 1, -1, -1):
        before = int(np.argmin(best[k] + matrices[k][:, state]))
        out.append((before, state))
        state = before
    return out[::-1]


def _empty_turn(role: int) -> str:
    return OPEN.format(role=ROLES[role]) + CLOSE


def render(move: tuple, before: int, text: str) -> str:
    """A turn's piece: it closes the turn before it if it opens one."""
    _, _, role, merged, inserted = move
    if merged:
        return JOIN + text
    return ("" if before == NONE else CLOSE) + "".join(map(_empty_turn, inserted)) + OPEN.format(role=ROLES[role]) + text


def segmented(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and seg: the number of the range partition.
    Written once, since the ranges come from a sample."""
    spark = conversations.sparkSession
    picked = conversations.select("conv_id", "turn", "role", "text").withColumns(
        {"head": F.substring("text", 1, HEAD_CHARS), "tie": F.monotonically_increasing_id(),
         "digest": F.when(F.length("text") > HEAD_CHARS, F.sha2("text", 256))})
    dealt = picked.repartitionByRange(partitions(spark), "conv_id", "turn", "role", "head", "digest", "tie")
    return stored(dealt.withColumn("seg", F.spark_partition_id()), "chat-segments")


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["turn", "role", "head", "digest", "tie"], na_position="first")


def _key(df: DataFrame) -> DataFrame:
    """The conversation as a text key, so that null is a conversation too."""
    return df.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, seg, pos, turn, role (as found), new_role, action (keep,
    relabel, merge, or both), n_inserted and piece of every source turn."""
    rows = _key(segmented(conversations))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        m = through([role_number(r) for r in _sorted(pdf)["role"]])
        return pd.DataFrame({"conv": [pdf["conv"].iloc[0]], "seg": [int(pdf["seg"].iloc[0])], "m": [m.ravel().tolist()]})

    runs = rows.select("conv", "seg", "turn", "role", "head", "digest", "tie").groupBy("conv", "seg").applyInPandas(
        reduce, "conv string, seg int, m array<double>")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg")
        states = borders([np.array(m, float).reshape(STATES, STATES) for m in pdf["m"]])
        return pd.DataFrame({"conv": pdf["conv"], "seg": pdf["seg"], "enter": [s for s, _ in states],
                             "leave": [s for _, s in states], "final": pdf["seg"] == pdf["seg"].max()})

    ways = stored(runs.groupBy("conv").applyInPandas(
        link, "conv string, seg int, enter int, leave int, final boolean"), "chat-borders")

    def write(pdf: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
        pdf, way = _sorted(pdf), way.iloc[0]
        numbers = [role_number(r) for r in pdf["role"]]
        made = trace(numbers, int(way["enter"]), int(way["leave"]))
        texts = ["" if t is None or t != t else t for t in pdf["text"]]
        pieces = [render(m, m[1], t) for m, t in zip(made, texts)]
        inserted = [len(m[4]) for m in made]
        if way["final"]:
            ending = ENDING[int(way["leave"])]
            pieces[-1] += CLOSE + "".join(map(_empty_turn, ending))
            inserted[-1] += len(ending)
        action = [("relabel" if m[2] != n else "") + ("+" if m[3] and m[2] != n else "") + ("merge" if m[3] else "")
                  or "keep" for m, n in zip(made, numbers)]
        return pd.DataFrame({
            "conv_id": pdf["conv_id"].array, "seg": pdf["seg"].array, "pos": range(len(pdf)), "turn": pdf["turn"].array,
            "role": pdf["role"].array, "new_role": [ROLES[m[2]] for m in made], "action": action,
            "n_inserted": inserted, "piece": pieces})

    return rows.groupBy("conv", "seg").cogroup(ways.groupBy("conv", "seg")).applyInPandas(
        write, f"conv_id {kinds['conv_id']}, seg int, pos int, turn {kinds['turn']}, role string, new_role string, "
               "action string, n_inserted int, piece string")
