"""Chat formatting with minimum-cost repair of roles.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the user
first, the assistant last. Each turn may keep its role or be relabelled, be merged into the turn before it, and have an
empty turn inserted before it; dynamic programming over the automaton of legal turns picks the cheapest repair.

The step from one turn to the next is a small matrix of costs, and matrices of costs (min, +) combine in
any grouping. So a conversation of any length is cut into segments: all turns are sorted by conversation and turn across the
cluster, each task sums its piece of a conversation into one matrix, the matrices of a conversation (one per task it touches) tell
every segment in which state it starts and what must follow, and the segments are repaired independently. The result has a
row per turn and inserted turn; a merged turn is a row that continues the one before, so no text is gathered either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.operators.session import durable

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
MERGE, RELABEL, UNKNOWN_ROLE, INSERT = 1.0, 3.0, 1.5, 2.0
FAR = float("inf")
#: Turns per task when they are sorted.
SEGMENT_TURNS = 20_000
OPENING, CLOSING = "<|{role}|>\n", "<|end|>\n"


def _steps() -> list[list[tuple[float, str, int]]]:
    """Cost, action and inserted role (0: none) of emitting a turn of each role from each state; FAR where illegal."""
    never = (FAR, "", 0)
    table = [[never] * 4 for _ in range(4)]
    table[START][SYSTEM] = table[START][USER] = table[SYSTEM][USER] = (0.0, "keep", 0)
    table[USER][ASSISTANT] = table[ASSISTANT][USER] = (0.0, "keep", 0)
    table[START][ASSISTANT] = table[SYSTEM][ASSISTANT] = (INSERT, "keep", USER)
    table[SYSTEM][SYSTEM] = table[USER][USER] = table[ASSISTANT][ASSISTANT] = (MERGE, "merge", 0)
    return table


STEPS = _steps()
INSERTED = {USER: (INSERT, "keep", ASSISTANT), ASSISTANT: (INSERT, "keep", USER)}


def choices(state: int, given: int) -> Iterator[tuple[float, int, str, int]]:
    """(cost, role, action, inserted role) of every way to emit a turn; `given` 0 is an unknown role."""
    for role in (SYSTEM, USER, ASSISTANT):
        change = 0.0 if role == given else RELABEL if given else UNKNOWN_ROLE
        ways = [STEPS[state][role]]
        if state == role and role in INSERTED:
            ways.append(INSERTED[role])
        for cost, action, inserted in ways:
            if cost < FAR:
                yield cost + change, role, action, inserted


#: Best way from a state over a turn of a given role to the next state. Ties: less inserted, then the order above.
BEST = {
    (s, g, t): min(
        ((c, i, a) for c, r, a, i in choices(s, g) if r == t), default=(FAR, 0, ""), key=lambda w: (w[0], w[1] > 0))
    for s in range(4) for g in range(4) for t in range(4)
}
COST = np.array([[[BEST[s, g, t][0] for t in range(4)] for s in range(4)] for g in range(4)])
#: What it costs to stop in a state: an empty assistant turn closes a user's; nothing may end on a system turn alone.
FINAL = np.array([0.0, 2 * INSERT, INSERT, 0.0])


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest way through two segments one after the other."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def through(given: list[int]) -> np.ndarray:
    """Cheapest cost from each state to each over the turns."""
    total = np.where(np.eye(4, dtype=bool), 0.0, FAR)
    for g in given:
        total = join(total, COST[g])
    return total


def repair(given: list[int], state: int, after: np.ndarray) -> list[tuple[int, str, int]]:
    """(role, action, inserted role) of each turn, from `state`, where `after` is the cost of what follows each state."""
    ahead = [after]
    for g in reversed(given):
        ahead.append((COST[g] + ahead[-1][None, :]).min(axis=1))
    ahead.reverse()
    out = []
    for at, g in enumerate(given):
        nxt = int(np.argmin(COST[g][state] + ahead[at + 1]))
        _, inserted, action = BEST[state, g, nxt]
        out.append((nxt, action, inserted))
        state = nxt
    return out


def _given(roles: pd.Series) -> list[int]:
    known = {r: i for i, r in enumerate(ROLES) if r}
    return [known.get(r.strip().lower(), 0) if isinstance(r, str) else 0 for r in roles]


def _matrices(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("place")
    rows = []
    for conv, part in pdf.groupby("conv", sort=False, dropna=False):
        rows.append((part["segment"].iloc[0], conv, through(_given(part["role_in"])).ravel().tolist()))
    return pd.DataFrame(rows, columns=["segment", "conv", "costs"])


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """Segments of some conversations, in order: the state each starts in and the cost of what follows it."""
    rows = []
    for conv, part in pdf.groupby("conv", sort=False, dropna=False):
        part = part.sort_values("segment")
        costs = [np.array(c, float).reshape(4, 4) for c in part["costs"]]
        ahead = [FINAL]
        for c in reversed(costs):
            ahead.append((c + ahead[-1][None, :]).min(axis=1))
        ahead.reverse()
        state = START
        for at, (segment, c) in enumerate(zip(part["segment"], costs, strict=True)):
            rows.append((segment, conv, state, ahead[at + 1].tolist(), at == 0, at + 1 == len(costs)))
            state = int(np.argmin(c[state] + ahead[at + 1]))
    return pd.DataFrame(rows, columns=["segment", "conv", "state", "after", "begins", "ends"])


def _repaired(key: tuple, pdf: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The turns of one segment: a row per turn, and per inserted turn before or at the end."""
    starts = {c: (s, np.array(a, float), b, e) for c, s, a, b, e in entries[["conv", "state", "after", "begins", "ends"]].itertuples(index=False)}
    rows = []
    for conv, part in pdf.sort_values("place").groupby("conv", sort=False, dropna=False):
        given = _given(part["role_in"])
        state, after, begins, ends = starts[conv]
        last, own = len(given) - 1, len(rows)
        for at, (turn, (role, action, inserted)) in enumerate(
            zip(part.itertuples(index=False), repair(given, state, after), strict=True)
        ):
            what = action if role == given[at] else "relabel" if action == "keep" else "merge_relabel"
            if inserted:
                rows.append((turn.place, 0, ROLES[inserted], "insert", action == "merge"))
            rows.append((turn.place, 1, ROLES[role], what, action == "merge"))
            if at == last and ends:
                closing = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(role, ())
                rows += [(turn.place, 2 + i, ROLES[r], "insert", False) for i, r in enumerate(closing)]
        first, final = own if begins else -1, len(rows) - 1 if ends else -1
        rows[own:] = [(*r, i == first, i == final) for i, r in enumerate(rows[own:], own)]
    return pd.DataFrame(rows, columns=["place", "step", "role", "action", "joined", "first", "final"])


def format_chats(
    conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """The repaired turns: conv_id, turn, step, role_in, role, action, text, rendered.

    Rows of a conversation in the order (turn, place, step) concatenate to the rendered chat: `rendered` opens a turn, unless it is
    merged into the one before, and the next row that opens one begins with the end mark. The last row ends with it. Step 1 is the turn itself, 0 a turn inserted before it, 2
    and up turns that close the conversation.

    Turns are taken in order of `turn` (NULL first), then role and text; repeated rows are turns of their own and get merged.
    A NULL conv_id is one conversation. A NULL or unknown role is relabelled, at a lower cost than a known one. NULL and empty texts stay
    empty turns. Other columns are not read. An empty table gives no rows.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.xxhash64(F.col(conv_id).cast("string"), F.col(conv_id).isNull()).alias("conv"),
        F.col(turn).alias("turn"), F.col(role).cast("string").alias("role_in"), F.col(text).cast("string").alias("text"),
    )
    tasks = max(1, math.ceil(rows.count() / SEGMENT_TURNS))
    # A salt parts even a third of all rows that are equal; among equal rows any order is the same.
    ordered = rows.withColumn("_salt", F.monotonically_increasing_id())
    key = ["conv", "turn", "role_in", F.xxhash64("text"), "_salt"]
    turns = durable(
        ordered.repartitionByRange(tasks, *key).sortWithinPartitions(*key).drop("_salt")
        .withColumn("place", F.monotonically_increasing_id()).withColumn("segment", F.shiftright("place", 33).cast("int"))
    )
    slim = turns.select("segment", "place", "conv", "role_in")
    sums = durable(slim.groupBy("segment").applyInPandas(_matrices, "segment int, conv long, costs array<double>"))
    bucket = F.pmod("conv", F.lit(4 * tasks + 8)).alias("bucket")
    entries = sums.groupBy(bucket).applyInPandas(_entries, "segment int, conv long, state int, after array<double>, begins boolean, ends boolean")
    parts = slim.groupBy("segment").cogroup(entries.groupBy("segment")).applyInPandas(
        _repaired, "place long, step int, role string, action string, joined boolean, first boolean, final boolean")
    full = parts.join(turns, "place")
    said = F.when(F.col("step") == 1, F.coalesce("text", F.lit(""))).otherwise("")
    end = lambda where: F.when(where, CLOSING).otherwise("")
    opening = F.concat(end(~F.col("first")), F.format_string(OPENING.format(role="%s"), F.col("role")))
    rendered = F.concat(F.when(F.col("joined"), "\n").otherwise(opening), said, end(F.col("final")))
    return full.select(
        F.col("conv_id").alias(conv_id), F.col("turn").alias(turn), "place", "step", "role_in", "role", "action", said.alias("text"),
        rendered.alias("rendered"),
    )
