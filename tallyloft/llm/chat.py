"""Chat formatting with minimum-cost role repair.

A conversation is legal if it has at most one system turn, at its start, and then user and assistant turns by turns, from the user's to
the assistant's. Dynamic programming over the states of this automaton (start, system, user, assistant) finds the cheapest repair: a turn
keeps its role or is relabelled, follows on legally, is merged with the turn before, or empty turns are inserted. The repaired sequence
is then rendered.

The cost of a run of turns is a small matrix over (state before, state after), and runs are joined by (min, +) products, so a
conversation may be cut anywhere; the matrices carry the order of equal costs too, so the repair is the same for any cuts. Turns are range-partitioned and written in order, so a conversation of a third of all turns lies
in many pieces. The matrices of the conversations at the edges of a piece, two a piece at most, are chained by conversation, which
gives the states at the cuts; each piece then repairs its own turns between them.

The result has a row per turn with the fragment it adds to the rendering: the fragments of a conversation, in order, are its text.

Defined results: turns go by number, NULL last, then by role and a hash of the text; repeated rows are turns of their own. A NULL conversation id is one
conversation. A NULL text is the empty text. A NULL or unknown role costs little to relabel. Markers inside a text are escaped with a
backslash. Equal costs: the last turn is the user's before the assistant's before the system's, and then, from the end to the front, each
turn's state is the lowest of start, system, user, assistant. An empty table gives no rows. Other columns are not carried along.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloft.session import stage

ROLES = ["start", "system", "user", "assistant"]
START, SYSTEM, USER, ASSISTANT = range(4)
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant",
           "chatgpt": "assistant", "developer": "system"}
_POSITION_BITS = 33
_ORDER = (USER, ASSISTANT, SYSTEM)
FAR = 1 << 40


@dataclasses.dataclass(frozen=True)
class Costs:
    merge: int = 2
    insert: int = 3
    relabel: int = 6
    unknown: int = 1  # to give a role to a turn that has none


def role_number(role: str | None) -> int:
    """0 for a missing or unknown role."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES[1:] else 0


def moves(costs: Costs) -> dict[tuple[int, int], tuple[int, bool, tuple[int, ...]]]:
    """(state before, role): cost, whether the turn is merged, turns inserted before it."""
    legal = {(START, SYSTEM): (), (START, USER): (), (SYSTEM, USER): (), (USER, ASSISTANT): (), (ASSISTANT, USER): (),
             (START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (USER, USER): (ASSISTANT,), (ASSISTANT, ASSISTANT): (USER,)}
    out = {k: (costs.insert * len(v), False, v) for k, v in legal.items()}
    for role in (SYSTEM, USER, ASSISTANT):
        if costs.merge <= out.get((role, role), (FAR,))[0]:
            out[role, role] = costs.merge, True, ()
    return out


def ending(state: int) -> tuple[int, ...]:
    """Turns inserted at the end."""
    return {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(state, ())


def step_costs(role: int, costs: Costs, steps: dict) -> np.ndarray:
    """(state before, state after) for one turn."""
    out = np.full((4, 4), FAR, np.int64)
    for (before, after), (cost, _, _) in steps.items():
        out[before, after] = cost + (0 if after == role else costs.relabel if role else costs.unknown)
    return out


class Repairer:
    def __init__(self, costs: Costs):
        self.costs, self.moves = costs, moves(costs)
        self.steps = [step_costs(r, costs, self.moves) for r in range(4)]
        self.final = np.array([len(ending(s)) * costs.insert for s in range(4)])

    def matrix(self, roles: list[int]) -> np.ndarray:
        """From each state before to each state after the turns: four times the cheapest cost, plus the rank of the state before.

        The rank orders the states before by their cheapest ways to the same state after, read from the end, the lowest state first;
        it settles ties between them just as ``path`` does turn by turn.
        """
        cost, rank = np.where(np.eye(4, dtype=bool), 0, FAR), np.repeat(np.arange(4)[:, None], 4, axis=1)
        for r in roles:
            sums = cost[:, :, None] + self.steps[r][None]
            came = sums.argmin(axis=1)
            cost = np.minimum(sums.min(axis=1), FAR)
            rank = (came * 4 + np.take_along_axis(rank, came, axis=1)).argsort(axis=0).argsort(axis=0)
        return cost * 4 + rank

    def cuts(self, matrices: list[np.ndarray]) -> list[tuple[int, int]]:
        """The states before and after each piece of a conversation, on the way that ``path`` takes through the whole."""
        best, back = np.array([0, FAR, FAR, FAR]), []
        for m in matrices:
            sums = best[:, None] * 4 + m
            back.append(sums.argmin(axis=0))
            best = np.minimum(sums.min(axis=0) // 4, FAR)
        state, out = min((START, *_ORDER), key=lambda s: best[s] + int(self.final[s])), []
        for came in reversed(back):
            out.append((int(came[state]), int(state)))
            state = int(came[state])
        return out[::-1]

    def path(self, roles: list[int], entry: int, leave: int | None) -> list[int]:
        """The states after each turn on the cheapest way from ``entry`` to ``leave``, or to a legal end where that is None."""
        best, back = [FAR] * 4, []
        best[entry] = 0
        for r in roles:
            step, now, came = self.steps[r], [FAR] * 4, [0] * 4
            for after in _ORDER:
                for before in range(4):
                    cost = best[before] + int(step[before, after])
                    if cost < now[after]:
                        now[after], came[after] = cost, before
            best = now
            back.append(came)
        state = leave if leave is not None else min((START, *_ORDER), key=lambda s: best[s] + int(self.final[s]))
        out = []
        for came in reversed(back):
            out.append(state)
            state = came[state]
        return out[::-1]


def _opening(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


END = "\n<|end|>\n"


def ordered(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """Turns in order, written with their piece: key, conv_id, turn, role, text, place, piece."""
    keyed = turns.select(
        F.coalesce(F.concat(F.lit("0"), F.col("conv_id").cast("string")), F.lit("1")).alias("key"), "conv_id", "turn", "role", "text")
    order = [F.col("key"), F.col("turn").isNull(), F.col("turn"), F.col("role"), F.xxhash64("text")]
    parted = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    placed = parted.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return stage(placed.withColumn("piece", F.shiftright("place", _POSITION_BITS)), "chat-turns")


def repaired(turns: DataFrame, costs: Costs = Costs(), partitions: int | None = None) -> DataFrame:
    """A row per turn: conv_id, turn, role, action (keep, relabel, merge, relabel+merge), new_role, inserted (roles of the empty turns before
    it, and behind it at the end), rendered."""
    placed = ordered(turns, partitions)
    repairer = Repairer(costs)

    def edges(piece: pd.DataFrame) -> pd.DataFrame:
        piece = piece.sort_values("place")
        rows = []
        for key in dict.fromkeys((piece["key"].iloc[0], piece["key"].iloc[-1])):
            own = piece[piece["key"] == key]
            rows.append((key, int(own["piece"].iloc[0]), repairer.matrix(list(map(role_number, own["role"]))).ravel().tolist()))
        return pd.DataFrame(rows, columns=["key", "piece", "matrix"])

    def chain(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("piece")
        states = repairer.cuts([np.array(m, np.int64).reshape(4, 4) for m in pieces["matrix"]])
        return pd.DataFrame({"key": pieces["key"], "piece": pieces["piece"], "entry": [e for e, _ in states], "leave": [x for _, x in states],
                             "last": [False] * (len(states) - 1) + [True]})

    def mend(piece: pd.DataFrame) -> pd.DataFrame:
        piece = piece.sort_values("place")
        parts = [_mended(own, repairer) for _, own in piece.groupby("key", sort=False)]
        return pd.concat(parts)[["conv_id", "turn", "role", "action", "new_role", "inserted", "rendered"]]

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    at_edges = placed.select("key", "piece", "place", "role").groupBy("piece").applyInPandas(edges, "key string, piece long, matrix array<long>")
    several = at_edges.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    cuts = at_edges.join(several, "key").groupBy("key").applyInPandas(chain, "key string, piece long, entry int, leave int, last boolean")
    # Two rows a piece at most, a piece being a task of the write above.
    known = placed.join(F.broadcast(stage(cuts, "chat-cuts")), ["key", "piece"], "left")
    return known.groupBy("piece").applyInPandas(
        mend, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, action string, new_role string, inserted string, rendered string")


def _mended(own: pd.DataFrame, repairer: Repairer) -> pd.DataFrame:
    """The turns of one conversation in one piece."""
    roles = list(map(role_number, own["role"]))
    cut = not pd.isna(own["entry"].iloc[0])
    state = int(own["entry"].iloc[0]) if cut else START
    last = not cut or bool(own["last"].iloc[0])
    path = repairer.path(roles, state, None if last else int(own["leave"].iloc[0]))
    actions, inserted, rendered = [], [], []
    for role, after, text in zip(roles, path, own["text"]):
        _, merged, added = repairer.moves[state, after]
        fragment = "\n\n" if merged else END if state != START else ""
        fragment += "".join(_opening(a) + END for a in added)
        fragment += "" if merged else _opening(after)
        rendered.append(fragment + ("" if text is None else text.replace("<|", "<\\|")))
        actions.append("+".join((["relabel"] if role != after else []) + (["merge"] if merged else [])) or "keep")
        inserted.append(",".join(ROLES[a] for a in added))
        state = after
    if last:
        closing = ending(state)
        rendered[-1] += END + "".join(_opening(a) + END for a in closing)
        inserted[-1] = ",".join(filter(None, [inserted[-1], *(f"+{ROLES[a]}" for a in closing)]))
    return own.assign(action=actions, new_role=[ROLES[s] for s in path], inserted=inserted, rendered=rendered)
