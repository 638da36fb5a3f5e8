import itertools
import random
import re
from collections import defaultdict

import pytest

from tallyloft.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles, costs):
    """Over all role sequences and all ways between them."""
    repairer, best = chat.Repairer(costs), None
    for path in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, state = 0, 0
        for role, after in zip(roles, path):
            move = repairer.moves.get((state, after))
            if move is None:
                break
            cost += move[0] + (0 if role == after else costs.relabel if role else costs.unknown)
            state = after
        else:
            cost += len(chat.ending(state)) * costs.insert
            best = cost if best is None else min(best, cost)
    return best


def cost_of(rows, costs):
    total = 0
    for r in rows:
        role = chat.role_number(r.role)
        total += costs.merge * ("merge" in r.action) + (costs.relabel if role else costs.unknown) * ("relabel" in r.action)
        total += costs.insert * len([x for x in r.inserted.split(",") if x])
    return total


def legal(text):
    roles = re.findall(r"<\|(system|user|assistant)\|>", text)
    return roles == (["system"] if roles[:1] == ["system"] else []) + ["user", "assistant"] * (len([r for r in roles if r != "system"]) // 2)


def conversations(seed, n=60):
    draw = random.Random(seed)
    names = ["user", "assistant", "system", "Human", "gpt", None, "tool", " USER "]
    return [(c if c else None, t, draw.choice(names), f"t{c}.{t}") for c in range(n) for t in range(draw.randint(1, 7))]


@pytest.mark.parametrize("costs", [chat.Costs(), chat.Costs(merge=5, insert=1, relabel=2, unknown=0), chat.Costs(1, 1, 1, 1)])
def test_repairs_are_legal_and_of_least_cost_however_cut(spark, costs):
    rows = conversations(1)
    turns = spark.createDataFrame(rows, SCHEMA)
    for partitions in (1, 23):
        found = defaultdict(list)
        for r in chat.repaired(turns, costs, partitions).collect():
            found[r.conv_id].append(r)
        assert sum(map(len, found.values())) == len(rows)
        for conv, own in found.items():
            own.sort(key=lambda r: r.turn)
            assert legal("".join(r.rendered for r in own))
            assert cost_of(own, costs) == cheapest([chat.role_number(r.role) for r in own], costs)
            assert re.findall(r"t\d+\.\d+", "".join(r.rendered for r in own)) == [f"t{conv or 0}.{r.turn}" for r in own]


def test_one_long_conversation_over_many_pieces(spark):
    draw = random.Random(2)
    rows = [(5, t, draw.choice(["user", "assistant", "system", "x"]), f"t{t}") for t in range(3000)] + conversations(3, 20)[1:]
    turns = spark.createDataFrame(rows, SCHEMA)
    whole, cut = (sorted(chat.repaired(turns, partitions=p).collect(), key=str) for p in (1, 16))
    costs = chat.Costs()
    assert cost_of([r for r in whole if r.conv_id == 5], costs) == cost_of([r for r in cut if r.conv_id == 5], costs)
    assert len({r for r in chat.ordered(turns, 16).filter("conv_id = 5").select("piece").distinct().collect()}) > 3
    assert legal("".join(r.rendered for r in sorted((r for r in cut if r.conv_id == 5), key=lambda r: r.turn)))
    assert whole == cut


@pytest.mark.parametrize("costs", [chat.Costs(), chat.Costs(1, 1, 1, 1), chat.Costs(merge=0, insert=0, relabel=0, unknown=0)])
def test_ties_do_not_depend_on_the_cuts(costs):
    repairer, draw = chat.Repairer(costs), random.Random(4)
    short = [list(s) for n in range(1, 5) for s in itertools.product(range(4), repeat=n)]
    for roles in short + [[draw.randrange(4) for _ in range(draw.randint(5, 40))] for _ in range(400)]:
        whole, n = repairer.path(roles, chat.START, None), len(roles)
        several = [sorted(draw.sample(range(1, n), min(n - 1, k))) for k in (1, 2, 22) for _ in range(2)]
        for at in {tuple(a) for a in several}:
            pieces = [roles[i:j] for i, j in zip((0, *at), (*at, n))]
            states = repairer.cuts([repairer.matrix(p) for p in pieces])
            mended = [s for p, (entry, leave) in zip(pieces, states) for s in repairer.path(p, entry, leave)]
            assert mended == whole, (roles, at)


def test_rendering():
    def shown(*turns):
        import pandas as pd
        own = pd.DataFrame({"conv_id": 1, "turn": range(len(turns)), "role": [r for r, _ in turns], "text": [t for _, t in turns],
                            "entry": None, "leave": None, "last": None})
        return "".join(chat._mended(own, chat.Repairer(chat.Costs()))["rendered"])

    assert shown(("user", "q"), ("assistant", "a")) == "<|user|>\nq\n<|end|>\n<|assistant|>\na\n<|end|>\n"
    assert shown(("user", "q"), ("user", "r")) == "<|user|>\nq\n\nr\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert shown(("assistant", None)) == "<|user|>\n\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert shown(("system", "<|user|>"), ("human", "q"), ("bot", "a")).startswith("<|system|>\n<\\|user|>\n<|end|>\n<|user|>\nq")


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 1, "user", ""), (1, 1, "user", "x"), (1, 1, "user", "x")]
    turns = spark.createDataFrame([(*r, "e") for r in rows], SCHEMA + ", key string")
    found = chat.repaired(turns).collect()
    assert len(found) == 5 and {r.new_role for r in found} <= {"user", "assistant"}
    assert chat.repaired(turns.limit(0)).count() == 0
