from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyloft.llm import prefix_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows, group=100, most=6):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(x)] for c, x in held.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most if group else 0
        base = own.get(c - (c % group if c >= 0 else -(-c % group)), []) if group else []
        built[c] = tuple(base[:h] + turns[h:])
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[built[c][:d]].append(c)
    out = set()
    for k, inside in nodes.items():
        below = [x for x in nodes if x[:len(k)] == k]
        children = [x for x in below if len(x) == len(k) + 1]
        leaves = [x for x in below if not any(y[:-1] == x and y for y in nodes)]
        saved = sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in inside if built[c] == k)
        out.add((inside[0], len(k), nodes[k[:-1]][0] if k else None, len(inside), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, **options):
    out = [tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **options).collect()]
    assert len(out) == len(set(out))
    return set(out)


def made(seed, convs=40, longest=14):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(300), convs):
        rows += [(c, i, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", ""])) for i in range(draw.randint(1, longest))]
    draw.shuffle(rows)
    return rows


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("band", [2, 8])
def test_against_brute_force_with_bands_of_any_height(spark, band):
    rows = made(band)
    assert found(spark, rows, group=100, band=band) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "user", "a"), (3, None, "", ""),
            (7, 0, "user", "only"), (107, 2, None, "z"), (-5, 0, "user", "minus"), (-5, 1, "user", None)]
    assert found(spark, rows, group=100) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    assert found(spark, [(c, 0, "user", "gone")], group=100) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_a_long_conversation_and_many_copies_spread_over_partitions(spark, uncoalesced):
    """A conversation in most partitions, and a node at which more conversations end than fit a piece."""
    rows = [(500, i, "user", str(i % 7)) for i in range(700)] + [(c, i, "user", "same") for c in range(1000, 2400) for i in range(2)]
    turns = trie.ordered(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    assert turns.filter("conv = 500").select("part").distinct().count() > 1
    out = {(r["conv_id"], r["depth"]): r for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == 1 + 700 + 2
    same = out[1000, 2]
    assert (same["n_convs"], same["saved_tokens"]) == (1400, 1399 * 4)
    assert same["ends_sha256"] == hashlib.sha256(",".join(map(str, range(1000, 2400))).encode()).hexdigest()
    assert (out[500, 0]["n_leaves"], out[500, 0]["saved_tokens"], out[500, 0]["n_children"]) == (2, 2 * 1399 * 4, 2)
    assert out[500, 700]["parent_conv_id"] == 500 and out[500, 700]["n_leaves"] == 1


def test_rows_stay_within_a_band(spark):
    """No row explodes beyond the band, and rounds grow with the logarithm of the depth."""
    rows = [(c, i, "user", f"{c if i > 20 else 0}") for c in range(5) for i in range(60)]
    paths = trie.members(trie.ordered(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text"), None, 6)
    wide = paths.groupBy("conv", (paths["depth"] / 8).cast("int").alias("band")).count()
    assert wide.agg({"count": "max"}).first()[0] <= 8
    assert found(spark, rows, band=4) == brute(rows, None)


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == set()
    rows = made(3, 6, 4)
    extra = spark.createDataFrame([(*r, 1, "p", 2, "n") for r in rows], SCHEMA + ", depth int, node string, conv int, place string")
    assert {tuple(r) for r in trie.prefix_trie(extra, group=100).collect()} == brute(rows)
