import random
import re
from collections import Counter, defaultdict

import pytest

from tallyloft.llm import mix


def water_filling(sizes, most=3):
    """Targets by the rule: share by weight, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        weights = sum(weight[s] for s in order if s not in capped)
        share = left / weights if weights else 0
        above = {s for s in order if s not in capped and weight[s] * share > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weight[s] * share for s in order}
        capped |= above


def made(seed, n=400):
    draw = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "tiny", "", "empty"]
    rows = []
    for i in range(n):
        source = draw.choices(sources, [30, 5, 5, 5, 5, 1, 2, 1])[0]
        text = None if source == "empty" or draw.random() < 0.02 else " \n".join("w" * draw.randint(1, 5) for _ in range(draw.choice([0, 1, 5, 30, 200, 900])))
        rows.append((i, text, source))
    return rows + [(7, "same row", "a")] * 3 + [(None, "no id", "b"), (None, None, None)]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed, block_words", [(1, 1 << 17), (2, 500), (3, 20)])
def test_targets_sizes_and_taken(spark, seed, block_words):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mix.plan(docs, block_words=block_words)
    drawn = mix.draws(planned, shards=5)
    found = mix.taken(planned, drawn).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    targets = water_filling(dict(sizes))
    by_source = defaultdict(list)
    for _, t, s in rows:
        by_source[s].append(size(t))
    assert sorted((r.id is None, r.id or 0, r.size, r.source_size, round(r.target, 6)) for r in found) == sorted(
        (i is None, i or 0, size(t), sizes[s], round(float(targets[s]), 6)) for i, t, s in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    source_of = {(i, size(t)): s for i, t, s in rows}
    got = Counter()
    for r in found:
        got[source_of[r.id, r.size]] += r.taken
    for s, t in targets.items():
        assert abs(got[s] - t) <= max(max(by_source[s]) / 2 + 3, 0.02 * t)


def test_reruns_and_partitions_agree(spark):
    rows = made(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = []
    for d in (docs, docs.repartition(5), docs.orderBy("text")):
        planned = mix.plan(d, block_words=100)
        runs.append(sorted(mix.taken(planned, mix.draws(planned, shards=3)).collect(), key=str))
    assert runs[0] == runs[1] == runs[2]


def test_tree_splits_exact_quotas_evenly_and_at_random(spark):
    quotas = {"a": 700, "b": 41, "c": 3, "d": 1}
    found = mix.split(spark.createDataFrame(list(quotas.items()), "key string, n long"), 7, 42).collect()
    by_source, by_shard = Counter(), Counter()
    for r in found:
        by_source[r.key] += r.n
        by_shard[r.shard] += r.n
    assert by_source == quotas and set(by_shard) == set(range(7))
    assert max(by_shard.values()) - min(by_shard.values()) <= 7
    means = Counter()
    for seed in range(60):
        node = mix.split(spark.createDataFrame([("a", 30), ("b", 10)], "key string, n long"), 2, seed) if seed < 6 else None
        for r in node.collect() if node else ():
            means[r.shard, r.key] += r.n
    assert abs(means[0, "b"] - 30) <= 12  # a hypergeometric draw keeps the shares on average


def test_mix_holds_each_draw_once_in_shuffled_shards(spark):
    rows = [(*r, "x") for r in made(5) if r[0] != 7] + [(7, "one more", "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, block string")
    planned = mix.plan(docs, block_words=200)
    drawn = mix.draws(planned, shards=4)
    out = mix.mixed(docs, planned, drawn)
    assert out.columns == [*docs.columns, "mix_copy", "mix_shard"]
    got = out.collect()
    times = Counter((r.doc_id, r.text) for r in got)
    assert len({(r.doc_id, r.text, r.mix_copy) for r in got}) == len(got)
    text_of = {(i, size(t)): t for i, t, *_ in rows}
    for r in mix.taken(planned, drawn).collect():
        if r.size:
            assert times[r.id, text_of[r.id, r.size]] * r.size == r.taken
    shards = {p: {r.mix_shard for r in rows} for p, rows in enumerate(out.rdd.glom().collect())}
    assert sum(map(len, shards.values())) == len(set().union(*shards.values())) == 4


def test_broadcast_and_shuffle_of_the_draws_agree(spark, monkeypatch):
    docs = spark.createDataFrame(made(6), "doc_id long, text string, source string")
    planned = mix.plan(docs, block_words=300)
    drawn = mix.draws(planned, shards=2)
    one = sorted(mix.mixed(docs, planned, drawn).collect(), key=str)
    monkeypatch.setattr(mix, "BROADCAST_DRAWS", 0)
    assert sorted(mix.mixed(docs, planned, drawn).collect(), key=str) == one


def test_empty_table_and_empty_texts(spark):
    for rows in ([], [(1, None, None), (2, "", "a")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        planned = mix.plan(docs)
        drawn = mix.draws(planned)
        found = mix.taken(planned, drawn).collect()
        assert len(found) == len(rows) and all(r.taken == 0 and r.target == 0 for r in found)
        mix.mixed(docs, planned, drawn).collect()


def test_a_giant_document_does_not_end_its_source(spark):
    """Source a gets a twelfth of all words, 875, and has 1,000 in small documents beside the giant."""
    rows = [(i, "w " * 10, "a") for i in range(100)] + [(100, "w " * 5000, "a")] + [(200 + i, "w " * 10, "bcdef"[i % 5]) for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in (0, 1):
        planned = mix.plan(docs, block_words=50, seed=seed)
        found = [r for r in mix.taken(planned, mix.draws(planned, shards=2)).collect() if r.id <= 100]
        assert {r.target for r in found} == {875.0} and abs(sum(r.taken for r in found) - 875) <= 5


def test_a_mix_of_a_mix(spark):
    """Columns that an earlier mix left give way."""
    docs = spark.createDataFrame([(i, "some words here", "ab"[i % 2], 7, 9) for i in range(20)],
                                 "doc_id long, text string, source string, mix_copy int, mix_shard int")
    planned = mix.plan(docs)
    drawn = mix.draws(planned)
    out, plain = mix.mixed(docs, planned, drawn), mix.mixed(docs.drop("mix_copy", "mix_shard"), planned, drawn)
    assert out.columns == ["doc_id", "text", "source", "mix_copy", "mix_shard"] and out.exceptAll(plain).count() == 0 < out.count()
