import random
import re

import numpy as np
import pytest

from tallyloft.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    out = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for name, item in items:
            w = words(item)
            k = min(13, len(w))
            grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
            for i in range(len(own) - k + 1 if k else 0):
                if tuple(own[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    if name is not None:
                        found.add(str(name))
        out.append((len(own), len(hit), sorted(found)))
    return out


def made(seed, vocabulary=12, docs=60, items=25):
    draw = random.Random(seed)
    letters = [f"w{i}" for i in range(vocabulary)] + ["É", "x2"]

    def some(n):
        return [draw.choice(letters) for _ in range(n)]

    bench = [some(draw.choice([1, 2, 4, 5, 8, 12, 13, 14, 30, 60])) for _ in range(items)]
    bench += bench[:2] + [some(40) * 2, []]
    texts = []
    for _ in range(docs):
        parts = []
        for _ in range(draw.randint(0, 5)):
            parts += some(draw.randint(0, 40))
            if draw.random() < 0.6:
                own = draw.choice(bench)
                a = draw.randint(0, max(0, len(own) - 1))
                parts += own[a:a + draw.choice([12, 13, 14, 100])]
        texts.append(draw.choice([" ", "  ", ", ", "\n"]).join(w.upper() if draw.random() < 0.2 and w != "É" else w for w in parts))
    names = [None if i == 3 else i % 20 for i in range(len(bench))]
    return texts + [None, "", "..."], [(n, " ".join(b)) for n, b in zip(names, bench)]


def found(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(docs, bench, name="c", **options).collect()
    assert all(sum(s.end - s.start for s in r.c.spans) == r.c.n_hit for r in rows)
    return [(r.c.n_words, r.c.n_hit, r.c["items"]) for r in sorted(rows)]


@pytest.mark.parametrize("seed, vocabulary", [(1, 12), (2, 3), (3, 400), (4, 2)])
def test_hits_match_brute_force(spark, seed, vocabulary):
    texts, items = made(seed, vocabulary)
    assert found(spark, texts, items) == brute(texts, items)


def test_blocks_of_the_benchmark_and_pieces_of_texts_change_nothing(spark, monkeypatch):
    texts, items = made(5)
    assert found(spark, texts, items, block_words=200) == brute(texts, items)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 50)
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 30)
    monkeypatch.setattr(decontaminate, "CHUNK_HITS", 7)
    block = decontaminate.Block([(str(n) if n is not None else None, [w.encode() for w in words(t)]) for n, t in items if words(t)], 5, 13)
    rows = decontaminate.find([t.encode() if t is not None else None for t in texts], [None] * len(texts), [None] * len(texts), block)
    assert list(zip(rows["n_words"], rows["n_hit"], rows["items"])) == brute(texts, items)


def test_every_shared_window_has_a_common_fingerprint():
    draw = np.random.default_rng(3)
    for _ in range(200):
        shared = draw.integers(1, 30, 13)
        a, b = (np.concatenate([draw.integers(1, 30, draw.integers(0, 40)), shared, draw.integers(1, 30, draw.integers(0, 40))]).astype(np.int32) for _ in range(2))
        assert np.intersect1d(decontaminate.winnow(a, 5, 13)[1], decontaminate.winnow(b, 5, 13)[1]).size


def test_empty_benchmark_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, None, 6)], "doc_id long, text string, n_hit int")
    none = spark.createDataFrame([], "item_id long, text string")
    kept = decontaminate.clean(docs, none)
    assert kept.columns == docs.columns and kept.count() == 3
    bench = spark.createDataFrame([(1, "B"), (None, "zz")], "item_id long, text string")
    assert decontaminate.clean(docs, bench).collect() == [(None, None, 6)]
    assert decontaminate.clean(docs.limit(0), bench).count() == 0


def test_share_decides():
    from tallyloft.llm.decontaminate import Block, find
    block = Block([("1", [b"a"])], 5, 13)
    rows = find([b"a " + b"x " * 19, b"a " + b"x " * 20], [None] * 2, [None] * 2, block)
    assert [n * 20 >= w for n, w in zip(rows["n_hit"], rows["n_words"])] == [True, False]
