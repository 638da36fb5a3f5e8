from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from tallyloft.llm import token_alignment as alignment
from tallyloft.llm.queries import TOKENIZERS

A_JSON = Path(TOKENIZERS, "byte_bpe_50k.json").read_text(encoding="utf-8")
B_MODEL = Path(TOKENIZERS, "piece_bpe_32k.model").read_bytes()
ODD = ["", "<s> hi </s>", "<|endoftext|>x", " leading", "trailing ", "a  b", "\n\nx\ty ", "日本語テスト 😀😀", "a▁b", "<0x41> z", "é" * 50, "x", "  ", "\x00a",
       "ﬁ", "​foo  bar", "　x y", "a\x1c b", "x ́y", "Hello, world! It's 2024."]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A_JSON, B_MODEL, work=5)


def brute(aligner, text):
    """Groups of a text by walking over its bytes; None without tokens."""
    if not text:
        return None
    ids = aligner.a.encode(f" {text}", add_special_tokens=False).ids, aligner.b.encode(text)
    raw, ends = f" {text}".encode(), []
    for vocabulary, side in zip(aligner.vocabulary, ids):
        if b"".join(vocabulary.of_id[i] for i in side) != raw:
            return None
        at, own = 0, {}
        for i in side:
            at += len(vocabulary.of_id[i])
            own[at] = i
        ends.append(own)
    groups, a, b = [], [], []
    for at in range(1, len(raw) + 1):
        a += [ends[0][at]] if at in ends[0] else []
        b += [ends[1][at]] if at in ends[1] else []
        if at in ends[0] and at in ends[1]:
            groups.append((a, b))
            a, b = [], []
    assert not a and not b
    return groups


def expected(aligner, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text."""
    grouped = [brute(aligner, t) for t in texts]
    links = [Counter((a, b) for x, y in g or [] for a in x for b in y) for g in grouped]
    held = Counter(p for x in links for p in x)
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for g, x in zip(grouped, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out.append((sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(x.values()),
                    sum(k for p, k in x.items() if held[p] == top[p[0]]), sum(k * held[p] for p, k in x.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def found(spark, rows, schema="doc_id bigint, text string"):
    out = alignment.aligned(spark.createDataFrame(rows, schema), A_JSON, B_MODEL)
    return [tuple(r) for r in out.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


def random_texts(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices("ab  \n\tÄ日😀'\"1.　​́é▁<>|s\r\x85 ", k=draw.randint(1, 40))) for _ in range(n)]


def test_pieces_against_sets():
    draw = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(draw.integers(1, 60, draw.integers(1, 40))) for _ in range(2))
        end = max(a[-1], b[-1]) + 1
        a, b = np.append(a, end), np.append(b, end)
        for work in (1, 2, 7, 1000):
            i, j = alignment.merge_cuts(a, b, work)
            assert (np.diff(i) + np.diff(j) <= work + 1).all()
            assert all(not set(a[:x]) & set(b[y:]) and not set(b[:y]) & set(a[x:]) for x, y in zip(i, j))
            group_a, group_b, last_a, last_b = alignment.grouped(a, b, work)
            common = np.array(sorted(set(a.tolist()) & set(b.tolist())))
            assert (group_a == np.searchsorted(common, a)).all() and (group_b == np.searchsorted(common, b)).all()
            assert (last_a == np.isin(a, common)).all() and (last_b == np.isin(b, common)).all()


def test_against_brute_force(spark, aligner):
    texts = ODD + random_texts(3, 400)
    got = sorted(found(spark, list(enumerate(texts))))
    assert [r[1:] for r in got] == expected(aligner, texts)
    assert sum(r[1] > 0 for r in got) > 150 and sum(r[1] == 0 for r in got) > 50


def test_given_documents(spark, aligner):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r[0]: r[1:] for r in found(spark, rows)}
    assert got == dict(zip((r[0] for r in rows), expected(aligner, [r[1] for r in rows])))


def test_long_texts_go_by_stretches_and_wide_groups_are_compressed(aligner, monkeypatch):
    text = " ".join(random_texts(5, 30)).replace("▁", "").replace("́", "") + " end"
    whole = aligner.align([aligner.words(text)])[0]
    monkeypatch.setattr(alignment, "STRETCH", 20)
    parts = alignment._whole(aligner, aligner.words(text))
    assert whole["sound"] and parts["sha"] == hashlib.sha256(whole["groups"].encode()).hexdigest()
    assert [parts[k] for k in alignment._FIELDS] == [whole[k] for k in alignment._FIELDS]
    assert parts["pairs"].tolist() == whole["pairs"].tolist() and parts["times"].tolist() == whole["times"].tolist()
    monkeypatch.setattr(alignment, "_WIDE_GROUP", 0)
    wide = aligner.align([aligner.words(text)])[0]
    assert wide["pairs"].tolist() == whole["pairs"].tolist() and wide["times"].tolist() == whole["times"].tolist()
    assert alignment._whole(aligner, aligner.words(text + " a▁b")) is alignment.NONE


def test_kept_words_are_bounded(aligner, monkeypatch):
    texts = random_texts(8, 60)
    want = [f["groups"] for f in aligner.align([aligner.words(t) for t in texts])]
    monkeypatch.setattr(alignment, "_KEPT_WORDS", 3)
    assert [aligner.align([aligner.words(t)])[0]["groups"] for t in texts] == want
    assert len(aligner.number) <= 60


def test_pairs_beyond_the_broadcast_are_joined_by_shuffle(spark, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_PAIRS", 3)
    texts = ["the cat sat", "the dog", "the cat", "zebra crossing"]
    assert [r[1:] for r in sorted(found(spark, list(enumerate(texts))))] == expected(aligner, texts)


def test_nulls_repeats_invalid_bytes_empty_and_clashing_names(spark, aligner):
    rows = [(1, "the cat"), (1, "the cat"), (None, "the cat"), (None, None), (2, "")]
    want = expected(aligner, ["the cat"] * 3 + ["", ""])
    assert sorted(found(spark, rows), key=str) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=str)
    assert found(spark, []) == []
    extra = spark.createDataFrame([(1, "the cat", "r", 3, "n")], "doc_id bigint, text string, row string, no int, pairs string")
    assert alignment.aligned(extra, A_JSON, B_MODEL).first()["n_a"] == want[0][0]
    broken = spark.createDataFrame([(1, bytearray(b"a\xff"))], "doc_id bigint, text binary")
    assert alignment.aligned(broken, A_JSON, B_MODEL).first()["n_a"] == 0
