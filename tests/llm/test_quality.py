import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloft.llm import quality

DATA = "/root/testdata/sf0.1"


def made(n, seed):
    """Grade by marker words among noise."""
    draw = random.Random(seed)
    noise = [f"n{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        grade = draw.choice([0, 1, 1, 2, 2, 2])
        marks = {0: ["vile", "awful"], 1: ["click", "buy"], 2: ["theorem", "proof"]}[grade]
        rows.append((i, " ".join(draw.choices(noise, k=60) + draw.choices(marks, k=3)), grade))
    return rows


def test_grades_of_held_out_documents(spark):
    rows = made(1500, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows if i % 3] + [(0, None), (9999, 1), (None, 2)], "doc_id long, grade int")
    grader = quality.learn(docs, grades)
    assert grader.grades == [0, 1, 2] and grader.thresholds[0] < grader.thresholds[1]
    held = [(t, g) for i, t, g in rows if not i % 3]
    p = grader.probabilities([t for t, _ in held])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert (p.argmax(axis=1) == [g for _, g in held]).mean() > 0.97
    found = docs.withColumn("g", quality.graded(grader, docs, docs["text"])).select(
        "doc_id", "g.expected_grade", quality.tail(F.col("g"), grader, 1).alias("t")).collect()
    q = {r.doc_id: r for r in found}
    for (i, t, _), own in zip(rows[:50], grader.probabilities([t for _, t, _ in rows[:50]])):
        assert q[i].expected_grade == pytest.approx(own @ [0, 1, 2]) and q[i].t == pytest.approx(own[1:].sum())


def test_slopes_are_those_of_the_likelihood():
    draw = np.random.default_rng(1)
    level, line, cuts = draw.integers(0, 3, 40), draw.normal(size=40), np.array([-0.5, 0.7])

    def loss(line):
        return -np.log(np.diff(np.concatenate([np.zeros((40, 1)), 1 / (1 + np.exp(line[:, None] - cuts)), np.ones((40, 1))], axis=1), axis=1)[range(40), level])

    up, low = quality._slopes(line, level, cuts)
    assert np.allclose((loss(line + 1e-6) - loss(line - 1e-6)) / 2e-6, up - low, atol=1e-5)


def test_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    grader = quality.learn(docs, labels.filter(~fold).select("doc_id", grade.alias("grade")))
    held = docs.join(labels.filter(fold), "doc_id")
    rows = held.select("toxic", quality.graded(grader, docs, F.col("text")).alias("g")).collect()
    toxic = [r.g.p_0 > 0.5 for r in rows if r.toxic]
    clean = [r.g.p_0 > 0.5 for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.01


def test_features_of_long_and_odd_texts(monkeypatch):
    known = quality.Hashes()
    assert quality.features(None, known) == quality.features("", known) and len(quality.features("a b a", known)) == 3
    text = "word " * 1000 + "ÄÖ!! _x_ longwords"
    whole = quality.features(text, known)
    monkeypatch.setattr(quality, "_BLOCK", 17)
    assert quality.features(text, known) == whole


def test_no_grades_one_grade_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 0.5), (None, None, 0.1)], "doc_id long, text string, grade double")
    none = spark.createDataFrame([], "doc_id long, grade int")
    for grades, expected in ((none, None), (spark.createDataFrame([(1, 2)], "doc_id long, grade int"), 2.0)):
        grader = quality.learn(docs, grades)
        out = docs.select(quality.graded(grader, docs, docs["text"]).alias("g")).collect()
        assert [None if r.g.expected_grade is None or np.isnan(r.g.expected_grade) else r.g.expected_grade for r in out] == [expected] * 2
        assert quality.selected(docs, grader, least=1).columns == docs.columns and quality.selected(docs, grader, least=1).count() == 2
    assert docs.limit(0).select(quality.graded(grader, docs, docs["text"])).count() == 0
