from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from tallyloft.llm import embeddings

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, least=0.98):
    sound = [v is not None and y is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, y in rows]
    link = [[False] * len(rows) for _ in rows]
    for i, (_, v, y) in enumerate(rows):
        for j, (_, w, z) in enumerate(rows):
            if i != j and sound[i] and sound[j] and y == z and len(v) == len(w):
                a, b = np.array(v) / np.abs(v).max(), np.array(w) / np.abs(w).max()
                link[i][j] = a @ b / math.sqrt((a @ a) * (b @ b)) >= least
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            at = todo.pop()
            new = {j for j in range(len(rows)) if link[at][j]} - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], sum(link[i]), component, rows[i][0] == component))
    return sorted(out, key=str)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dims))
    rows = []
    for i in range(n):
        noise = rng.choice([0.0, 0.02, 0.12, 0.2])
        vector = centres[rng.integers(len(centres))] + noise * rng.standard_normal(dims)
        rows.append((i, [float(x) for x in vector * rng.choice([1.0, 3.0])], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("dims", [1, 2, 9, 24])
def test_exact_traversal_against_brute_force(spark, monkeypatch, dims):
    """With recall 1 every link is found, whatever the cells and blocks."""
    monkeypatch.setattr(embeddings, "CELL", 4)
    rows = clustered(150, dims, dims)
    assert found(spark, rows, target_recall=1.0, block=7) == brute(rows)


def test_calibrated_recall(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 4)
    rows = clustered(300, 32, 5)
    want = sum(n for _, n, _, _ in brute(rows))
    got = sum(n for _, n, _, _ in found(spark, rows, target_recall=0.99))
    assert want > 300 and 0.95 * want <= got <= want


def test_recall_over_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = df.toPandas()
    unit = np.stack(table["embedding"]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = table["label"].to_numpy()
    want = np.array([(unit[label == y] @ x >= 0.98).sum() - 1 for x, y in zip(unit, label)])
    got = embeddings.near_duplicates(df).toPandas().set_index("id")["n_links"].reindex(table["vec_id"]).to_numpy()
    assert (got <= want).all() and got.sum() >= 0.999 * want.sum()


def test_a_stop_below_recall_one_is_no_further(spark):
    rows = np.random.default_rng(1).standard_normal((400, 16))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    stops = [embeddings.fit(rows, 8, 0.98, r).stop for r in (0.5, 0.9, 0.999, 1.0)]
    assert stops == sorted(stops) and stops[-1] == pytest.approx(0.04)


def test_visits_are_the_cells_below_the_stop(spark):
    rows = np.random.default_rng(2).standard_normal((50, 8))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    index = embeddings.fit(rows, 5, 0.9, 1.0)
    (n1, w1), (n2, w2) = index.walls(rows)
    want = {(r, i * 5 + j) for r in range(50) for i in range(5) for j in range(5)
            if w1[r, i] + w2[r, j] <= index.stop and i * 5 + j > n1[r] * 5 + n2[r]} | {(r, n1[r] * 5 + n2[r]) for r in range(50)}
    got = [(int(r), int(c)) for rs, cs, _ in index.visits(rows) for r, c in zip(rs, cs)]
    assert len(got) == len(set(got)) and set(got) == want


def test_many_copies_and_a_crowded_cell(spark):
    """Copies are one node; a crowd of near copies is verified in blocks, and a group returns no more rows than it got."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.0, 0.0], 1) for i in range(900)]
    rows += [(900 + i, [1.0, *map(float, 0.01 * rng.standard_normal(2))], 1) for i in range(90)]
    assert found(spark, rows, block=16) == sorted(((i, 989, 0, i == 0) for i in range(990)), key=str)
    frame = pd.DataFrame({"node": range(40), "n": 1, "unit": [embeddings.unit_bytes(np.array([1.0, 0.0]))] * 40, "is_left": True})
    assert len(embeddings._verifier(2, 0.98)((0, 0, 0, 0), frame)) == 40


def test_unsound_vectors_nulls_and_repeats(spark):
    one, nan, inf = [1.0, 0.0], float("nan"), float("inf")
    rows = [(1, one, 1), (2, one, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1),
            (9, one, 1), (9, one, 1), (None, one, 1), (None, [0.0, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, one, 2), (12, [-1.0, -0.0], 1),
            (13, [1e300, -0.0], 1), (14, [1e-300, 0.0], 1)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert (1, 5, 1, True) in got and (None, 0, None, True) in got and (None, 5, 1, False) in got


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1)]
    extra = spark.createDataFrame([(*r, "x", 5, "y") for r in rows], SCHEMA + ", node string, kind int, at string")
    assert sorted(tuple(r) for r in embeddings.near_duplicates(extra).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
