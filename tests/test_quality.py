from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloft.operators import quality as Q


def test_each_defect_is_found_by_its_check(spark, frame):
    clean = spark.range(100).select("id", (F.col("id") % 5).alias("fk"), F.lit("x").alias("v"))
    dim = spark.range(5).withColumnRenamed("id", "key")
    dirty = (
        clean.where("id <> 50").unionAll(clean.where("id = 7"))
        .withColumns({"fk": F.when(F.col("id") == 3, 99).otherwise(F.col("fk")),
                      "v": F.when(F.col("id") >= 97, None).otherwise(F.col("v"))}))
    assert Q.duplicate_keys(dirty, ["id"]).collect() == [(7, 2)]
    assert {r.column_name: r.null_count for r in Q.null_counts(dirty).collect()} == {"id": 0, "fk": 0, "v": 3}
    assert [r.column_name for r in Q.null_rates(dirty).where("passed = 0").collect()] == ["v"]
    assert Q.orphans(dirty, "fk", dim, "key").collect() == [(99, 1)]
    assert {tuple(r) for r in Q.lost_rows(clean, dirty, ["id"]).collect()} == {(50, 1, 0), (7, 1, 2)}
    assert Q.lost_row_contents(clean, dirty).count() == 5
    assert Q.duplicate_keys(clean, ["id"]).count() == 0 and Q.orphans(clean, "fk", dim, "key").count() == 0
    checked = Q.results([
        Q.finding("m", "unique", "id", Q.duplicate_keys(dirty, ["id"])),
        Q.finding("m", "referential", "fk", Q.orphans(clean, "fk", dim, "key"))])
    assert Q.run_summary(checked).first() == (2, 1, 1, "m.unique.id")
    with pytest.raises(Q.GateFailed, match="m.unique"):
        Q.gate(checked)
    Q.gate(checked.where("status = 'passed'"))


def test_domains(frame):
    df = frame("kind string, n int", ("A", 1), ("Z", 1), (None, 1), ("A", None))
    good, bad = Q.split_by_domain(df, {"kind": ["A", "B"]}, ["kind", "n"])
    assert good.collect() == [("A", 1)]
    assert sorted(r.reason for r in bad.collect()) == ["kind missing", "kind not allowed", "n missing"]


def test_dictionary_coverage(frame):
    words = frame("table_name string, field_name string", ("Stores", "Square Meters"), ("Stores", "Manager"))
    real = frame("square_meters int, opened date", (1, None), (None, None))
    found = {tuple(r) for r in Q.dictionary_coverage({"Stores": real}, words, with_values=True).collect()}
    assert found == {("stores", "squaremeters", 1, 1, 1), ("stores", "manager", 1, 0, None), ("stores", "opened", 0, 1, 0)}
    names = {tuple(r) for r in Q.dictionary_coverage({"Stores": real}, words).collect()}
    assert names == {t[:4] for t in found}


def test_no_division_by_no_rows(frame):
    assert [r.null_rate for r in Q.null_rates(frame("a int")).collect()] == [0.0]
