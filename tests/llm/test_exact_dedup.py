import hashlib
import re

from tallyloft.llm import exact_dedup




def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


ROWS = [(5, "a  b"), (3, "a b"), (9, "a\t\nb"), (1, None), (2, ""), (7, " "), (None, "x"), (None, "x"), (4, "x"), (6, "é"), (6, "é"),
        (None, "only null"), (8, "a\u00a0b"), (10, "long " * 50_000)]


def test_groups_match_brute_force_and_one_row_stays(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = exact_dedup.DigestIndex(spark, buckets=4).add(docs).collect()
    assert brute(ROWS) == sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in found), key=str)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.digest for r in found}) == len({r.digest for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_hot_group_and_many_rows(spark):
    rows = [(i, "hot" if i % 3 else f"t{i // 2}") for i in range(6000)]
    found = exact_dedup.DigestIndex(spark, buckets=8).add(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert brute(rows) == sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in found), key=str)


def test_later_batches_meet_the_index_again(spark, tmp_path):
    path = str(tmp_path / "index")
    first = spark.createDataFrame([(10, "a"), (11, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c")], "doc_id long, text string")
    exact_dedup.DigestIndex(spark, path, buckets=4).add(first)
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    found = {r.doc_id: (r.keep_id, r.kept) for r in again.add(second).collect()}
    assert found == {1: (10, False), 2: (2, True), 3: (2, False)}
    assert again.table().count() == 3


def test_anti_join_reads_the_index_by_bucket(spark):
    index = exact_dedup.DigestIndex(spark, buckets=16)
    index.add(spark.createDataFrame([(i, str(i)) for i in range(100)], "doc_id long, text string"))
    groups = index.table().groupBy("digest").count()
    plan = groups.join(index.table().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, digest string, keep_id int")
    assert exact_dedup.DigestIndex(spark).add(empty).count() == 0
    docs = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 2), (2, "a", "z", 3)], "doc_id long, text string, digest string, keep_id int")
    assert exact_dedup.deduplicate(docs, exact_dedup.DigestIndex(spark)).collect() == [(1, "a", "x", 1)]
    twice = docs.filter("doc_id = 2")
    left = exact_dedup.deduplicate(twice, exact_dedup.DigestIndex(spark))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]
    assert exact_dedup.deduplicate(empty, exact_dedup.DigestIndex(spark)).count() == 0
