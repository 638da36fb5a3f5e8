"""What the driver's tables become: bounded tasks, feeds by parts, gold tables on first use."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harness import canonical, queries
from harness.canonical import Inputs
from tallyloft import session

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _events(spark, path, copies=1):
    """Half a minute between events; further copies come after the first one, at the same times."""
    start = datetime(2024, 1, 1, 0, 0, 30)
    rows = [(c * 4000 + i, start + timedelta(seconds=30 * i), i % 7, "click", 1.5, "{}") for c in range(copies) for i in range(4000)]
    spark.createDataFrame(rows, EVENTS).repartitionByRange(4, "event_id").write.parquet(f"{path}/events.parquet")
    return Inputs(spark, str(path))


def events_by_part(x, parts=3):
    rows = [int(r.ts.timestamp()) + r.event_id * 37 % 240 for r in x.load("events").select("ts", "event_id").collect()]
    first, last = min(rows), max(rows)
    return [sum((s - first) * parts // (last - first + 1) == n for s in rows) for n in range(parts)]


def test_a_micro_batch_takes_a_whole_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(canonical, "FEED_ROWS", 1000)
    x = _events(spark, tmp_path, copies=3)
    parts, taken = events_by_part(x), []
    query = x.event_feed().writeStream.trigger(availableNow=True).foreachBatch(lambda batch, n: taken.append(batch.count())).option(
        "checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert taken == [*parts, 1] and sum(parts) == 12000


def test_stream_over_copies_loses_no_event(spark, tmp_path):
    """All copies of a minute count, though they stand in different files of the table."""
    x = _events(spark, tmp_path, copies=3)
    events = queries.runner.order_events(x.frames_of(x.event_feed()), spark.createDataFrame(
        [(0, "Peru", "S", None, None)], "storekey long, country string, state string, square_meters decimal(18,2), open_date date"), F.col("arrived_at"))
    totals = queries._run(x, "copies", queries.orders.windowed(events))
    assert totals.agg(F.sum("total_items_count")).first()[0] == sum(i % 5 + 1 for i in range(12000))


def test_gold_tables_are_built_on_first_use(spark, tmp_path, monkeypatch):
    built = []

    def make(name):
        return lambda star: built.append(name) or spark.range(3).withColumn("name", F.lit(name))

    monkeypatch.setattr(canonical._Published, "MAKE", {name: make(name) for name in canonical._Published.MAKE})
    monkeypatch.setattr(canonical, "_PUBLISHED", {})
    monkeypatch.setattr(Inputs, "star", None)
    x = Inputs(spark, str(tmp_path))
    assert x.published["fact_sales"].count() == x.published["dim_stores"].count() == 3
    Inputs(spark, str(tmp_path)).published["fact_sales"].count()
    assert built == ["fact_sales", "dim_stores"]
    with pytest.raises(KeyError):
        x.published["fact_of_nothing"]


def test_tasks_are_bounded_and_lower_bounds_stay(spark):
    keys = [*session.TASK_BYTES, session.FIRST_WIDTH]
    before = {k: spark.conf.get(k, None) for k in keys}
    files, advisory = session.TASK_BYTES
    try:
        spark.conf.set(files, "128MB")
        spark.conf.set(advisory, "4m")
        spark.conf.unset(session.FIRST_WIDTH)
        session.configure(spark)
        assert session._bytes(spark.conf.get(files)) == session.TASK_BYTES[files] and spark.conf.get(advisory) == "4m"
        assert int(spark.conf.get(session.FIRST_WIDTH)) == session.SHUFFLE_WIDTH
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
