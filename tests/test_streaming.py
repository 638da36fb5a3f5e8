from __future__ import annotations

import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harness.canonical import Inputs
from harness.queries import HOT_ITEM_SCHEMA, HOT_ORDER_SCHEMA
from tallyloft import schemas as S
from tallyloft.operators import fx
from tallyloft.operators.joins import hot_keys
from tallyloft.plans import hot_marts
from tallyloft.sources import bronze
from tallyloft.streaming import decode, marts as stream_marts, messages, orders, runner, sinks
from tallyloft.streaming.enrich import enrich, with_fresh_stores

SF = "/root/testdata/sf0.001"
RAW_SCHEMA = S.T.StructType([
    S.T.StructField("key", S.STR), S.T.StructField("value", S.T.BinaryType()), S.T.StructField("arrived_at", S.TS)])


def event(serial="O-1", ts="01-01-2024 00:00:00", kind="ORDER", store=1, quantity=2, price=10.0, group="g", **changes):
    body = dict(
        event_type=kind, order_number=1, line_item=1, order_serial=serial, order_date="01-01-2024 00:00:00",
        customerkey=5, storekey=store, productkey=3, quantity=quantity, currency_code="GBP", payment_method="CASH",
        status="CREATED", order_group_id=group, unit_price_usd=price, line_total_amount=quantity * price, event_timestamp=ts)
    body.update(changes)
    return b"\x00\x00\x00\x00\x07" + json.dumps(body).encode()


class Feed:
    """A folder of one-batch files, read one per trigger."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path / "feed"), 0
        (path / "feed").mkdir()

    def add(self, *values):
        rows = [(f"k{i}", bytearray(v), datetime(2024, 1, 1, 0, 0, 3)) for i, v in enumerate(values)]
        target = f"{self.path}/batch={self.n}"
        self.spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.parquet(target)
        self.n += 1

    def stream(self):
        return bronze.file_stream(self.spark, f"{self.path}/*", RAW_SCHEMA, max_files=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture(scope="module")
def dims(spark):
    stores = spark.createDataFrame([(0, "Online", "Online", None, None), (1, "Spain", "Soria", 10, None)],
                                   "storekey long, country string, state string, square_meters int, open_date date")
    products = spark.createDataFrame([(3, "TV", "Video", "$9")], "productkey long, product_name string, category string, unit_price_usd string")
    return stores, products


def test_frames(spark):
    good = event()
    rows = [good, good[:3], b"\x01" + good[1:], good[:40], event(kind="REFUND"), event(ts="soon"), None, event(order_serial=None)]
    raw = spark.createDataFrame([(bytearray(r) if r is not None else None,) for r in rows], "value binary")
    decoded = decode.decode(raw)
    assert [r.reason for r in decoded.select("reason").collect()] == [
        None, "short frame", "wrong magic byte", "unreadable body", "event_type not allowed", "event_timestamp unreadable",
        "short frame", "order_serial missing"]
    assert decode.good(decoded).columns == S.SALES_EVENT.names and decode.good(decoded).count() == 1
    letters = decode.rejected(decoded)
    assert letters.count() == 7 and letters.where("reason = 'event_type not allowed'").first().schema_id == 7


def test_frame_round_trip(spark):
    row = spark.range(1).select(decode.frame(F.lit("hello"), 258).alias("v")).select(
        decode.magic_byte(F.col("v")), decode.schema_id(F.col("v")), decode.body(F.col("v")).cast("string")).first()
    assert tuple(row) == ("00", 258, "hello")


def test_avro_schema_lists_every_field():
    parsed = json.loads(S.sales_event_avro())
    assert [f["name"] for f in parsed["fields"]] == S.SALES_EVENT.names
    kinds = {f["name"]: f["type"] for f in parsed["fields"]}
    assert kinds["delivery_date"] == ["null", "long"] and kinds["event_type"]["symbols"] == ["ORDER", "CANCEL", "RETURN"]


def test_item_message_text(spark, dims):
    raw = spark.createDataFrame([(bytearray(event(quantity=3, price=0.335)),)], "value binary")
    items = enrich(decode.good(decode.decode(raw)), *dims, F.lit("2024-01-01 00:00:04").cast("timestamp"))
    sent = messages.item_messages(items).first()
    assert sent.key == "O-1"
    assert list(json.loads(sent.value)) == S.ITEM_MESSAGE.names
    body = json.loads(sent.value)
    assert (body["store_country"], body["store_city"], body["processing_lag"], body["sales_channel"]) == ("Spain", "Soria", 4, "In-Store")
    assert body["event_ts"] == "2024-01-01T00:00:00.000Z" and body["product_name"] == "TV"


def test_unknown_store_and_bad_time_on_read_back(spark):
    rows = [('{"order_serial":"a","event_ts":"2024-01-01T00:00:00.000Z","quantity":1}',), ('{"order_serial":"b","event_ts":"soon"}',)]
    sent = spark.createDataFrame(rows, "value string")
    first = messages.read_items(sent).where("order_serial = 'a'").first()
    assert (first.store_country, first.processing_lag) == ("UNKNOWN", 0)
    bad = messages.unreadable(sent, messages.ITEM_TOPIC).collect()
    assert len(bad) == 1 and bad[0].reason == "event_ts unreadable"
    mixed = sent.withColumn("topic", F.lit(messages.ITEM_TOPIC)).unionByName(
        spark.createDataFrame([('{"order_group_id":"g","last_update":"2024-01-01T00:00:00.000Z"}', messages.ORDER_TOPIC)], "value string, topic string"))
    other = spark.createDataFrame([("{broken", messages.ORDER_TOPIC), (None, messages.ITEM_TOPIC), ("{}", "x"), ("{}", None)], "value string, topic string")
    items, order_rows, rejected = messages.by_topic(mixed.unionByName(other))
    assert [r.order_serial for r in items.collect()] == ["a"]
    assert order_rows.count() == 1 and order_rows.first().max_lag_seconds == 0
    assert sorted(r.reason for r in rejected.collect()) == ["event_ts unreadable"] * 2 + ["last_update unreadable"] + ["topic unknown"] * 2


def _table(tmp_path):
    return sinks.UpsertTable(str(tmp_path / "items"), messages.HOT_ITEM_KEY)


def test_item_stream_dead_letters_and_fresh_dims(spark, feed, dims, tmp_path):
    stores, products = dims
    names = iter(["Spain", "Sweden", "Sweden"])

    def read_dims():
        return stores.withColumn("country", F.when(F.col("storekey") == 1, next(names)).otherwise(F.col("country"))), products

    feed.add(event("a"), b"\x00\x01\x02")
    feed.add(event("b"))
    table = _table(tmp_path)
    writer = runner.item_batches(
        feed.stream(), read_dims, table, str(tmp_path / "dlq"), str(tmp_path / "cp"), 1, F.col("arrived_at"))
    runner.run_to_end(writer)
    rows = {r.order_serial: r for r in table.latest(spark, HOT_ITEM_SCHEMA).collect()}
    assert {k: r.store_country for k, r in rows.items()} == {"a": "Spain", "b": "Sweden"}
    assert rows["a"].processing_lag == 3
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "dlq")).collect()] == ["short frame"]


def test_restart_goes_on_where_it_stopped(spark, feed, dims, tmp_path):
    table = _table(tmp_path)

    def run():
        runner.run_to_end(runner.item_batches(
            feed.stream(), lambda: dims, table, str(tmp_path / "dlq"), str(tmp_path / "cp"), 1, F.col("arrived_at")))

    feed.add(event("a"))
    run()
    run()
    assert table.latest(spark, HOT_ITEM_SCHEMA).count() == 1
    feed.add(event("b"))
    run()
    assert sorted(r.order_serial for r in table.latest(spark, HOT_ITEM_SCHEMA).collect()) == ["a", "b"]
    assert sorted(r.batch_id for r in table.versions(spark, HOT_ITEM_SCHEMA).collect()) == [0, 1]


def test_replay_and_compaction(spark, dims, tmp_path):
    raw = spark.createDataFrame([(bytearray(event(s, quantity=q)),) for s, q in (("a", 1), ("b", 2))], "value binary")
    items = messages.hot_items(enrich(decode.good(decode.decode(raw)), *dims, F.lit("2024-01-01").cast("timestamp")))
    table = _table(tmp_path)
    table.write(items, 1, 0)
    table.write(items.where("order_serial = 'a'").withColumn("quantity", F.lit(9)), 1, 1)
    once = sorted(map(str, table.latest(spark, HOT_ITEM_SCHEMA).collect()))
    table.write(items.where("order_serial = 'a'").withColumn("quantity", F.lit(9)), 1, 1)
    assert sorted(map(str, table.latest(spark, HOT_ITEM_SCHEMA).collect())) == once
    fresh = table.compact(spark, HOT_ITEM_SCHEMA, str(tmp_path / "compacted"))
    assert sorted(map(str, fresh.latest(spark, HOT_ITEM_SCHEMA).collect())) == once
    assert fresh.versions(spark, HOT_ITEM_SCHEMA).count() == 2
    table.write(items.where("order_serial = 'b'").withColumn("quantity", F.lit(5)), 2, 0)
    assert {r.order_serial: r.quantity for r in table.latest(spark, HOT_ITEM_SCHEMA).collect()} == {"a": 9, "b": 5}
    pruned = table.latest(spark, HOT_ITEM_SCHEMA, ["Spain"])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*store_country", pruned)


def _serials(table, spark):
    return sorted((r.order_serial, r.quantity) for r in table.latest(spark, HOT_ITEM_SCHEMA).collect())


def _hot_row(serial, quantity, country="Spain"):
    return (country, "C", None, None, datetime(2024, 1, 1), serial, quantity, 1.0, 1.0, 0, 0, 0, 1, "CASH", "Online")


def test_folded_table_keeps_its_base_in_place(spark, tmp_path):
    """The base is read bucket by bucket without a shuffle, and no batch that it holds is listed."""
    table = sinks.UpsertTable(str(tmp_path / "items"), messages.HOT_ITEM_KEY, fold_every=3, buckets=8)
    want = {}
    for n in range(7):
        rows = [_hot_row(f"s{i}", n * 100 + i, ["Spain", "Peru"][i % 2]) for i in range(n, 40, n + 1)] + [_hot_row(None, n)]
        want |= {r[5]: r[6] for r in rows}
        table.write(spark.createDataFrame(rows, HOT_ITEM_SCHEMA), 1, n)
    current = {r.order_serial: r.quantity for r in table.latest(spark, HOT_ITEM_SCHEMA).collect()}
    assert current == want
    assert table._base(spark).asDict() == {"number": 2, "run_id": 1, "batch_id": 5, "buckets": 8}
    table.write(spark.createDataFrame([_hot_row("s1", -1)], HOT_ITEM_SCHEMA), 1, 5)  # replayed: the base has it
    assert {r.order_serial: r.quantity for r in table.latest(spark, HOT_ITEM_SCHEMA).collect()} == want

    files = "".join(table.latest(spark, HOT_ITEM_SCHEMA).inputFiles())
    assert "since=2/run_id=1/batch_id=6" in files and "since=1" not in files and "base=1" not in files
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.latest(spark, HOT_ITEM_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):]
    base_side = join[:join.index("Scan parquet")]
    assert "Exchange" not in base_side and "Bucketed: true" in join[len(base_side):].splitlines()[0]

    # A session that does not know the table finds base and buckets again.
    spark.sql(f"DROP TABLE {table._table_name(2)}")
    again = sinks.UpsertTable(str(tmp_path / "items"), messages.HOT_ITEM_KEY, fold_every=3, buckets=8)
    assert {r.order_serial: r.quantity for r in again.latest(spark, HOT_ITEM_SCHEMA).collect()} == want
    peru = again.latest(spark, HOT_ITEM_SCHEMA, ["Peru"])
    assert {r.store_country for r in peru.collect()} == {"Peru"} and "PartitionFilters: [isnotnull(store_country" in peru._jdf.queryExecution().toString()


def test_a_fold_that_broke_off_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = sinks.UpsertTable(str(tmp_path / "items"), messages.HOT_ITEM_KEY, fold_every=2, buckets=2)
    table.write(spark.createDataFrame([_hot_row("a", 1)], HOT_ITEM_SCHEMA), 1, 0)
    monkeypatch.setattr(spark, "createDataFrame", lambda *_: 1 / 0)
    batch = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(_hot_row("a", 2), HOT_ITEM_SCHEMA.fields)])
    with pytest.raises(ZeroDivisionError):
        table.write(batch, 1, 1)
    monkeypatch.undo()
    assert _serials(table, spark) == [("a", 2)] and table._base(spark).number == 0
    table.write(batch, 1, 1)
    assert _serials(table, spark) == [("a", 2)] and table._base(spark).number == 1


def test_stream_marts_equal_batch_marts(spark):
    """The chained windows over a plain table give what the single windows give."""
    rows = [_hot_row(f"s{i}", 1, ["Spain", "Peru"][i % 3 == 0])[:4] + (datetime(2024, 1, 1) + timedelta(minutes=i * 7919 % 6000), f"s{i}", 1, float(i % 9), 1.0,
            int(i % 11 == 0), int(i % 7 == 0 or i % 5 < i // 200), 0, 1, "CASH", "Online") for i in range(900)]
    items = spark.createDataFrame(rows, HOT_ITEM_SCHEMA)
    once, chained = hot_marts.cancel_alerts(items), stream_marts.cancel_alerts(items)
    assert once.count() > 40 and once.where("alert = 1").count() > 0
    assert once.exceptAll(chained).count() == 0 and chained.exceptAll(once).count() == 0
    single = hot_marts.net(items).groupBy(F.window("event_ts", "1 hour").alias("w")).agg(F.sum(F.col("total_sales_usd").cast("decimal(18,2)")).alias("r"))
    assert {(r[0], r[1]) for r in stream_marts.revenue_over_time(items).collect()} == {(r.w.start, r.r) for r in single.collect()}


def test_order_path_keeps_its_dead_letters(spark, feed, dims, tmp_path):
    feed.add(event("a"), b"\x00\x01", event("b", price=float("nan")))
    feed.add(event("c", ts="soon"))
    runner.run_to_end(runner.dead_letters(feed.stream(), str(tmp_path / "dlq"), str(tmp_path / "cp")))
    assert sorted(r.reason for r in spark.read.parquet(str(tmp_path / "dlq")).collect()) == [
        "event_timestamp unreadable", "short frame", "unit_price_usd no amount"]
    assert runner.order_events(spark.read.parquet(f"{feed.path}/*"), dims[0], F.col("arrived_at")).count() == 1


def test_heavy_country_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN concat('N', id % 7) ELSE 'Big' END AS store_country", "timestamp_seconds(id) AS event_ts",
        "concat('O-', id) AS order_serial", "cast(id as int) AS quantity")
    # A partition is split between the tasks that wrote it, so these must not be merged for being small.
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        _table(tmp_path).write(rows, 1, 0)
    finally:
        for name in small:
            spark.conf.unset(name)
    files = list((tmp_path / "items" / "run_id=1" / "batch_id=0" / "store_country=Big").glob("*.parquet"))
    assert len(files) > 4


def test_moving_order_keeps_one_row(spark, feed, dims, tmp_path):
    for ts in ("01-01-2024 00:00:00", "01-01-2024 00:05:00"):
        feed.add(event("x", ts=ts))
    table = sinks.UpsertTable(str(tmp_path / "orders"), messages.HOT_ORDER_KEY)
    updates = runner.order_updates(feed.stream(), dims[0], F.col("arrived_at"))
    runner.run_to_end(updates.writeStream.outputMode("update").foreachBatch(table.sink(1, messages.hot_orders))
                      .option("checkpointLocation", str(tmp_path / "cp")))
    rows = table.latest(spark, HOT_ORDER_SCHEMA).collect()
    assert len(rows) == 1 and rows[0].total_items_count == 4 and rows[0].total_order_usd == 40.0
    assert table.versions(spark, HOT_ORDER_SCHEMA).where("total_items_count IS NOT NULL").count() == 2


LATE = ["01-01-2024 12:00:00", "01-01-2024 12:30:00", "01-01-2024 13:00:00", "01-01-2024 06:00:00", "01-01-2024 14:00:00"]


def _progress(query):
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    return sum(op["numRowsRemoved"] for op in operators), sum(op["numRowsDroppedByWatermark"] for op in operators)


def test_windowed_state_is_given_up(spark, feed, dims, tmp_path):
    for i, ts in enumerate(LATE):
        feed.add(event(f"s{i}", ts=ts, group=f"g{i}"))
    events = runner.order_events(feed.stream(), dims[0], F.col("arrived_at"))
    out = str(tmp_path / "out")
    query = runner.run_to_end(sinks.parquet(orders.windowed(events), out, str(tmp_path / "cp")))
    removed, dropped = _progress(query)
    assert removed >= 3 and dropped == 1
    assert sorted(r.order_group_id for r in spark.read.parquet(out).collect()) == ["g0", "g1", "g2"]


def test_an_order_is_one_session_and_repeats_count_once(spark, feed, dims, tmp_path):
    for ts in ("01-01-2024 00:00:00", "01-01-2024 00:08:00", "01-01-2024 00:08:00", "02-01-2024 00:00:00", "02-01-2024 00:00:01"):
        feed.add(event(f"s{ts}", ts=ts), event(f"s{ts}", ts=ts))
    events = orders.once(runner.order_events(feed.stream(), dims[0], F.col("arrived_at")))
    out = str(tmp_path / "out")
    query = runner.run_to_end(sinks.parquet(orders.sessions(events, "30 minutes", lateness=None), out, str(tmp_path / "cp")))
    rows = spark.read.parquet(out).collect()
    assert [(r.total_items_count, r.total_order_usd) for r in rows] == [(4, 40.0)]
    assert _progress(query)[0] >= 1


def test_running_state_is_kept(spark, feed, dims, tmp_path):
    for i, ts in enumerate(LATE):
        feed.add(event(f"s{i}", ts=ts, group=f"g{i}"))
    seen = str(tmp_path / "seen")
    updates = runner.order_updates(feed.stream(), dims[0], F.col("arrived_at"))
    query = runner.run_to_end(
        updates.writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("append").parquet(seen))
        .option("checkpointLocation", str(tmp_path / "cp")))
    assert _progress(query) == (0, 0)
    assert spark.read.parquet(seen).select("order_group_id").distinct().count() == 5


def test_repeated_delivery_is_dropped(spark, feed, dims, tmp_path):
    feed.add(event("a"), event("a"), event("b"))
    feed.add(event("a"), event("c"))
    events = runner.order_events(feed.stream(), dims[0], F.col("arrived_at"))
    out = str(tmp_path / "out")
    runner.run_to_end(sinks.parquet(orders.once(events).select("order_serial"), out, str(tmp_path / "cp")))
    assert sorted(r.order_serial for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_equals_batch_over_shuffled_files(spark, tmp_path):
    x = Inputs(spark, SF)
    parts = str(tmp_path / "parts")
    x.load("events").repartition(6).write.parquet(parts)
    stream = x.frames_of(bronze.file_stream(spark, parts, x.load("events").schema, max_files=1))
    updates = runner.order_updates(stream, x.stores, F.col("arrived_at"))
    table = sinks.UpsertTable(str(tmp_path / "orders"), messages.HOT_ORDER_KEY)
    runner.run_to_end(updates.writeStream.outputMode("update").foreachBatch(table.sink(1, messages.hot_orders))
                      .option("checkpointLocation", str(tmp_path / "cp")))
    batch = messages.hot_orders(orders.running(runner.order_events(x.frames_of(x.load("events")), x.stores, F.col("arrived_at"))))
    got = table.latest(spark, HOT_ORDER_SCHEMA).select(*batch.columns)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_archive_layout(spark, feed, tmp_path):
    feed.add(event("a"), event("b"))
    out = str(tmp_path / "archive")
    runner.run_to_end(sinks.archive(feed.stream(), out, str(tmp_path / "cp"), F.col("arrived_at")))
    files = [p.name for p in (tmp_path / "archive" / "year=2024" / "month=1" / "day=1" / "hour=0").iterdir()]
    assert any(name.endswith(".snappy.parquet") for name in files)


def test_two_outputs_under_supervision(spark, feed, dims, tmp_path):
    feed.add(event("a"))
    listener = runner.Progress()
    spark.streams.addListener(listener)
    try:
        queries = []
        for name, df in (("items", messages.item_messages), ("raw", None)):
            stream = feed.stream()
            if df:
                stream = df(enrich(decode.good(decode.decode(stream)), *dims, F.col("arrived_at")))
            queries.append(sinks.parquet(stream, str(tmp_path / name), str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start())
        runner.supervise(spark, 60)
        for q in queries:
            q.awaitTermination(60)
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(str(tmp_path / "items")).count() == 1 and spark.read.parquet(str(tmp_path / "raw")).count() == 1
    assert not listener.failed


def test_true_local_amount(spark, dims):
    raw = spark.createDataFrame([(bytearray(event(quantity=2, price=10.0)),)], "value binary")
    items = enrich(decode.good(decode.decode(raw)), *dims, F.lit("2024-01-01").cast("timestamp")).withColumns({
        "order_date": F.to_date("event_ts"), "sales_usd": F.col("total_sales_usd").cast("decimal(20,2)")})
    rates = spark.sql("SELECT 'GBP' AS currency_code, DATE'2023-12-30' AS date_key, CAST(0.8 AS DECIMAL(18,6)) AS rate")
    row = fx.normalise(items, fx.daily_rates(rates, F.lit("2024-01-31").cast("date")), ["sales_usd"]).first()
    assert (row.total_sales_usd, float(row.sales_local)) == (20.0, 16.0)


def test_fresh_stores_look_through_one_slice_of_changes(spark, tmp_path):
    """An event takes the newest change of the day before it; only changes of busy stores are sent to every salt."""
    day = datetime(2024, 1, 1)
    hours = [0, 5, 24, 24.5, 30, 47, 48, 71, 96]
    changes = [(s, f"C{s}-{h}", "S", 1, None, day + timedelta(hours=h)) for s in (1, 2) for h in hours]
    events = [(f"O-{s}-{n}", "ORDER", s, day + timedelta(minutes=30 * n)) for s in (1, 2, 3, None) for n in range(200)]
    last = day + timedelta(days=9)
    change_cols = "storekey long, country string, state string, square_meters int, open_date date, changed_at timestamp"
    event_cols = "order_serial string, event_type string, storekey long, event_ts timestamp"
    for n, (e, c) in enumerate(((events, changes), ([("end", "ORDER", 1, last)], [(1, "end", "S", 1, None, last)]))):
        spark.createDataFrame(e, event_cols).coalesce(1).write.parquet(f"{tmp_path}/events/batch={n}")
        spark.createDataFrame(c, change_cols).coalesce(1).write.parquet(f"{tmp_path}/changes/batch={n}")

    def newest(store, ts):
        held = [h for h in hours if timedelta(0) <= ts - day - timedelta(hours=h) < timedelta(days=1)]
        return f"C{store}-{max(held)}" if store in (1, 2) and held else None

    want = {serial: newest(store, ts) for serial, _, store, ts in events}
    assert len(set(want.values())) > 10 and None in want.values()
    busy = hot_keys(spark.createDataFrame(events[:200] + events[400:402], event_cols).select("storekey"), ["storekey"])
    copies = {}
    for name, options in (("all", {}), ("one", {"busy": busy}), ("none", {"busy": []})):
        streams = [bronze.file_stream(spark, f"{tmp_path}/{t}/*", cols, max_files=1) for t, cols in (("events", event_cols), ("changes", change_cols))]
        query = runner.run_to_end(sinks.parquet(with_fresh_stores(*streams, **options), f"{tmp_path}/out-{name}", f"{tmp_path}/marks-{name}"))
        rows = spark.read.parquet(f"{tmp_path}/out-{name}").where("order_serial <> 'end'").collect()
        assert {r.order_serial: r.country for r in rows} == want and len(rows) == len(events)
        first = next(p for p in query.recentProgress if p["batchId"] == 0)
        copies[name] = sum(o["numRowsUpdated"] for o in first["stateOperators"] if o["operatorName"] == "symmetricHashJoin") - len(events)
    # A change at the start of a slice holds in no other one.
    slices = sum(1 if h % 24 == 0 else 2 for h in hours)
    assert copies == {"all": 2 * 8 * slices, "one": (8 + 1) * slices, "none": 2 * slices}
