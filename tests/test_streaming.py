"""Structured Streaming: stream == batch on closed windows, restart safety,
late data, dedup, session windows and the upsert sink."""

import json
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporion.operators import attribution, ingest, sessions, staging, windows
from emporion.plans import queries as Q
from emporion.streaming import jobs, joins, relational, sinks, sources


def _write_feed(df, path, days_per_file=8, shuffled=False):
    """Kafka-shaped rows as one Parquet folder per time slice (time order)."""
    d = df.withColumn("_day", F.dayofmonth("timestamp"))
    starts = list(range(1, 32, days_per_file))
    for i, lo in enumerate(starts):
        part = d.filter((F.col("_day") >= lo) & (F.col("_day") < lo + days_per_file)).drop("_day")
        part.coalesce(1).write.parquet(f"{path}/f{i:02d}")
    return len(starts)


@pytest.fixture(scope="module")
def order_feed(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("orders_feed"))
    _write_feed(Q.order_topic_rows(spark, SF_SMALL), p)
    return p


@pytest.fixture(scope="module")
def click_feed(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("clicks_feed"))
    _write_feed(Q.click_topic_rows(spark, SF_SMALL), p)
    return p


def _paths(root, sessions_path=False):
    return jobs.StreamPaths(lake=f"{root}/lake", landing=f"{root}/landing", rejected=f"{root}/rejected",
                            aggregates=f"{root}/agg", checkpoint_root=f"{root}/ck",
                            sessions=f"{root}/sessions" if sessions_path else None)


def _closed(df, max_ts, delay_minutes):
    return df.filter(F.col("window_end") <= F.lit(max_ts) - F.expr(f"INTERVAL {delay_minutes} MINUTES"))


def _cmp(a, b, cols):
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    return ra, rb


ORDER_COLS = ["window_start", "window_end", "category", "shipping_state", "order_count", "total_revenue",
              "avg_order_value", "total_items_sold", "unique_customers"]


def test_orders_job_matches_batch(spark, order_feed, scratch):
    paths = _paths(scratch)
    job = jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True)
    job.wait()
    lake = spark.read.parquet(paths.lake)
    batch_valid = ingest.valid_orders(ingest.parse_orders(Q.order_topic_rows(spark, SF_SMALL)))
    assert lake.count() == batch_valid.count()
    assert lake.rdd.getNumPartitions() >= 1 and "event_date" in lake.columns
    landing = spark.read.parquet(paths.landing)
    assert landing.count() == lake.count() and "event_date" not in landing.drop("batch_id").columns
    assert lake.count() + spark.read.parquet(paths.rejected).count() == Q.order_topic_rows(spark, SF_SMALL).count()
    rejected = spark.read.parquet(paths.rejected)
    assert rejected.count() == ingest.rejected_orders(ingest.parse_orders(Q.order_topic_rows(spark, SF_SMALL))).count()

    stream_agg = spark.read.parquet(paths.aggregates).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    max_ts = batch_valid.agg(F.max("event_timestamp")).first()[0].replace(tzinfo=None)
    b = windows.order_windows(ingest.to_money(batch_valid, ["order_total"]))
    b = b.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
         .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    ra, rb = _cmp(stream_agg, _closed(b, max_ts, 10), ORDER_COLS)
    assert len(ra) > 5000
    assert ra == rb


def test_restart_from_checkpoint_no_duplicates(spark, order_feed, scratch):
    paths = _paths(scratch)

    def run():
        jobs.start_orders_job(sources.file_topic(spark, order_feed, max_files_per_trigger=1), paths, available_now=True).wait()
        return spark.read.parquet(paths.lake).count()

    first = run()
    # second run on the same checkpoint: nothing new to read, nothing re-written
    assert run() == first
    # a replayed foreachBatch batch overwrites its own folder
    w = sinks.idempotent_batch_writer(f"{scratch}/once")
    df = spark.read.parquet(paths.lake).drop("batch_id").limit(10)
    w(df, 7)
    w(df, 7)
    assert spark.read.parquet(f"{scratch}/once").count() == 10


def _topic(spark, events):
    """Order events as topic rows, in the given order."""
    base = {"event_type": "ORDER_PLACED", "customer_id": "C1", "product_id": "P1", "product_name": "n", "category": "c",
            "quantity": 1, "unit_price": 5.0, "order_total": 5.0, "order_status": "PLACED", "shipping_state": "s",
            "payment_method": "p"}
    rows = [(bytearray(b"k"), bytearray(json.dumps({**base, **e}).encode()), "orders", 0, i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long").select(
        "*", F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))


@pytest.mark.parametrize("update_mode", [False, True])
def test_raw_sinks_keep_late_events_and_second_states(spark, scratch, update_mode):
    """An event far behind the watermark and another state of one order reach
    lake and landing; only the windows leave the late event out."""
    at = "2024-01-01T{}:00+00:00".format
    files = [[{"order_id": "A", "event_timestamp": at("10:00")}],
             [{"order_id": "B", "event_timestamp": at("12:00")}],
             [{"order_id": "C", "event_timestamp": at("13:00")}],
             [{"order_id": "LATE", "event_timestamp": at("10:01")},
              {"order_id": "C", "event_timestamp": at("13:01"), "order_status": "SHIPPED"},
              {"order_id": "BIG", "event_timestamp": at("13:02"), "order_total": 1e12}, {"order_id": None, "event_timestamp": at("13:02")}],
             [{"order_id": "D", "event_timestamp": at("14:00")}]]
    for i, events in enumerate(files):
        _topic(spark, events).coalesce(1).write.parquet(f"{scratch}/feed/f{i}")
    paths = _paths(scratch)
    jobs.start_orders_job(sources.file_topic(spark, f"{scratch}/feed"), paths, available_now=True, update_mode=update_mode).wait()
    for where in (paths.lake, paths.landing):
        got = sorted((r.order_id, r.order_status, float(r.order_total)) for r in spark.read.parquet(where).collect())
        assert got == sorted([("A", "PLACED", 5.0), ("B", "PLACED", 5.0), ("C", "PLACED", 5.0), ("LATE", "PLACED", 5.0),
                              ("C", "SHIPPED", 5.0), ("BIG", "PLACED", 1e12), ("D", "PLACED", 5.0)])
    assert spark.read.parquet(paths.rejected).count() == 1
    rows = (jobs.current_order_windows(spark, paths.aggregates) if update_mode else spark.read.parquet(paths.aggregates)).collect()
    counts = {r.window_start.strftime("%H:%M"): r.order_count for r in rows}
    assert counts["10:00"] == 1 and counts["12:00"] == 1 and counts["13:00"] == 3


class FakeConnection:
    """Notes the statements; a ledger kept as the statements say."""
    log, ledger, fail = [], {}, None

    def __init__(self, spark, url, properties):
        self.open = []

    def execute(self, sql):
        if FakeConnection.fail and FakeConnection.fail in sql:
            raise RuntimeError("lost connection")
        self.open.append(sql)

    def query(self, sql):
        return FakeConnection.ledger.get(re.search(r"'(.*)'", sql)[1])

    def commit(self):
        FakeConnection.log.append(self.open)
        for sql in self.open:
            if m := re.search(r"VALUES \('(.*)', (\d+)\)", sql):
                FakeConnection.ledger[m[1]] = int(m[2])

    def rollback(self):
        FakeConnection.log.append("rollback")

    def close(self):
        FakeConnection.log.append("close")


@pytest.fixture()
def jdbc(monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    FakeConnection.log, FakeConnection.ledger, FakeConnection.fail, staged = [], {}, None, []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None:
                        staged.append((url, table, mode, sorted(self._df.columns), self._df.count())))
    target = relational.JdbcTarget("jdbc:test:db", "shop_", {"user": "u"}, FakeConnection)
    target.staged = staged
    return target


def _said(needle):
    return [sql for entry in FakeConnection.log if isinstance(entry, list) for sql in entry if needle in sql]


@pytest.mark.parametrize("update_mode", [False, True])
def test_relational_landing_is_wired(spark, order_feed, scratch, jdbc, update_mode):
    paths = _paths(scratch)
    jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True, update_mode=update_mode, jdbc=jdbc).wait()
    assert {t for _, t, _, _, _ in jdbc.staged} == {'"shop_landing_staging"', '"shop_aggregates_staging"'}
    landed = sum(n for _, t, _, _, n in jdbc.staged if "landing" in t)
    assert landed == spark.read.parquet(paths.landing).count()
    assert _said('DELETE FROM "shop_landing" WHERE "batch_id" = 0') and _said('INSERT INTO "shop_landing" (')
    if update_mode:  # by key, newest batch noted
        assert all("EXISTS" in sql and '"window_start" IS NOT DISTINCT FROM "shop_aggregates"."window_start"' in sql for sql in _said('DELETE FROM "shop_aggregates"'))
        batches = {int(p.split("=")[1]) for p in os.listdir(paths.aggregates) if p.startswith("batch_id=")}
        assert FakeConnection.ledger["shop_aggregates"] <= max(batches) and len(_said("EXISTS")) >= 3
    else:
        assert _said('DELETE FROM "shop_aggregates" WHERE "batch_id" = 1') and not FakeConnection.ledger


def test_upsert_batches_hold_the_windows_they_touch(spark, scratch, jdbc, monkeypatch):
    """Applied in order by key, the staged rows end as the batch result."""
    at = "2024-01-01T{}:00+00:00".format
    files = [[{"order_id": "A", "event_timestamp": at("10:00")}, {"order_id": "B", "event_timestamp": at("10:07")}],
             [{"order_id": "C", "event_timestamp": at("10:01"), "customer_id": "C2"}], [{"order_id": "D", "event_timestamp": at("10:08")}]]
    for i, events in enumerate(files):
        _topic(spark, events).coalesce(1).write.parquet(f"{scratch}/feed/f{i}")
    table, seen = {}, []

    def upsert(df, name, keys, batch_id):
        rows = df.collect()
        seen.append(len(rows))
        table.update({tuple(r[k] for k in keys): r for r in rows})
        return True

    monkeypatch.setattr(jdbc, "upsert", upsert)
    monkeypatch.setattr(jdbc, "append", lambda *a, **k: None)
    paths = _paths(scratch)
    jobs.start_orders_job(sources.file_topic(spark, f"{scratch}/feed"), paths, available_now=True, update_mode=True, jdbc=jdbc).wait()
    assert seen == [2, 1, 1]
    want = jobs.current_order_windows(spark, paths.aggregates).collect()
    assert sorted(map(str, table.values())) == sorted(map(str, want)) and {r.order_count for r in want} == {2}


def test_relational_statements_for_first_run_replay_and_update(spark, jdbc):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert jdbc.upsert(df, "t", ["k"], 4) and jdbc.upsert(df, "t", ["k"], 4)  # a replay of the newest batch writes it again
    first = FakeConnection.log[0]
    assert first == ['CREATE TABLE IF NOT EXISTS "shop_batches" (target VARCHAR(200), batch_id BIGINT, PRIMARY KEY (target))',
                     'CREATE TABLE IF NOT EXISTS "shop_t" AS SELECT * FROM "shop_t_staging" WHERE 1 = 0',
                     'DELETE FROM "shop_t" WHERE EXISTS (SELECT 1 FROM "shop_t_staging" s WHERE s."k" IS NOT DISTINCT FROM "shop_t"."k")',
                     'INSERT INTO "shop_t" ("k", "v") SELECT "k", "v" FROM "shop_t_staging"',
                     "DELETE FROM \"shop_batches\" WHERE target = 'shop_t'",
                     "INSERT INTO \"shop_batches\" (target, batch_id) VALUES ('shop_t', 4)"]
    assert FakeConnection.log[2] == first and FakeConnection.log[1] == "close"
    assert jdbc.upsert(df, "t", ["k"], 5) and not jdbc.upsert(df, "t", ["k"], 3)  # a late replay changes nothing
    assert FakeConnection.log[-2] == first[:1] and FakeConnection.ledger == {"shop_t": 5}
    # an hour run twice: the same delete and insert both times
    FakeConnection.log.clear()
    for _ in range(2):
        jdbc.append(df, "h", "2024-01-03T05:00:00+00:00", scope="hour's")
    assert FakeConnection.log[0] == FakeConnection.log[2] and FakeConnection.log[0][1] == 'DELETE FROM "shop_h" WHERE "hour\'s" = \'2024-01-03T05:00:00+00:00\''
    # nothing of a batch stays when a statement fails
    FakeConnection.log.clear()
    FakeConnection.fail = "INSERT"
    with pytest.raises(RuntimeError):
        jdbc.append(df, "h", 7)
    assert FakeConnection.log == ["rollback", "close"]


def test_late_rows_are_dropped_and_counted(spark, scratch):
    rows = Q.order_topic_rows(spark, SF_SMALL)
    feed = f"{scratch}/late"
    # late rows are filtered with the previous batch's watermark (one batch
    # of lag): the early days arrive two batches after the watermark moved
    rows.filter(F.dayofmonth("timestamp") >= 20).coalesce(1).write.parquet(f"{feed}/f0")
    rows.filter(F.dayofmonth("timestamp") >= 29).coalesce(1).write.parquet(f"{feed}/f1")
    rows.filter(F.dayofmonth("timestamp") < 10).coalesce(1).write.parquet(f"{feed}/f2")
    valid = ingest.valid_orders(ingest.parse_orders(sources.file_topic(spark, feed))).withWatermark(
        "event_timestamp", "10 minutes")
    agg = windows.order_windows(valid)
    q = (agg.writeStream.outputMode("append").format("memory").queryName("late_windows")
            .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in p.get("stateOperators", []))
    assert dropped > 0
    out = spark.table("late_windows")
    assert out.filter(F.dayofmonth("window_start") < 10).count() == 0


def test_dedup_within_watermark(spark, order_feed, scratch):
    feed = f"{scratch}/dup"
    shutil.copytree(order_feed, feed)
    shutil.copytree(f"{order_feed}/f00", f"{feed}/f00_redelivered")  # producer retry: same events again
    paths = _paths(scratch)
    job = jobs.start_orders_job(sources.file_topic(spark, feed, max_files_per_trigger=None), paths,
                                available_now=True, dedupe=True)
    job.wait()
    lake = spark.read.parquet(paths.lake)
    assert lake.count() > lake.dropDuplicates(["order_id"]).count()  # raw sinks keep every delivery
    one = _paths(f"{scratch}/one")
    jobs.start_orders_job(sources.file_topic(spark, order_feed, max_files_per_trigger=None), one, available_now=True, dedupe=True).wait()
    ra, rb = _cmp(spark.read.parquet(paths.aggregates), spark.read.parquet(one.aggregates), ORDER_COLS)
    assert len(ra) > 5000 and ra == rb  # the windows count each event once
    # early updates too: two chained queries, closed windows as above
    early = _paths(f"{scratch}/early")
    jobs.start_orders_job(sources.file_topic(spark, feed, max_files_per_trigger=None), early, available_now=True, dedupe=True, update_mode=True).wait()
    now = jobs.current_order_windows(spark, early.aggregates)
    last = spark.read.parquet(one.aggregates).agg(F.max("window_end")).first()[0]
    ra, _ = _cmp(now.where(F.col("window_end") <= F.lit(last)), now.limit(0), ORDER_COLS)
    assert ra == rb


def test_clicks_job_funnel_and_sessions(spark, click_feed, scratch):
    paths = _paths(scratch, sessions_path=True)
    job = jobs.start_clicks_job(sources.file_topic(spark, click_feed), paths, available_now=True)
    job.wait()
    valid = ingest.valid_clicks(ingest.parse_clicks(Q.click_topic_rows(spark, SF_SMALL)))
    max_ts = valid.agg(F.max("event_timestamp")).first()[0].replace(tzinfo=None)
    cols = ["window_start", "window_end", "device_type", "referrer", "page_views", "product_views", "add_to_cart",
            "checkout_starts", "checkouts", "unique_sessions", "unique_users", "conversion_rate_pct"]
    s = spark.read.parquet(paths.aggregates)
    b = windows.funnel_windows(valid)
    ntz = lambda d: d.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))
    ra, rb = _cmp(ntz(s), _closed(ntz(b), max_ts, 15), cols)
    assert len(ra) > 500 and ra == rb
    ss = ntz(spark.read.parquet(paths.sessions))
    bs = ntz(sessions.click_session_windows(valid))
    scols = ["session_id", "customer_id", "window_start", "window_end", "event_count", "conversions"]
    ra, rb = _cmp(ss, _closed(bs, max_ts, 15), scols)
    assert len(ra) > 500 and ra == rb


def test_update_mode_upsert_keeps_latest(spark, order_feed, scratch):
    paths = _paths(scratch)
    job = jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True,
                                update_mode=True)
    job.wait()
    keys = ["window_start", "window_end", "category", "shipping_state"]
    cur = jobs.current_order_windows(spark, paths.aggregates)
    assert cur.count() == cur.dropDuplicates(keys).count()
    batch = windows.order_windows(ingest.to_money(
        ingest.valid_orders(ingest.parse_orders(Q.order_topic_rows(spark, SF_SMALL))), ["order_total"]))
    assert cur.count() == batch.count()
    ra, rb = _cmp(cur, batch, ["window_start", "category", "shipping_state", "order_count", "unique_customers",
                                "total_revenue", "avg_order_value"])
    assert ra == rb


def test_inventory_job(spark, scratch):
    feed = f"{scratch}/inv"
    _write_feed(Q.inventory_topic_rows(spark, SF_SMALL), feed)
    paths = _paths(scratch)
    job = jobs.start_inventory_job(sources.file_topic(spark, feed), paths, available_now=True)
    job.wait()
    assert spark.read.parquet(paths.lake).count() == Q.inventory_topic_rows(spark, SF_SMALL).count()
    assert "stock_after" in spark.read.parquet(paths.lake).columns


def _click_topic(spark, events):
    base = {"event_type": "PAGE_VIEW", "page": "/p", "device_type": "mobile", "browser": "b", "referrer": "google"}
    rows = [(bytearray(b"k"), bytearray(json.dumps({**base, **e}).encode()), "clicks", 0, i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long").select(
        "*", F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))


def test_stream_attribution_ends_as_batch(spark, scratch):
    """Orders come before, between and after the clicks of their sessions; each
    ends with the row that the batch model gives it."""
    at = "2024-01-0{}:00+00:00".format
    click = lambda e, s, c, t, **k: {"event_id": e, "session_id": s, "customer_id": c, "event_timestamp": at(t), **k}
    order = lambda o, c, t: {"order_id": o, "customer_id": c, "event_timestamp": at(t)}
    feeds = [([order("gap", "C1", "2T11:00"), order("none", "C9", "2T09:20")], [click("e1", "S1", "C1", "2T10:00")]),
             ([order("near", "C2", "2T09:20")], [click("e2", "S1", "C1", "2T12:00", event_type="CHECKOUT_COMPLETE"), click("e4", "S3", "C2", "2T09:00")]),
             ([order("midnight", "C1", "3T00:05")], [click("e3", "S2", "C1", "2T23:50"), click("e5", "S4", "C2", "2T09:10"), click("e6", "S2", "C1", "3T00:01")])]
    orders, clicks = _paths(f"{scratch}/o"), _paths(f"{scratch}/c")
    seen = []
    for i, (o, c) in enumerate(feeds):
        _topic(spark, o).coalesce(1).write.parquet(f"{scratch}/of/f{i}")
        _click_topic(spark, c).coalesce(1).write.parquet(f"{scratch}/cf/f{i}")
        jobs.start_orders_job(sources.file_topic(spark, f"{scratch}/of"), orders, available_now=True).wait()
        jobs.start_clicks_job(sources.file_topic(spark, f"{scratch}/cf"), clicks, available_now=True).wait()
        jobs.start_attribution_job(spark, orders.lake, clicks.lake, f"{scratch}/attributed", f"{scratch}/ck", available_now=True).wait()
        seen.append({r.order_id: (r.session_id, r.session_outcome) for r in joins.current_attribution(spark, f"{scratch}/attributed").collect()})
    assert seen[0] == {"gap": (None, None), "none": (None, None)}  # the session's later click has not come
    assert seen[1]["gap"] == ("S1", "CONVERTED") and seen[1]["near"][0] == "S3"
    assert {k: v[0] for k, v in seen[2].items()} == {"gap": "S1", "midnight": None, "near": "S4", "none": None}
    want = attribution.orders_enriched(staging.stg_orders(spark.read.parquet(orders.lake)),
                                       sessions.user_sessions(staging.stg_clickstream(spark.read.parquet(clicks.lake))))
    got = joins.current_attribution(spark, f"{scratch}/attributed").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # nothing new: nothing is written
    jobs.start_attribution_job(spark, orders.lake, clicks.lake, f"{scratch}/attributed", f"{scratch}/ck", available_now=True).wait()
    assert len([p for p in os.listdir(f"{scratch}/attributed") if p.startswith("batch_id")]) == 3


def test_funnel_update_mode_upsert(spark, click_feed, scratch):
    paths = _paths(scratch)
    job = jobs.start_clicks_job(sources.file_topic(spark, click_feed), paths, available_now=True, update_mode=True)
    job.wait()
    cur = jobs.current_funnel_windows(spark, paths.aggregates)
    batch = windows.funnel_windows(ingest.valid_clicks(ingest.parse_clicks(Q.click_topic_rows(spark, SF_SMALL))))
    cols = ["window_start", "device_type", "referrer", "page_views", "checkouts", "unique_sessions", "unique_users",
            "conversion_rate_pct"]
    ra, rb = _cmp(cur, batch, cols)
    assert len(ra) > 500 and ra == rb


def test_raw_fanout_is_replay_safe(spark, order_feed, scratch):
    paths = _paths(scratch)
    job = jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True)
    job.wait()
    batch_parsed = ingest.parse_orders(Q.order_topic_rows(spark, SF_SMALL))
    lake = spark.read.parquet(paths.lake)
    n_lake = lake.count()
    assert n_lake == ingest.valid_orders(batch_parsed).count()
    assert set(lake.columns) >= {"event_date", "batch_id", "order_id"}
    assert spark.read.parquet(paths.landing).count() == n_lake
    assert spark.read.parquet(paths.rejected).count() == ingest.rejected_orders(batch_parsed).count()
    # replay of batch 0 rewrites its own partitions only
    fan = sinks.raw_fanout_writer(paths.lake, paths.landing, paths.rejected,
                                  lambda b: ingest.to_money(ingest.valid_orders(b), ["unit_price", "order_total"]),
                                  ingest.rejected_orders)
    first = ingest.parse_orders(spark.read.parquet(f"{order_feed}/f00"))
    fan(first, 0)
    assert spark.read.parquet(paths.lake).count() == n_lake
    # the window query is the only other reader and still equals batch
    assert spark.read.parquet(paths.aggregates).count() > 5000


def test_resume_after_partial_run_equals_one_run(spark, order_feed, scratch):
    feed = f"{scratch}/feed"
    os.makedirs(feed)
    parts = sorted(os.listdir(order_feed))
    for p in parts[:2]:
        shutil.copytree(f"{order_feed}/{p}", f"{feed}/{p}")
    paths = _paths(scratch)
    jobs.start_orders_job(sources.file_topic(spark, feed), paths, available_now=True).wait()
    half = spark.read.parquet(paths.lake).count()
    for p in parts[2:]:
        shutil.copytree(f"{order_feed}/{p}", f"{feed}/{p}")
    # a new job on the same checkpoints continues where the first stopped
    jobs.start_orders_job(sources.file_topic(spark, feed), paths, available_now=True).wait()
    lake = spark.read.parquet(paths.lake)
    assert half < lake.count()

    one = _paths(f"{scratch}/one")
    jobs.start_orders_job(sources.file_topic(spark, order_feed), one, available_now=True).wait()
    assert lake.count() == spark.read.parquet(one.lake).count()
    ra, rb = _cmp(spark.read.parquet(paths.aggregates), spark.read.parquet(one.aggregates), ORDER_COLS)
    assert len(ra) > 5000 and ra == rb


def test_observed_metrics_in_progress(spark, order_feed, scratch):
    paths = _paths(scratch)
    job = jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True)
    job.wait()
    seen = [p["observedMetrics"]["parsed_orders"]["rows"] for p in job.queries[0].recentProgress
            if p.get("observedMetrics", {}).get("parsed_orders")]
    assert sum(seen) == Q.order_topic_rows(spark, SF_SMALL).count() > 0


def test_upsert_keeps_current_rows(spark, scratch):
    w = sinks.keyed_upsert_writer(f"{scratch}/agg")
    w(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    w(spark.createDataFrame([("a", 2)], "k string, v int"), 1)
    w(spark.createDataFrame([("b", 3), ("c", 3)], "k string, v int"), 2)
    w(spark.createDataFrame([], "k string, v int"), 3)
    assert {r.k: r.v for r in sinks.current_rows(spark, f"{scratch}/agg", ["k"]).collect()} == {"a": 2, "b": 3, "c": 3}


def test_disorder_within_watermark_is_not_lost(spark, scratch):
    rows = Q.order_topic_rows(spark, SF_SMALL)
    # file k holds rows whose time minus a per-row jitter (0..299 s) falls in slice k, so rows reach
    # the stream up to 5 minutes older than the previous micro-batch's newest row (watermark: 10 min)
    jitter = F.abs(F.hash(F.col("offset"))) % 300
    slice_ = F.floor((F.unix_timestamp("timestamp") - jitter) / (4 * 86400))
    d = rows.withColumn("_s", slice_.cast("int"))
    feed = f"{scratch}/jitter"
    for i, s in enumerate(sorted(r[0] for r in d.select("_s").distinct().collect())):
        d.filter(F.col("_s") == s).drop("_s").coalesce(1).write.parquet(f"{feed}/f{i:02d}")
    valid = ingest.valid_orders(ingest.parse_orders(sources.file_topic(spark, feed))).withWatermark(
        "event_timestamp", "10 minutes")
    q = (windows.order_windows(valid).writeStream.outputMode("append").format("memory").queryName("jitter_w")
            .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in p.get("stateOperators", []))
    assert dropped == 0
    batch_valid = ingest.valid_orders(ingest.parse_orders(rows))
    max_ts = batch_valid.agg(F.max("event_timestamp")).first()[0].replace(tzinfo=None)
    ntz = lambda x: x.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))
    ra, rb = _cmp(ntz(spark.table("jitter_w")), _closed(ntz(windows.order_windows(batch_valid)), max_ts, 10),
                  ORDER_COLS)
    assert len(ra) > 5000 and ra == rb


def test_hour_slice_on_stream_written_lake(spark, order_feed, scratch):
    from datetime import datetime

    from emporion.operators import hourly
    paths = _paths(scratch)
    jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True).wait()
    lake = spark.read.parquet(paths.lake)
    assert dict(lake.dtypes)["event_timestamp"] == "timestamp"          # instants, as parsed
    start = datetime(2024, 1, 3, 5)
    expected = Q.lake_orders_df(spark, SF_SMALL).filter(
        (F.col("event_timestamp") >= F.lit("2024-01-03 05:00:00").cast("timestamp_ntz"))
        & (F.col("event_timestamp") < F.lit("2024-01-03 06:00:00").cast("timestamp_ntz"))).count()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            sl = hourly.read_hour_slice(spark, paths.lake, start)
            assert sl.count() == expected > 0, tz
            labels = {r[0] for r in hourly.hourly_revenue(sl).select("processing_hour").distinct().collect()}
            assert labels == {"2024-01-03T05:00:00+00:00"}, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clicks_resume_after_partial_run_equals_one_run(spark, click_feed, scratch):
    feed = f"{scratch}/feed"
    os.makedirs(feed)
    parts = sorted(os.listdir(click_feed))
    for p in parts[:2]:
        shutil.copytree(f"{click_feed}/{p}", f"{feed}/{p}")
    paths = _paths(scratch, sessions_path=True)
    jobs.start_clicks_job(sources.file_topic(spark, feed), paths, available_now=True).wait()
    for p in parts[2:]:
        shutil.copytree(f"{click_feed}/{p}", f"{feed}/{p}")
    jobs.start_clicks_job(sources.file_topic(spark, feed), paths, available_now=True).wait()
    one = _paths(f"{scratch}/one", sessions_path=True)
    jobs.start_clicks_job(sources.file_topic(spark, click_feed), one, available_now=True).wait()
    fcols = ["window_start", "device_type", "referrer", "page_views", "checkouts", "unique_sessions", "unique_users"]
    ra, rb = _cmp(spark.read.parquet(paths.aggregates), spark.read.parquet(one.aggregates), fcols)
    assert len(ra) > 500 and ra == rb
    scols = ["session_id", "customer_id", "window_start", "window_end", "event_count"]
    ra, rb = _cmp(spark.read.parquet(paths.sessions), spark.read.parquet(one.sessions), scols)
    assert len(ra) > 500 and ra == rb


def test_window_state_is_evicted_and_survives_a_restart(spark, order_feed, scratch):
    """State holds only windows that the watermark has not closed, and a restart without new rows leaves it as it was."""
    paths = _paths(scratch)

    def run():
        jobs.start_orders_job(sources.file_topic(spark, order_feed), paths, available_now=True).wait()

    def state():
        # operators are numbered from the sink: 1 holds the parts per customer
        rows = (spark.read.format("statestore").option("operatorId", 1).load(f"{paths.checkpoint_root}/agg")
                .select(F.to_json("key").alias("key"), F.to_json("value").alias("value"), "key.customer_id", F.col("key.window.end").alias("until")).collect())
        return sorted((r["key"], r["value"]) for r in rows), [r["until"] for r in rows]

    run()
    kept, ends = state()
    batch = ingest.valid_orders(ingest.parse_orders(Q.order_topic_rows(spark, SF_SMALL)))
    newest = batch.agg(F.max("event_timestamp")).first()[0]
    (watermark,) = spark.range(1).select((F.lit(newest) - F.expr("INTERVAL 10 MINUTES")).alias("w")).first()
    started = windows.order_parts(batch).select("window").distinct().collect()
    # far fewer windows than were ever open, none of them closed
    assert 0 < len(set(ends)) < len(started) and min(ends) > watermark
    run()
    assert state()[0] == kept
