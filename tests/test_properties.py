"""Property tests (hypothesis): the distributed operators equal their
sequential definitions on random inputs."""

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from emporion.operators import inventory

T0 = datetime(2024, 1, 1)

updates = st.lists(
    st.tuples(st.sampled_from(["P1", "P2", "P3"]), st.integers(0, 72 * 60), st.integers(-40, 40)),
    min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=updates, s0=st.integers(0, 30), chunk=st.sampled_from(["minute", "hour", "day"]))
def test_clamped_stock_equals_loop(spark, rows, s0, chunk):
    data = [(f"U{i:03d}", p, "WH-0", "ADJUSTMENT", c, T0 + timedelta(minutes=m)) for i, (p, m, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "update_id string, product_id string, warehouse_id string, "
                                     "update_type string, quantity_change int, event_timestamp timestamp_ntz")
    got = {r.update_id: r.stock_after for r in inventory.clamped_stock(df, initial_stock=s0, chunk=chunk).collect()}
    stock = defaultdict(lambda: s0)
    exp = {}
    for uid, p, _, _, c, ts in sorted(data, key=lambda r: (r[5], r[0])):
        stock[p] = max(0, stock[p] + c)
        exp[uid] = stock[p]
    assert got == exp


# ---------------------------------------------------------------- attribution

from decimal import Decimal  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from emporion.operators import attribution, windows  # noqa: E402

DAY = datetime(2024, 1, 5)

sessions_st = st.lists(st.tuples(st.sampled_from(["C1", "C2"]), st.integers(0, 2 * 24 * 60 - 1),
                                 st.integers(0, 300), st.sampled_from(["d", "m"])), min_size=0, max_size=12)
orders_st = st.lists(st.tuples(st.sampled_from(["C1", "C2", "C3"]), st.integers(0, 2 * 24 * 60 - 1)),
                     min_size=1, max_size=25)


def _brute(orders, sessions, grace=timedelta(minutes=30)):
    out = {}
    for oid, cust, ts in orders:
        best = None
        for sid, scust, start, end, dev in sessions:
            if scust == cust and start.date() == ts.date() and start <= ts <= end + grace:
                key = (abs((ts - start).total_seconds()), sid, dev)
                if best is None or key < best[0]:
                    best = (key, sid)
        out[oid] = best[1] if best else None
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sess=sessions_st, ords=orders_st, width=st.sampled_from([10, 60, 240]))
def test_attribution_equals_brute_force(spark, sess, ords, width):
    sessions = [(f"S{i:02d}", c, DAY + timedelta(minutes=m), DAY + timedelta(minutes=m + d), dev)
                for i, (c, m, d, dev) in enumerate(sess)]
    orders = [(f"O{i:02d}", c, DAY + timedelta(minutes=m, seconds=7)) for i, (c, m) in enumerate(ords)]
    s = spark.createDataFrame(
        [(sid, c, dev, "b", "r", st_, en, st_.date(), "BROWSING", 1) for sid, c, st_, en, dev in sessions],
        "session_id string, customer_id string, device_type string, browser string, referrer string, "
        "session_start timestamp_ntz, session_end timestamp_ntz, session_date date, session_outcome string, "
        "engagement_score long")
    o = spark.createDataFrame(
        [(oid, c, "P", "N", "C", 1, Decimal("1.00"), Decimal("1.00"), "PLACED", "S", "p", False, "LOW_VALUE",
          ts, ts) for oid, c, ts in orders],
        "order_id string, customer_id string, product_id string, product_name string, category string, "
        "quantity int, unit_price decimal(10,2), order_total decimal(10,2), order_status string, "
        "shipping_state string, payment_method string, is_cancelled boolean, order_value_tier string, "
        "order_placed_at timestamp_ntz, pipeline_processed_at timestamp_ntz")
    got = {r.order_id: r.session_id for r in attribution.orders_enriched(o, s, bucket_minutes=width).collect()}
    assert got == _brute(orders, sessions)


# ------------------------------------------------------ exact distinct windows

clicks_st = st.lists(st.tuples(st.integers(0, 119), st.sampled_from(["PAGE_VIEW", "PRODUCT_VIEW", "CHECKOUT_COMPLETE"]),
                               st.sampled_from(["S1", "S2", "S3"]), st.sampled_from(["C1", "C2", None]),
                               st.sampled_from(["mobile", None])), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=clicks_st)
def test_two_level_funnel_equals_count_distinct(spark, rows):
    data = [(DAY + timedelta(minutes=m), et, s, c, d, "google") for m, et, s, c, d in rows]
    df = spark.createDataFrame(data, "event_timestamp timestamp_ntz, event_type string, session_id string, "
                                     "customer_id string, device_type string, referrer string")
    got = windows.funnel_windows(df)
    exp = df.groupBy(F.window("event_timestamp", "10 minutes").alias("w"), "device_type", "referrer").agg(
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("customer_id").alias("unique_users"),
        F.count(F.when(F.col("event_type") == "PRODUCT_VIEW", 1)).alias("product_views"))
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    g = sorted((tuple(r) for r in got.select("window_start", "device_type", "unique_sessions", "unique_users",
                                             "product_views").collect()), key=key)
    e = sorted((tuple(r) for r in exp.select("w.start", "device_type", "unique_sessions", "unique_users",
                                             "product_views").collect()), key=key)
    assert g == e
