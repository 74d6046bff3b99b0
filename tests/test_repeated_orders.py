"""Orders are shuffled once, narrow; only ids that may repeat are ranked."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporion.functions.expressions import order_value_tier
from emporion.operators import attribution, marts, quality, staging
from emporion.plans import queries as Q
from emporion.plans.pipeline import materialize
from emporion.sources import fixtures
from test_attribution import D, ORDER_SCHEMA, SESSION_SCHEMA, _o, _s


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    rng, base = random.Random(3), str(tmp_path_factory.mktemp("landed"))
    at = lambda: D + timedelta(minutes=rng.randrange(2 * 1440))
    customer = lambda: rng.choice([None, *(f"C{i}" for i in range(9))])
    starts = [at() for _ in range(300)]
    sessions = [_s(f"S{i % 150}", customer(), t, t + timedelta(minutes=rng.randrange(90))) for i, t in enumerate(starts)]
    orders = [_o(f"O{i % 350}", customer(), at(), total=f"{rng.randrange(9)}.00") for i in range(400)]
    timeless = [(*_o("O900", "C1", D)[:-2], None, None), (*_o("O901", None, D)[:-2], None, None)]
    spark.createDataFrame(orders + timeless, ORDER_SCHEMA).write.parquet(f"{base}/o")
    spark.createDataFrame(sessions, SESSION_SCHEMA).write.parquet(f"{base}/s")
    o = spark.read.parquet(f"{base}/o")
    attribution.repeated_orders(o).write.parquet(f"{base}/r")
    return o, spark.read.parquet(f"{base}/s"), spark.read.parquet(f"{base}/r")


def test_named_repeats_give_the_same_orders(landed):
    o, s, repeated = landed
    assert repeated.count() == 50
    want = attribution.with_defaults(attribution.match_orders_to_sessions(o, s).filter("match_rank = 1"))
    assert _rows(attribution.orders_enriched(o, s)) == _rows(want)
    assert _rows(attribution.orders_enriched(o, s, repeated=repeated)) == _rows(want)
    some = ["order_id", "order_total", "order_placed_at"]
    got = attribution.orders_enriched(o, s, repeated=repeated, columns=some)
    assert _rows(got) == _rows(want.select(got.columns)) and "product_name" not in got.columns


def test_orders_that_are_not_repeated_are_shuffled_once(landed):
    o, s, repeated = landed
    once = o.join(repeated, attribution.order_hash() == repeated["order_hash"], "left_anti")
    plan = _plan(attribution.orders_enriched(once, s, repeated=repeated.limit(0), columns=["customer_id", "order_total"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "product_name" not in plan


def test_orders_without_customer_share_no_group(spark, landed):
    o, s, _ = landed
    nobody = o.withColumn("customer_id", F.lit(None).cast("string"))
    assert attribution.orders_enriched(nobody, s).where("session_id is not null").isEmpty()
    assert _plan(attribution.latest_live_session(o, s)).count("FileScan") == 2  # orders are read once


def test_repeats_of_the_fixture(spark, scratch):
    def in_rows(sf):
        return _rows(attribution.repeated_orders(fixtures.raw_orders(spark, sf)))

    assert _rows(fixtures.repeated_orders(spark, SF_SMALL)) == in_rows(SF_SMALL)
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        fixtures.read_table(spark, SF_SMALL, name).write.parquet(f"{scratch}/{name}.parquet")
    fixtures.read_table(spark, SF_SMALL, "lineitem").limit(5).write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    assert len(in_rows(scratch)) >= 5 and _rows(fixtures.repeated_orders(spark, scratch)) == in_rows(scratch)
    clicks = fixtures.read_table(spark, SF_SMALL, "events")
    clicks.write.parquet(f"{scratch}/events.parquet")
    en = Q.enriched_df(spark, scratch)
    want = attribution.orders_enriched(Q.stg_orders_df(spark, scratch), Q.sessions_df(spark, scratch))
    assert _rows(en) == _rows(want.select(en.columns)) == _rows(Q.enriched_df(spark, SF_SMALL))
    fixtures.read_table(spark, SF_SMALL, "part").limit(3).write.mode("append").parquet(f"{scratch}/part.parquet")
    assert fixtures.repeated_orders(spark, scratch) is None
    en = Q.enriched_df(spark, scratch)
    assert en.count() == en.select("order_id").distinct().count()


def test_lineitems_meet_orders_that_know_their_customers(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(fixtures.raw_orders(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(moved) == 6 and sum("l_orderkey" in line or "l_partkey" in line for line in moved) == 2
    assert "ShuffledHashJoin [l_orderkey" in plan and "Sort [l_orderkey" not in plan  # no task sorts its lineitems for this


def test_marts_deal_the_orders_once(spark, landed):
    o, s, repeated = landed
    en = attribution.orders_enriched(o, s, repeated=repeated)
    base = _plan(en).count("Exchange hashpartitioning")
    assert _plan(marts.daily_revenue_base(en)).count("Exchange hashpartitioning") == base + 1
    assert _plan(marts.product_rolling_calendar(en)).count("Exchange hashpartitioning") == base + 1
    assert _plan(marts.customer_order_summary(marts.by_customer(en))).count("Exchange hashpartitioning") == base + 1


def test_values_that_occur_once_are_not_grouped(spark, landed, scratch):
    o, _, repeated = landed
    few = quality.maybe_repeated(o, "order_id", f"{scratch}/h")
    assert few.count() == 100
    assert _rows(quality.unique(few, "order_id")) == _rows(quality.unique(o, "order_id"))
    assert _rows(quality.written_duplicate_order_ids(o)) == _rows(quality.duplicate_order_ids(o))


def test_sweep_carries_the_session_columns_asked_for(landed):
    o, s, repeated = landed
    full = attribution.orders_enriched(o, s, repeated=repeated)
    for some in (["device_type", "attribution_channel"], ["attribution_channel"], ["session_id", "engagement_score"], []):
        got = attribution.orders_enriched(o, s, repeated=repeated, columns=["order_id", "order_total"], session_columns=some)
        assert got.columns == ["order_id", "order_total", *some] and _rows(got) == _rows(full.select(got.columns))
    once = o.join(repeated, attribution.order_hash() == repeated["order_hash"], "left_anti")
    plan = _plan(attribution.orders_enriched(once, s, repeated=repeated.limit(0), columns=["order_total"], session_columns=marts.DAILY_SESSIONS))
    assert "session_outcome" not in plan and "engagement_score" not in plan


def test_products_are_named_once(spark, scratch):
    orders, names = Q.product_orders(spark, SF_SMALL)
    assert not {"product_name", "category", "session_id"} & set(orders.columns)
    full = Q.enriched_df(spark, SF_SMALL)
    for mart in (marts.product_performance, marts.product_rolling_calendar):
        assert _rows(mart(orders, names=names)) == _rows(mart(full))
    for name in ("lineitem", "orders", "customer", "nation", "part", "events"):
        fixtures.read_table(spark, SF_SMALL, name).write.parquet(f"{scratch}/{name}.parquet")
    again = fixtures.read_table(spark, SF_SMALL, "part").limit(9).withColumn("p_name", F.lit("another"))
    again.write.mode("append").parquet(f"{scratch}/part.parquet")
    orders, names = Q.product_orders(spark, scratch)
    assert names is None and "product_name" in orders.columns  # a product of two names: the order has its own
    assert _rows(marts.product_performance(orders)) == _rows(marts.product_performance(Q.enriched_df(spark, scratch)))


@pytest.mark.parametrize("mart", [marts.daily_revenue, marts.daily_revenue_calendar])
def test_daily_marts_deal_only_what_they_count(landed, mart):
    """Cancelled orders leave before the sweep, and the tier is not dealt; of a repeated id the best match may be one that is cancelled."""
    o, s, repeated = landed
    o = (o.withColumn("is_cancelled", F.coalesce(F.minute("order_placed_at") % 3 == 0, F.lit(False)))
         .withColumn("order_total", (F.col("order_total") * 60).cast("decimal(24,2)")).withColumn("order_value_tier", order_value_tier("order_total")))
    reads = {"columns": marts.DAILY_READS, "session_columns": marts.DAILY_SESSIONS, "where": ~F.col("is_cancelled")}
    want = _rows(mart(attribution.orders_enriched(o, s)))
    assert want and _rows(mart(attribution.orders_enriched(o, s, repeated=repeated, **reads))) == want
    assert _rows(mart(attribution.orders_enriched(o, s, **reads))) == want
    once = o.join(repeated, attribution.order_hash() == repeated["order_hash"], "left_anti")
    plan = _plan(mart(attribution.orders_enriched(once, s, repeated=repeated.limit(0), **reads)))
    below = plan[plan.index("MapInArrow"):]
    assert "order_value_tier" not in plan and "is_cancelled" in below
    assert plan.count("NOT is_cancelled") == below.count("NOT is_cancelled") + 1


def test_orders_dealt_by_customer_are_the_same(spark, landed, scratch):
    """Dealt by customer alone, without carry rows: same matches, and the rows lie as a table's buckets."""
    o, s, repeated = landed
    want = _rows(attribution.orders_enriched(o, s))
    assert _rows(attribution.orders_enriched(o, s, customers=5)) == want
    assert _rows(attribution.orders_enriched(o, s, repeated=repeated, customers=5)) == want
    hot = o.withColumn("customer_id", F.when(F.col("customer_id").isNotNull(), F.lit("C1")))
    assert _rows(attribution.orders_enriched(hot, s, repeated=repeated, customers=3)) == _rows(attribution.orders_enriched(hot, s))
    long = s.withColumn("session_start", F.date_trunc("day", "session_start"))
    assert (attribution.session_candidates(long, bucket_minutes=1440).count() == long.where("customer_id IS NOT NULL").count()
            < attribution.session_candidates(long).count())
    en = attribution.orders_enriched(o, s, repeated=repeated, customers=5)
    materialize(en, f"{scratch}/t", table="t_dealt", bucket_by=(5, "customer_id"), dealt=True, codec="zstd")
    table = spark.table("t_dealt")
    assert _rows(table) == want and len([f for f in table.inputFiles() if f.endswith(".zstd.parquet")]) <= 10
    assert "Exchange" not in _plan(marts.customer_order_summary(table))
    assert _rows(marts.customer_order_summary(table)) == _rows(marts.customer_order_summary(attribution.orders_enriched(o, s)))
    spark.sql("DROP TABLE t_dealt")


def test_suite_writes_and_deals_once(spark, scratch):
    """Staged orders are written once, landed ones and clicks not at all; the customers' mart deals no orders;
    the violations are those of the whole models, counted by themselves, also where ids repeat."""
    for name in ("lineitem", "orders", "customer", "nation", "part", "events"):
        fixtures.read_table(spark, SF_SMALL, name).write.parquet(f"{scratch}/{name}.parquet")
    fixtures.read_table(spark, SF_SMALL, "lineitem").limit(9).write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    checks, found = quality.default_checks(Q.ACCEPTED), {}
    models, hashes = Q.suite_models(spark, scratch, checks, found)
    en = models["orders_enriched"]
    assert sorted(en.columns) == sorted([*Q.SUITE_READS, *marts.DAILY_SESSIONS]) and "product_name" not in en.columns
    for name in ("raw_orders", "raw_clicks", "stg_clickstream"):
        assert all("/suite/" not in f for f in models[name].inputFiles()), name
    summary = marts.customer_order_summary(en)
    assert "Exchange" not in _plan(summary) and not [t for t in spark.catalog.listTables() if t.name.startswith("suite_")]
    raw = fixtures.raw_orders(spark, scratch)
    assert {n: raw.filter(bad).count() for n, bad in quality.row_conditions(checks, "raw_orders").items()}.items() <= found.items()
    so, us = staging.stg_orders(raw), Q.sessions_df(spark, scratch)
    whole = attribution.orders_enriched(so, us)
    assert _rows(en) == _rows(whole.select(en.columns))
    full = {"raw_orders": raw, "stg_orders": so, "raw_clicks": fixtures.raw_clicks(spark, scratch), "stg_clickstream": Q.stg_clicks_df(spark, scratch),
            "user_sessions": us, "orders_enriched": whole, "daily_revenue": marts.daily_revenue(whole), "user_behavior": marts.user_behavior(whole, us)}
    got = _rows(quality.run_suite(models, checks, found, hashes))
    assert len(got) == len(checks) and got == _rows(quality.run_suite(full, checks))
    assert so.count() - so.select("order_id").distinct().count() >= 5


def test_lineitems_carry_no_names_to_the_parts(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(fixtures.raw_orders(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    below = plan[plan.index("SortMergeJoin [l_partkey"):]
    assert "n_name" not in below[:below.index("p_partkey")] and "BroadcastExchange" not in below.split("p_name")[0]
    dealt = plan[plan.index("Exchange hashpartitioning(l_partkey"):].splitlines()[1]
    assert "Project" in dealt and "o_orderkey" not in dealt and "l_returnflag" not in dealt.split("AS")[-1]
