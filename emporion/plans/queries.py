"""Registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the given test tables (through the fixture adapters) and
runs its operator over the whole tables.  Outputs follow the oracle's type
conventions (``to_output``): money as double, timestamps without zone.
Audit columns (current_timestamp) are left out of the compared queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from ..operators import attribution, catalog, hourly, ingest, inventory, marts, quality, sessions, staging, windows
from ..schemas import (
    CLICK_WIRE,
    CUSTOMER_SEGMENTS,
    FRESHNESS,
    FUNNEL_STAGES,
    INVENTORY_WIRE,
    MART_SLA_MINUTES,
    ORDER_STATUSES,
    ORDER_WIRE,
    RECENT_VOLUME_WINDOW,
    SESSION_OUTCOMES,
)
from ..functions.timeutil import utc_wall
from ..session import scratch_path
from ..sources import fixtures
from .pipeline import counted, materialize, observed

# Fixed evaluation time for the freshness/volume/SLA checks of the registry
# (the test data covers 2024-01-01 .. 2024-01-30).
AS_OF = datetime(2024, 1, 31, 0, 30, 0)

Query = Callable[[SparkSession, str], DataFrame]


def to_output(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, TimestampType):
            c = utc_wall(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ model builders

def stg_orders_df(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_orders(fixtures.raw_orders(spark, sf))


def stg_clicks_df(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_clickstream(fixtures.raw_clicks(spark, sf))


def sessions_df(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.user_sessions(stg_clicks_df(spark, sf))


def enriched_df(spark: SparkSession, sf: str, columns: list[str] | None = None, us: DataFrame | None = None,
                session_columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """All orders (``where``: those the caller reads) with their sessions; ``columns`` and ``session_columns`` are what the caller reads of them."""
    repeated = fixtures.repeated_orders(spark, sf)
    if repeated is not None:
        repeated = materialize(repeated, scratch_path(spark, "repeated", uuid.uuid4().hex))
    return attribution.orders_enriched(stg_orders_df(spark, sf), sessions_df(spark, sf) if us is None else us,
                                       repeated=repeated, columns=columns, session_columns=session_columns, where=where)


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    return enriched_df(spark, sf, marts.DAILY_READS, session_columns=marts.DAILY_SESSIONS, where=~F.col("is_cancelled"))


def product_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame | None]:
    """What the product marts read, and the products' names where the orders come without them."""
    names = fixtures.product_names(spark, sf)
    reads = marts.PRODUCT_READS if names is not None else [*marts.PRODUCT_READS, *marts.PRODUCT_NAMES]
    return (enriched_df(spark, sf, reads, session_columns=marts.CHANNEL),
            None if names is None else staging.stg_product_names(names))


# ------------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: to_output(fn(spark, sf))
        return fn
    return deco


@query("stg_orders")
def q_stg_orders(spark, sf):
    return stg_orders_df(spark, sf)


@query("stg_clickstream")
def q_stg_clickstream(spark, sf):
    return stg_clicks_df(spark, sf)


@query("user_sessions")
def q_user_sessions(spark, sf):
    return sessions_df(spark, sf)


@query("sessions_by_id")
def q_sessions_by_id(spark, sf):
    return sessions.sessions_by_id(stg_clicks_df(spark, sf))


@query("orders_enriched")
def q_orders_enriched(spark, sf):
    return enriched_df(spark, sf)


@query("daily_revenue")
def q_daily_revenue(spark, sf):
    return marts.daily_revenue(daily_orders(spark, sf))


@query("daily_revenue_calendar")
def q_daily_revenue_calendar(spark, sf):
    return marts.daily_revenue_calendar(daily_orders(spark, sf))


@query("product_performance")
def q_product_performance(spark, sf):
    orders, names = product_orders(spark, sf)
    return marts.product_performance(orders, names=names)


@query("product_rolling_calendar")
def q_product_rolling_calendar(spark, sf):
    orders, names = product_orders(spark, sf)
    return marts.product_rolling_calendar(orders, names=names)


@query("user_behavior")
def q_user_behavior(spark, sf):
    # sessions are read by two branches: written once
    us = materialize(sessions_df(spark, sf), scratch_path(spark, "sessions", uuid.uuid4().hex))
    return marts.user_behavior(marts.by_customer(enriched_df(spark, sf, marts.CUSTOMER_READS, us, marts.CHANNEL)), marts.by_customer(us))


@query("product_dim")
def q_product_dim(spark, sf):
    return fixtures.product_dim(spark, sf)


# ---------------------------------------------------------------- ingest

def order_topic_rows(spark, sf):
    return ingest.to_kafka_rows(fixtures.raw_orders(spark, sf), ORDER_WIRE, key="customer_id", topic="orders",
                                event_type="ORDER_PLACED", partition="kafka_partition",
                                offset="kafka_offset", kafka_ts="processed_at")


def click_topic_rows(spark, sf):
    return ingest.to_kafka_rows(fixtures.raw_clicks(spark, sf), CLICK_WIRE, key="session_id",
                                topic="clickstream", kafka_ts="processed_at")


def inventory_topic_rows(spark, sf):
    stock = inventory.clamped_stock(fixtures.raw_inventory(spark, sf))
    return ingest.to_kafka_rows(stock, INVENTORY_WIRE, key="product_id", topic="inventory_updates",
                                event_type="INVENTORY_UPDATE", kafka_ts="processed_at")


def _no_audit(df):
    return df.drop("processed_at")


@query("parse_orders")
def q_parse_orders(spark, sf):
    return _no_audit(ingest.parse_orders(order_topic_rows(spark, sf)))


@query("parse_clicks")
def q_parse_clicks(spark, sf):
    return _no_audit(ingest.parse_clicks(click_topic_rows(spark, sf)))


@query("parse_inventory")
def q_parse_inventory(spark, sf):
    return _no_audit(ingest.parse_inventory(inventory_topic_rows(spark, sf)))


@query("valid_orders")
def q_valid_orders(spark, sf):
    return _no_audit(ingest.valid_orders(ingest.parse_orders(order_topic_rows(spark, sf))))


@query("rejected_orders")
def q_rejected_orders(spark, sf):
    return _no_audit(ingest.rejected_orders(ingest.parse_orders(order_topic_rows(spark, sf))))


@query("valid_clicks")
def q_valid_clicks(spark, sf):
    return _no_audit(ingest.valid_clicks(ingest.parse_clicks(click_topic_rows(spark, sf))))


@query("rejected_clicks")
def q_rejected_clicks(spark, sf):
    return _no_audit(ingest.rejected_clicks(ingest.parse_clicks(click_topic_rows(spark, sf))))


def bad_order_topic_rows(spark, sf, cut: int):
    """All topic rows; of seven, one is cut short, one has a word for a number, one no readable time."""
    text, defect = F.col("value").cast("string"), F.col("offset") % 7
    broken = (F.when(defect == 0, F.substring(text, 1, cut))
               .when(defect == 1, F.regexp_replace(text, '"quantity":[0-9]+', '"quantity":"many"'))
               .when(defect == 2, F.regexp_replace(text, '"event_timestamp":"[^"]*"', '"event_timestamp":"soon"'))
               .otherwise(text))
    return order_topic_rows(spark, sf).withColumn("value", broken.cast("binary"))


@query("parse_bad_orders")
def q_parse_bad_orders(spark, sf):
    return ingest.parse_orders(bad_order_topic_rows(spark, sf, 40)).select(
        (F.col("kafka_offset") % 7).alias("defect"), "order_id", "customer_id", "quantity",
        "order_total", "event_timestamp", "event_date", "kafka_offset")


@query("quarantined_orders")
def q_quarantined_orders(spark, sf):
    """The quarantine of all topic rows, with the record as it came."""
    parsed = ingest.parse_orders(bad_order_topic_rows(spark, sf, 60), keep_raw=True)
    return ingest.rejected_orders(parsed).select("kafka_offset", "order_id", "parse_error", "reject_reasons",
                                                 F.col("raw_value").cast("string").alias("raw_value"))


# ------------------------------------------------------------ lake + windows

def lake_orders_df(spark, sf):
    """The order lake: validated landed orders (what the stream writes)."""
    return ingest.valid_orders(fixtures.raw_orders(spark, sf))


def lake_clicks_df(spark, sf):
    return ingest.valid_clicks(fixtures.raw_clicks(spark, sf))


@query("order_windows")
def q_order_windows(spark, sf):
    return windows.order_windows(lake_orders_df(spark, sf))


@query("funnel_windows")
def q_funnel_windows(spark, sf):
    return windows.funnel_windows(lake_clicks_df(spark, sf))


@query("click_session_windows")
def q_click_session_windows(spark, sf):
    return sessions.click_session_windows(lake_clicks_df(spark, sf))


@query("hourly_slice")
def q_hourly_slice(spark, sf):
    lake = lake_orders_df(spark, sf).withColumn("event_date", F.to_date("event_timestamp"))
    return hourly.hour_slice(lake, datetime(2024, 1, 3, 5)).select(
        "order_id", "customer_id", "product_id", "category", "quantity", "order_total", "shipping_state", "event_timestamp")


@query("hourly_revenue")
def q_hourly_revenue(spark, sf):
    return hourly.hourly_revenue(lake_orders_df(spark, sf))


@query("hourly_top_products")
def q_hourly_top_products(spark, sf):
    return hourly.hourly_top_products(lake_orders_df(spark, sf))


@query("hourly_attribution")
def q_hourly_attribution(spark, sf):
    return hourly.hourly_attribution(enriched_df(spark, sf, hourly.ATTRIBUTION_READS))


# ---------------------------------------------------------------- inventory

def stock_df(spark, sf):
    return inventory.clamped_stock(fixtures.raw_inventory(spark, sf))


@query("inventory_stock")
def q_inventory_stock(spark, sf):
    return stock_df(spark, sf).drop("processed_at")


@query("inventory_current")
def q_inventory_current(spark, sf):
    return inventory.current_stock(stock_df(spark, sf))


@query("inventory_current_by_warehouse")
def q_inventory_current_by_warehouse(spark, sf):
    return inventory.current_stock(stock_df(spark, sf), by_warehouse=True)


@query("inventory_movement")
def q_inventory_movement(spark, sf):
    return inventory.movement(stock_df(spark, sf))


@query("orders_with_catalog")
def q_orders_with_catalog(spark, sf):
    return catalog.orders_with_catalog(stg_orders_df(spark, sf), fixtures.product_dim(spark, sf))


# ---------------------------------------------------------------- quality

ACCEPTED = {
    "order_status": ORDER_STATUSES,
    "funnel_stage": FUNNEL_STAGES,
    "session_outcome": SESSION_OUTCOMES,
    "customer_segment": CUSTOMER_SEGMENTS,
}


@query("dq_not_null")
def q_dq_not_null(spark, sf):
    return quality.not_null(fixtures.raw_orders(spark, sf), "customer_id").select(
        "order_id", "customer_id", "order_total")


@query("dq_unique")
def q_dq_unique(spark, sf):
    return quality.unique(sessions_df(spark, sf), "session_id")


@query("dq_accepted_values")
def q_dq_accepted_values(spark, sf):
    """On the landed rows, where lower-case states and other events occur."""
    out = None
    for df, model, column, domain in (
            (fixtures.raw_orders(spark, sf), "raw_orders", "order_status", ORDER_STATUSES),
            (fixtures.raw_clicks(spark, sf), "raw_clicks", "event_type", list(windows.FUNNEL_MEASURES.values()))):
        v = (quality.accepted_values(df, column, domain).groupBy(F.col(column).alias("value"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "value", "rows"))
        out = v if out is None else out.unionByName(v)
    return out


@query("dq_expression")
def q_dq_expression(spark, sf):
    return quality.expression_is_true(fixtures.raw_orders(spark, sf), "order_total >= 0").select(
        "order_id", "customer_id", "order_total")


@query("dq_order_total")
def q_dq_order_total(spark, sf):
    return quality.order_total_positive(fixtures.raw_orders(spark, sf))


@query("dq_duplicate_orders")
def q_dq_duplicate_orders(spark, sf):
    """On a landing in which some events were delivered twice."""
    landed = fixtures.raw_orders(spark, sf).select("order_id", "order_status")
    return quality.duplicate_order_ids(landed.unionByName(landed.filter("order_status = 'cancelled'")))


@query("dq_freshness")
def q_dq_freshness(spark, sf):
    srcs = [("orders", fixtures.raw_orders(spark, sf)), ("clickstream", fixtures.raw_clicks(spark, sf)),
            ("inventory_updates", fixtures.raw_inventory(spark, sf))]
    out = None
    for name, df in srcs:
        warn, err = FRESHNESS[name]
        f = quality.freshness(df, name, "processed_at", warn, err, AS_OF)
        out = f if out is None else out.unionByName(f)
    return out


@query("dq_recent_volume")
def q_dq_recent_volume(spark, sf):
    return quality.recent_volume(fixtures.raw_orders(spark, sf), "processed_at", RECENT_VOLUME_WINDOW, AS_OF)


@query("dq_mart_sla")
def q_dq_mart_sla(spark, sf):
    return quality.mart_sla(marts.daily_revenue(daily_orders(spark, sf)), "order_date", MART_SLA_MINUTES, AS_OF)


#: order columns of the data tests' orders_enriched: what its test and its two marts read
SUITE_READS = ["order_id", *dict.fromkeys([*marts.DAILY_READS, *marts.CUSTOMER_READS])]


def suite_models(spark, sf, checks, found):
    """The models of the data tests; row checks are counted while a model is written.

    As in a model run, the landed and staged tables are views, but the staged orders,
    which are read twice and stand behind joins, are written once; the landed orders'
    rows are counted on their way there.  The enriched orders lie by customer, so that
    the customers' mart need not deal them again.  Also returns the written hashes of
    order ids that occur twice."""
    run = uuid.uuid4().hex
    base = scratch_path(spark, "suite", run)
    models = {}

    def model(name, df, **how):
        models[name] = materialize(df, f"{base}/{name}", counters=quality.row_conditions(checks, name), found=found,
                                   codec="zstd", **how)
        return models[name]

    models["raw_orders"] = fixtures.raw_orders(spark, sf)
    landed, rows = observed(models["raw_orders"], quality.row_conditions(checks, "raw_orders"))
    so = model("stg_orders", staging.stg_orders(landed))
    found.update(counted(rows))
    models["raw_clicks"] = fixtures.raw_clicks(spark, sf)
    sc = models["stg_clickstream"] = staging.stg_clickstream(models["raw_clicks"])
    us = model("user_sessions", sessions.user_sessions(sessions.by_session(sc)))
    repeated = materialize(attribution.repeated_orders(so), f"{base}/repeated")
    buckets, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"suite_{run}"
    en = model("orders_enriched",
               attribution.orders_enriched(so, us, repeated=repeated, columns=SUITE_READS, session_columns=marts.DAILY_SESSIONS,
                                           customers=buckets),
               table=table, bucket_by=(buckets, "customer_id"), dealt=True)
    spark.sql(f"DROP TABLE {table}")  # the name alone: its files stay, and are what was read
    model("daily_revenue", marts.daily_revenue(en))
    model("user_behavior", marts.user_behavior(en, marts.by_customer(us)))
    return models, {("stg_orders", "order_id"): repeated}


@query("dq_suite")
def q_dq_suite(spark, sf):
    checks, found = quality.default_checks(ACCEPTED), {}
    models, hashes = suite_models(spark, sf, checks, found)
    return quality.run_suite(models, checks, found, hashes)
