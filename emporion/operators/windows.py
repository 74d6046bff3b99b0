"""Tumbling event-time windows with exact distinct counts.

The same functions run on a batch DataFrame and on a streaming one.  Spark
refuses ``count(DISTINCT ..)`` on streams, so the exact distinct is planned as
two chained aggregations (both supported by Structured Streaming in append
mode):

* order windows: level 1 groups by (window, dims, customer) carrying partial
  counts/sums; level 2 groups by (window, dims), sums the partials and counts
  the non-null customers.
* funnel windows (two distincts): each event is expanded into a measure row
  and one row per distinct-key ('s' session, 'c' customer); level 1 groups by
  (window, dims, tag, key); level 2 counts keys per tag and sums measures.

Level 1 is partially aggregated map-side, so a hot (window, dims) group costs
one partial row per key per map task, and neither level keeps a set of values
inside one row (state stays spread over executors).  Averages are carried as
sum + count.  Money is summed as DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import rounded_money_avg
from ..schemas import FUNNEL_WINDOW, MONEY, ORDER_WINDOW


def _money_sum_input(c: str) -> Column:
    # exact decimal sums also when fed wire doubles; try_cast so that an
    # unrepresentable value cannot fail a streaming query under ANSI mode
    return F.col(c).try_cast(MONEY)


def order_parts(valid_orders: DataFrame, ts: str = "event_timestamp", duration: str = ORDER_WINDOW) -> DataFrame:
    """Level 1: one row per window, dimensions and customer."""
    return valid_orders.groupBy(
        F.window(ts, duration).alias("window"), "category", "shipping_state", "customer_id"
    ).agg(
        F.count("order_id").alias("_n"),
        F.sum(_money_sum_input("order_total")).alias("_rev"),
        F.count("order_total").alias("_rev_n"),
        F.sum("quantity").alias("_items"),
    )


def order_totals(parts: DataFrame, with_audit: bool = False) -> DataFrame:
    """Level 2 over ``order_parts``."""
    lvl2 = parts.groupBy("window", "category", "shipping_state").agg(
        F.sum("_n").alias("order_count"),
        F.sum("_rev").alias("_rev"),
        F.sum("_rev_n").alias("_rev_n"),
        F.sum("_items").alias("total_items_sold"),
        F.count("customer_id").alias("unique_customers"),
    )
    out = lvl2.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "category", "shipping_state",
        F.col("order_count").cast("bigint").alias("order_count"),
        F.round(F.col("_rev"), 2).cast("double").alias("total_revenue"),
        rounded_money_avg(F.col("_rev"), F.col("_rev_n")).alias("avg_order_value"),
        F.col("total_items_sold").cast("bigint").alias("total_items_sold"),
        "unique_customers",
    )
    if with_audit:
        out = out.withColumn("computed_at", F.current_timestamp())
    return out


def order_windows(valid_orders: DataFrame, ts: str = "event_timestamp", duration: str = ORDER_WINDOW,
                  with_audit: bool = False) -> DataFrame:
    return order_totals(order_parts(valid_orders, ts, duration), with_audit)


# --- fixed values: funnel measures (column -> event type) -------------------
FUNNEL_MEASURES = {
    "page_views": "PAGE_VIEW",
    "product_views": "PRODUCT_VIEW",
    "add_to_cart": "ADD_TO_CART",
    "checkout_starts": "CHECKOUT_START",
    "checkouts": "CHECKOUT_COMPLETE",
}


def funnel_parts(valid_clicks: DataFrame, ts: str = "event_timestamp", duration: str = FUNNEL_WINDOW) -> DataFrame:
    """Level 1: one row per window, dimensions, tag and key."""
    tagged = valid_clicks.select(
        F.window(ts, duration).alias("window"), "device_type", "referrer", "event_type",
        F.explode(F.array(
            F.struct(F.lit("m").alias("tag"), F.lit(None).cast("string").alias("key")),
            F.struct(F.lit("s").alias("tag"), F.col("session_id").alias("key")),
            F.struct(F.lit("c").alias("tag"), F.col("customer_id").alias("key")),
        )).alias("t"),
    ).select("window", "device_type", "referrer", "event_type", "t.tag", "t.key")
    is_m = F.col("tag") == "m"
    return tagged.groupBy("window", "device_type", "referrer", "tag", "key").agg(
        *[F.count(F.when(is_m & (F.col("event_type") == et), F.lit(1))).alias(c)
          for c, et in FUNNEL_MEASURES.items()]
    )


def funnel_totals(parts: DataFrame, with_audit: bool = False) -> DataFrame:
    """Level 2 over ``funnel_parts``."""
    lvl2 = parts.groupBy("window", "device_type", "referrer").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in FUNNEL_MEASURES],
        F.count(F.when((F.col("tag") == "s") & F.col("key").isNotNull(), F.lit(1))).alias("unique_sessions"),
        F.count(F.when((F.col("tag") == "c") & F.col("key").isNotNull(), F.lit(1))).alias("unique_users"),
    )
    pv, co = F.col("product_views"), F.col("checkouts")
    out = lvl2.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "device_type", "referrer", *FUNNEL_MEASURES.keys(), "unique_sessions", "unique_users",
        F.round(F.when(pv > 0, co.cast("double") / pv.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0)), 2)
         .alias("conversion_rate_pct"),
    )
    if with_audit:
        out = out.withColumn("computed_at", F.current_timestamp())
    return out


def funnel_windows(valid_clicks: DataFrame, ts: str = "event_timestamp", duration: str = FUNNEL_WINDOW,
                   with_audit: bool = False) -> DataFrame:
    return funnel_totals(funnel_parts(valid_clicks, ts, duration), with_audit)
