"""Marts: daily revenue, product performance, customer behaviour.

Exactness rules: money is summed as DECIMAL (exact) and leaves as double;
averages are ``sum / count``; the median is the exact middle of counted
amounts, and a mode the most frequent of counted values (ties -> lowest value).

Every analytic window below runs on an already aggregated table (one row per
category/state/day or product/day), so window partitions are bounded by the
calendar and the catalogue, not by event volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import customer_segment, micros_between, money, order_value_tier, pct_change, whole_days_between


def _count_eq(c: str, v: str):
    return F.count(F.when(F.col(c) == v, F.lit(1)))


def _avg_money(c: str):
    return F.sum(c).cast("double") / F.count(c)


def not_cancelled(enriched: DataFrame) -> DataFrame:
    return enriched.filter(~F.col("is_cancelled"))


# ---------------------------------------------------------------- daily revenue

# orders_enriched has one row per order, so orders are rows; customers are the only
# distinct count.  Rows of equal amount are counted first: the median is read off a
# running count over them, which sorts (and spills) instead of holding all amounts.
_DAILY_GROUP = ["order_date", "category", "shipping_state"]


#: order columns that the daily, product and customer marts read; orders are rows, so
#: their ids are not carried; the daily mart takes the tier from the total
DAILY_READS = ["customer_id", "category", "quantity", "order_total", "shipping_state", "is_cancelled", "order_placed_at"]
PRODUCT_READS = ["customer_id", "product_id", "quantity", "unit_price", "order_total", "is_cancelled", "order_placed_at"]
#: what names a product: read with the orders, or from a table of products (``names``)
PRODUCT_NAMES = ["product_name", "category"]
CUSTOMER_READS = ["customer_id", "product_id", "category", "order_total", "payment_method", "is_cancelled",
                  "order_placed_at"]
#: session columns that they read
DAILY_SESSIONS, CHANNEL = ["device_type", "attribution_channel"], ["attribution_channel"]


def _flag(c: str | Column, v: str):
    return F.when((F.col(c) if isinstance(c, str) else c) == v, F.lit(1)).otherwise(0)


def daily_revenue_base(enriched: DataFrame) -> DataFrame:
    # dealt once by the group that the running count needs: orders of one customer, day and
    # amount are too rare to be worth a shuffle of their own
    reads = [F.col(c) for c in ("category", "shipping_state", "customer_id", "quantity", "order_total", *DAILY_SESSIONS)]
    o = not_cancelled(enriched).select(F.to_date("order_placed_at").alias("order_date"), *reads).repartition(*_DAILY_GROUP)
    tier = order_value_tier("order_total")
    amounts = o.groupBy(*_DAILY_GROUP, "customer_id", "order_total").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("items"),
        F.sum(_flag(tier, "HIGH_VALUE")).alias("high"),
        F.sum(_flag(tier, "MID_VALUE")).alias("mid"),
        F.sum(_flag(tier, "LOW_VALUE")).alias("low"),
        F.sum(_flag("attribution_channel", "google")).alias("google"),
        F.sum(_flag("attribution_channel", "email_campaign")).alias("email"),
        F.sum(_flag("attribution_channel", "direct")).alias("direct"),
        F.sum(_flag("device_type", "mobile")).alias("mobile"),
        F.sum(_flag("device_type", "desktop")).alias("desktop"),
        F.sum(_flag("device_type", "tablet")).alias("tablet"),
    )
    group = Window.partitionBy(*_DAILY_GROUP)
    upto = F.sum("n").over(group.orderBy("order_total", "customer_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = amounts.withColumn("upto", upto).withColumn("total", F.sum("n").over(group))
    gross = F.sum(F.col("order_total") * F.col("n"))
    # the middle one, or the two middle ones
    low_mid = F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("order_total"))).cast("double")
    high_mid = F.min(F.when(2 * F.col("upto") >= F.col("total") + 1, F.col("order_total"))).cast("double")
    return placed.groupBy(*_DAILY_GROUP).agg(
        F.sum("n").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("items").cast("bigint").alias("total_items_sold"),
        gross.alias("_gross"),
        (gross.cast("double") / F.sum("n")).alias("avg_order_value"),
        money(F.min("order_total")).alias("min_order_value"),
        money(F.max("order_total")).alias("max_order_value"),
        (low_mid + (high_mid - low_mid) * 0.5).alias("median_order_value"),
        *(F.sum(c).cast("bigint").alias(name) for c, name in (
            ("high", "high_value_orders"), ("mid", "mid_value_orders"), ("low", "low_value_orders"),
            ("google", "orders_from_google"), ("email", "orders_from_email"), ("direct", "orders_from_direct"),
            ("mobile", "mobile_orders"), ("desktop", "desktop_orders"), ("tablet", "tablet_orders"))),
    )


_DAILY_COLUMNS = [
    "order_date", "category", "shipping_state", "total_orders", "unique_customers",
    "total_items_sold", "gross_revenue", "avg_order_value", "min_order_value",
    "max_order_value", "median_order_value", "high_value_orders", "mid_value_orders",
    "low_value_orders", "orders_from_google", "orders_from_email", "orders_from_direct",
    "mobile_orders", "desktop_orders", "tablet_orders",
]


def daily_revenue(enriched: DataFrame, with_audit: bool = False) -> DataFrame:
    """Reference form: 'week over week' = the value 7 *rows* earlier within
    (category, shipping_state) by date (``lag(.., 7)``)."""
    return daily_revenue_of(daily_revenue_base(enriched), with_audit)


def daily_revenue_of(d: DataFrame, with_audit: bool = False) -> DataFrame:
    """The mart from the rows of ``daily_revenue_base``."""
    w = Window.partitionBy("category", "shipping_state").orderBy("order_date")
    prior = F.lag("_gross", 7).over(w)
    out = d.withColumn("_prior", prior).select(
        *[c for c in _DAILY_COLUMNS if c != "gross_revenue"],
        money("_gross").alias("gross_revenue"),
        money("_prior").alias("revenue_wow_prior"),
        pct_change(F.col("_gross"), F.col("_prior")).alias("revenue_wow_pct_change"),
    )
    if with_audit:
        out = out.withColumn("updated_at", F.current_timestamp())
    return out


def daily_revenue_calendar(enriched: DataFrame) -> DataFrame:
    """Variant: revenue exactly 7 calendar days earlier (null when that day
    had no row), via a RANGE frame on the day number."""
    d = daily_revenue_base(enriched).withColumn("_day", F.unix_date("order_date"))
    w = (Window.partitionBy("category", "shipping_state").orderBy("_day").rangeBetween(-7, -7))
    prior = F.sum("_gross").over(w)
    return d.withColumn("_prior", prior).select(
        *[c for c in _DAILY_COLUMNS if c != "gross_revenue"],
        money("_gross").alias("gross_revenue"),
        money("_prior").alias("revenue_7d_prior"),
        pct_change(F.col("_gross"), F.col("_prior")).alias("revenue_7d_pct_change"),
    )


# ---------------------------------------------------------- product performance

def product_daily(enriched: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``names`` has one row a product (product_id, product_name, category): orders then
    come without them, and each product is named once, when its orders are counted."""
    # dealt once by product, which the running columns need too
    o = not_cancelled(enriched).withColumn("order_date", F.to_date("order_placed_at")).repartition("product_id")
    daily = o.groupBy("product_id", *(PRODUCT_NAMES if names is None else []), "order_date").agg(
        F.count(F.lit(1)).alias("times_ordered"),
        F.count_distinct("customer_id").alias("unique_buyers"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("order_total").alias("_revenue"),
        _avg_money("unit_price").alias("avg_selling_price"),
        _count_eq("attribution_channel", "google").alias("google_orders"),
        _count_eq("attribution_channel", "email_campaign").alias("email_orders"),
    )
    return daily if names is None else daily.join(names.select("product_id", *PRODUCT_NAMES), "product_id")


def _product_order():
    # (product_id, order_date) is unique whenever a product has one name and
    # category; the extra keys make the order total otherwise.
    return ["order_date", "product_name", "category"]


def product_performance(enriched: DataFrame, with_audit: bool = False, names: DataFrame | None = None) -> DataFrame:
    """Reference form: rank by revenue within (category, day); running
    revenue and a 7-*row* rolling average of units per product."""
    return product_performance_of(product_daily(enriched, names), with_audit)


def product_performance_of(p: DataFrame, with_audit: bool = False) -> DataFrame:
    """The mart from the rows of ``product_daily``."""
    rank_w = Window.partitionBy("category", "order_date").orderBy(F.col("_revenue").desc())
    run_w = (Window.partitionBy("product_id").orderBy(*_product_order())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    roll_w = Window.partitionBy("product_id").orderBy(*_product_order()).rowsBetween(-6, Window.currentRow)
    # running columns first, while the rows still lie by product
    running = p.withColumns({"_running": F.sum("_revenue").over(run_w), "_rolling": F.avg("units_sold").over(roll_w)})
    out = running.withColumn("_rank", F.rank().over(rank_w)).select(
        "product_id", "product_name", "category", "order_date", "times_ordered",
        "unique_buyers", "units_sold", money("_revenue").alias("total_revenue"),
        "avg_selling_price", "google_orders", "email_orders",
        F.col("_rank").cast("bigint").alias("revenue_rank_in_category"),
        money("_running").alias("cumulative_revenue"),
        F.col("_rolling").alias("rolling_7d_avg_units"),
    )
    if with_audit:
        out = out.withColumn("updated_at", F.current_timestamp())
    return out


def product_rolling_calendar(enriched: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Variant: true 7-day rolling average (RANGE over day numbers: the day
    itself and the 6 calendar days before it)."""
    p = product_daily(enriched, names).withColumn("_day", F.unix_date("order_date"))
    w = Window.partitionBy("product_id").orderBy("_day").rangeBetween(-6, 0)
    return p.select(
        "product_id", "product_name", "category", "order_date", "units_sold",
        money("_revenue").alias("total_revenue"),
        (F.sum("units_sold").over(w) / F.lit(7.0)).alias("rolling_7d_avg_units_per_day"),
        F.avg("units_sold").over(w).alias("rolling_7d_avg_units_active_days"),
        F.count(F.lit(1)).over(w).alias("active_days_in_7d"),
    )


# --------------------------------------------------------------- user behaviour

# Distinct counts and modes come from one counted table (customer, kind, value): every row
# is exploded into narrow (kind, value) pairs, equal ones are counted map-side, and a
# customer's values are then rows, never a map in one row.  The pairs of kind 0 carry the
# measures.  Unlike an Expand this keeps the customer's column, so a table bucketed by
# customer is not shuffled.

def _counted(rows: DataFrame, kinds: list[str], measures: dict[str, Column]) -> DataFrame:
    def pair(i: int, c: str) -> Column:
        return F.struct(F.lit(i).alias("kind"), F.col(c).alias("value"),
                        *((m if i == 0 else F.lit(None)).alias(name) for name, m in measures.items()))

    return rows.select("customer_id", F.inline(F.array(*(pair(i, c) for i, c in enumerate(kinds)))))


def _distinct(kind: int) -> Column:
    return F.count(F.when(F.col("kind") == kind, F.col("value")))


def _mode(kind: int) -> Column:
    """Most frequent value; of equally frequent ones the lowest."""
    return F.min_by("value", F.when((F.col("kind") == kind) & F.col("value").isNotNull(), F.struct(-F.col("n"), "value")))


def by_customer(rows: DataFrame) -> DataFrame:
    """Rows dealt by customer before they are exploded into pairs, so that one narrow row
    is shuffled in place of a row a pair; not needed for a table bucketed by customer."""
    return rows.repartition("customer_id")


def customer_order_summary(enriched: DataFrame) -> DataFrame:
    pairs = _counted(not_cancelled(enriched), ["category", "product_id", "payment_method", "attribution_channel"],
                     {"order": F.lit(1), "total": F.col("order_total"), "placed": F.col("order_placed_at")})
    counted = pairs.groupBy("customer_id", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count("order").alias("orders"), F.sum("total").alias("total"),
        F.count("total").alias("totals"), F.min("placed").alias("first"), F.max("placed").alias("last"))
    return counted.groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("total").alias("_ltv"),
        (F.sum("total").cast("double") / F.sum("totals")).alias("avg_order_value"),
        F.min("first").alias("first_order_at"),
        F.max("last").alias("last_order_at"),
        _distinct(0).alias("categories_purchased"),
        _distinct(1).alias("unique_products_bought"),
        _mode(2).alias("preferred_payment_method"),
        _mode(3).alias("primary_attribution_channel"),
    )


def customer_session_summary(sessions: DataFrame) -> DataFrame:
    pairs = _counted(sessions.filter(F.col("customer_id").isNotNull()), ["session_id", "device_type", "referrer"],
                     {"duration": micros_between("session_start", "session_end"), "score": F.col("engagement_score"),
                      "converting": F.when(F.col("converted"), 1).otherwise(0)})
    counted = pairs.groupBy("customer_id", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{c}_{f.__name__}") for c in ("duration", "score") for f in (F.sum, F.count)),
        F.sum("converting").alias("converting"))
    return counted.groupBy("customer_id").agg(
        _distinct(0).alias("total_sessions"),
        (F.sum("duration_sum").cast("double") / F.sum("duration_count") / F.lit(1_000_000.0)).alias("avg_session_duration_secs"),
        (F.sum("score_sum").cast("double") / F.sum("score_count")).alias("avg_engagement_score"),
        F.sum("converting").cast("bigint").alias("converting_sessions"),
        _mode(1).alias("primary_device"),
        _mode(2).alias("primary_referrer"),
    )


def user_behavior(enriched: DataFrame, sessions: DataFrame, with_audit: bool = False) -> DataFrame:
    o = customer_order_summary(enriched)
    s = customer_session_summary(sessions)
    j = o.join(s, on="customer_id", how="left")
    tenure = whole_days_between("first_order_at", "last_order_at")
    j = j.withColumn("customer_tenure_days", tenure)
    opm = (F.when(F.col("customer_tenure_days") > 0,
                  F.round(F.col("total_orders").cast("double")
                          / (F.col("customer_tenure_days").cast("double") / F.lit(30.0)), 2))
            .otherwise(F.col("total_orders").cast("double")))
    out = j.select(
        "customer_id", "total_orders", money("_ltv").alias("lifetime_value"), "avg_order_value",
        "first_order_at", "last_order_at", "categories_purchased", "unique_products_bought",
        "preferred_payment_method", "primary_attribution_channel",
        F.coalesce("total_sessions", F.lit(0).cast("bigint")).alias("total_sessions"),
        F.coalesce("avg_session_duration_secs", F.lit(0.0)).alias("avg_session_duration_secs"),
        F.coalesce("avg_engagement_score", F.lit(0.0)).alias("avg_engagement_score"),
        F.coalesce("converting_sessions", F.lit(0).cast("bigint")).alias("converting_sessions"),
        F.coalesce("primary_device", F.lit("unknown")).alias("primary_device"),
        F.coalesce("primary_referrer", F.lit("unknown")).alias("primary_referrer"),
        "customer_tenure_days",
        opm.alias("orders_per_month"),
        customer_segment("_ltv", "total_orders").alias("customer_segment"),
    )
    if with_audit:
        out = out.withColumn("updated_at", F.current_timestamp())
    return out
