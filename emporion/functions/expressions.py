"""Column expressions shared by the operators.

All are built-in Spark SQL expressions (whole-stage codegen, no Python at run
time).  Thresholds and labels are fixed values of the reference's business
rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeutil import wall_micros


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c: str | Column) -> Column:
    return F.trim(F.upper(col_(c)))


def lower_trim(c: str | Column) -> Column:
    return F.trim(F.lower(col_(c)))


def flag_equals(c: str | Column, value: str) -> Column:
    """``case when c = value then true else false end``: null -> false."""
    return F.when(col_(c) == value, F.lit(True)).otherwise(F.lit(False))


# --- fixed values: order value tiers ----------------------------------------
HIGH_VALUE_MIN = 100
MID_VALUE_MIN = 50


def order_value_tier(total: str | Column) -> Column:
    t = col_(total)
    return (F.when(t >= HIGH_VALUE_MIN, "HIGH_VALUE")
             .when(t >= MID_VALUE_MIN, "MID_VALUE")
             .otherwise("LOW_VALUE"))


def funnel_stage(event_type: str | Column) -> Column:
    e = col_(event_type)
    return (F.when(e.isin("PAGE_VIEW", "SEARCH"), "AWARENESS")
             .when(e == "PRODUCT_VIEW", "CONSIDERATION")
             .when(e.isin("ADD_TO_CART", "REMOVE_FROM_CART"), "INTENT")
             .when(e == "CHECKOUT_START", "PURCHASE_INTENT")
             .when(e == "CHECKOUT_COMPLETE", "CONVERSION")
             .otherwise("OTHER"))


def session_outcome() -> Column:
    """First matching flag wins; a null flag falls through."""
    return (F.when(F.col("converted"), "CONVERTED")
             .when(F.col("reached_purchase_intent"), "NEAR_CONVERSION")
             .when(F.col("reached_intent"), "HIGH_INTENT")
             .when(F.col("reached_consideration"), "BROWSING")
             .otherwise("BOUNCE"))


# --- fixed values: engagement score weights ---------------------------------
ENGAGEMENT_WEIGHTS = {
    "page_views": 1,
    "product_views": 3,
    "searches": 2,
    "add_to_cart_events": 5,
    "checkout_starts": 8,
    "conversions": 10,
}


def engagement_score() -> Column:
    terms = [F.col(c) * w for c, w in ENGAGEMENT_WEIGHTS.items()]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


# --- fixed values: customer segments ----------------------------------------
VIP_MIN_LTV = 500
LOYAL_MIN_LTV = 200
LOYAL_MIN_ORDERS = 3
RETURNING_MIN_ORDERS = 2


def customer_segment(ltv: str | Column, orders: str | Column) -> Column:
    v, n = col_(ltv), col_(orders)
    return (F.when(v >= VIP_MIN_LTV, "VIP")
             .when((v >= LOYAL_MIN_LTV) & (n >= LOYAL_MIN_ORDERS), "LOYAL")
             .when(n >= RETURNING_MIN_ORDERS, "RETURNING")
             .otherwise("NEW"))


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Exact elapsed microseconds ``end - start`` (bigint) between two UTC
    wall-clock (TIMESTAMP_NTZ) values, independent of the session time zone
    (a plain diff would convert through the session zone and shift spans
    that cross a daylight-saving change)."""
    return wall_micros(col_(start), col_(end))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``extract(epoch from end - start)`` as double seconds."""
    return micros_between(start, end).cast("double") / F.lit(1_000_000.0)


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """Day field of the interval ``end - start`` (24-hour days, floor)."""
    return F.expr(f"extract(DAY FROM ({_sql(end)} - {_sql(start)}))").cast("bigint")


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("whole_days_between takes column names")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; null when den is 0 or null (``nullif``)."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def pct_change(current: Column, prior: Column, digits: int = 2) -> Column:
    """round(100 * (current - prior) / nullif(prior, 0), digits) in double."""
    return F.round(ratio(F.lit(100.0) * (current.cast("double") - prior.cast("double")), prior), digits)


def money(c: str | Column) -> Column:
    """Money leaves the engine as double (exact decimal sums cast once)."""
    return col_(c).cast("double")



def rounded_money_avg(total: Column, count: Column) -> Column:
    """round(total / count, 2) with halves rounded away from zero, decided on
    integer cents so the halfway cases do not depend on binary rounding.
    Exact while |total| < 2^52 cents."""
    cents = (total * 100).cast("bigint")
    n = count.cast("bigint")
    whole = F.floor((F.abs(cents) * 2 + n) / (n * 2))
    return F.signum(cents) * whole / F.lit(100.0)
