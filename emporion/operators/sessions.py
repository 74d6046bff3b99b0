"""Session roll-up of clean click events.

``user_sessions`` keeps the reference's grain: one row per
(session_id, customer_id, device_type, browser, referrer).  ``sessions_by_id``
is the one-row-per-session_id variant (attributes of the first event).

Exact distinct counts come from one counted table (session, kind, value): every event is
exploded into its page, which carries the measures, and its product; equal ones are
counted map-side, so a hot session's events are never in one task.  Unlike Catalyst's
Expand this has no third row for the measures and keeps the session's columns, so that
events which lie by session (``by_session``) are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import engagement_score, micros_between, seconds_between, session_outcome

SESSION_KEYS = ["session_id", "customer_id", "device_type", "browser", "referrer"]


_COUNTS = {
    "page_views": "PAGE_VIEW",
    "product_views": "PRODUCT_VIEW",
    "searches": "SEARCH",
    "add_to_cart_events": "ADD_TO_CART",
    "checkout_starts": "CHECKOUT_START",
    "conversions": "CHECKOUT_COMPLETE",
}
_REACHED = {
    "reached_consideration": "PRODUCT_VIEW",
    "reached_intent": "ADD_TO_CART",
    "reached_purchase_intent": "CHECKOUT_START",
    "converted": "CHECKOUT_COMPLETE",
}


def _pages_and_products(clicks: DataFrame, keys: list[str], carried: dict[str, Column]) -> DataFrame:
    """A row for the page (kind 0, with what is ``carried``) and one for the product (kind 1) of each event."""
    def pair(kind: int, value: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(value).alias("value"),
                        *((c if kind == 0 else F.lit(None)).alias(name) for name, c in carried.items()))

    return clicks.select(*keys, F.inline(F.array(pair(0, "page"), pair(1, "product_id")))).where("kind = 0 OR value IS NOT NULL")


def _roll_up(clicks: DataFrame, keys: list[str], first: Column | None = None) -> DataFrame:
    """Measures of each session; ``first`` is a column whose least value is kept as ``_first``."""
    carried = {"at": F.col("event_occurred_at"), "type": F.col("event_type"), "cart": F.col("cart_value")}
    least = {} if first is None else {"_first": first}
    counted = _pages_and_products(clicks, keys, {**carried, **least}).groupBy(*keys, "kind", "value").agg(
        F.min("at").alias("start"), F.max("at").alias("end"), F.max("cart").alias("cart"),
        F.count(F.when(F.col("kind") == 0, F.lit(1))).alias("events"),
        *(F.count(F.when(F.col("type") == t, F.lit(1))).alias(c) for c, t in _COUNTS.items()),
        *(F.bool_or(F.col("type") == t).alias(c) for c, t in _REACHED.items()),
        *(F.min(c).alias(c) for c in least))
    return counted.groupBy(*keys).agg(
        F.min("start").alias("session_start"),
        F.max("end").alias("session_end"),
        F.sum("events").alias("total_events"),
        F.count(F.when(F.col("kind") == 0, F.col("value"))).alias("unique_pages_viewed"),
        F.count(F.when(F.col("kind") == 1, F.col("value"))).alias("unique_products_viewed"),
        F.max("cart").alias("max_cart_value"),
        *(F.sum(c).alias(c) for c in _COUNTS),
        *(F.bool_or(c).alias(c) for c in _REACHED),
        *(F.min(c).alias(c) for c in least))


def _finish(agg: DataFrame, keys: list[str]) -> DataFrame:
    return agg.select(
        *keys,
        "session_start",
        "session_end",
        seconds_between("session_start", "session_end").alias("session_duration_seconds"),
        "total_events", "unique_pages_viewed", "page_views", "product_views", "searches",
        "add_to_cart_events", "checkout_starts", "conversions", "unique_products_viewed",
        "max_cart_value", "reached_consideration", "reached_intent",
        "reached_purchase_intent", "converted",
        F.to_date("session_start").alias("session_date"),
    ).withColumn("session_outcome", session_outcome()).withColumn("engagement_score", engagement_score())


def user_sessions(stg_clicks: DataFrame) -> DataFrame:
    return _finish(_roll_up(stg_clicks, SESSION_KEYS), SESSION_KEYS)


def by_session(stg_clicks: DataFrame) -> DataFrame:
    """Events dealt by the grain of ``user_sessions``: a narrow row an event is shuffled once,
    in place of exploded and counted ones twice.  All events of one session of a customer
    and device are then one task's, which spills rather than holds them."""
    return stg_clicks.repartition(*SESSION_KEYS)


def sessions_by_id(stg_clicks: DataFrame) -> DataFrame:
    """One row per session_id; customer/device/browser/referrer are taken
    from the earliest event (ties broken by event_id)."""
    agg = _roll_up(stg_clicks, ["session_id"], F.struct("event_occurred_at", "event_id", *SESSION_KEYS[1:]))
    return _finish(agg.select("*", *(F.col(f"_first.{c}").alias(c) for c in SESSION_KEYS[1:])), SESSION_KEYS)


# --- fixed values: per-session counters of the session summaries ------------
_SESSION_WINDOW_COUNTS = {
    "page_views": "PAGE_VIEW",
    "product_views": "PRODUCT_VIEW",
    "add_to_cart_events": "ADD_TO_CART",
    "conversions": "CHECKOUT_COMPLETE",
}


def _gap_seconds(gap: str) -> int:
    n, unit = gap.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def click_session_windows(valid_clicks: DataFrame, gap: str = "30 minutes", ts: str = "event_timestamp",
                          keys: tuple[str, ...] = ("session_id", "customer_id"), chunk: str = "hour") -> DataFrame:
    """Gap-based sessions: events of a key closer than ``gap`` (a gap of
    exactly ``gap`` still merges) form one session; the session window ends
    ``gap`` after its last event.

    On a stream this is ``session_window`` (append mode, watermark).  In
    batch it is computed in two levels so that a hot key is not sorted in one
    task: (1) sessionise within (key, time chunk) in parallel and aggregate each
    local session; (2) merge local sessions of a key whose gap is <= ``gap``
    (only consecutive pieces across chunk borders can merge), working on the
    local-session rows, then add up their counters."""
    et = F.col("event_type")
    counts = {c: F.count(F.when(et == t, F.lit(1))) for c, t in _SESSION_WINDOW_COUNTS.items()}
    if valid_clicks.isStreaming:
        agg = valid_clicks.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(
            F.count(F.lit(1)).alias("event_count"), *[v.alias(c) for c, v in counts.items()])
        return agg.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "event_count", *counts.keys())

    gap_us = _gap_seconds(gap) * 1_000_000
    e = valid_clicks.withColumn("_chunk", F.date_trunc(chunk, ts))
    w_local = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    prev = F.lag(ts).over(w_local)
    is_new = F.when(prev.isNull() | (micros_between(prev, F.col(ts)) > gap_us), 1).otherwise(0)
    e = e.withColumn("_new", is_new).withColumn(
        "_local", F.sum("_new").over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    local = e.groupBy(*keys, "_chunk", "_local").agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("event_count"), *[v.alias(c) for c, v in counts.items()])
    w_key = Window.partitionBy(*keys).orderBy("_start")
    prev_last = F.lag("_last").over(w_key)
    glob_new = F.when(prev_last.isNull() | (micros_between(prev_last, F.col("_start")) > gap_us), 1).otherwise(0)
    local = local.withColumn("_gnew", glob_new).withColumn(
        "_gid", F.sum("_gnew").over(w_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = local.groupBy(*keys, "_gid").agg(
        F.min("_start").alias("window_start"),
        (F.max("_last") + F.expr(f"INTERVAL {gap}")).alias("window_end"),
        F.sum("event_count").alias("event_count"),
        *[F.sum(c).alias(c) for c in counts])
    return out.select(*keys, "window_start", "window_end", "event_count", *counts.keys())
