"""Data-quality checks: table -> violating rows, or one status row.

Generic column tests (not_null, unique, accepted_values, expression) return
the violating rows/values, like a SQL test that fails when it returns rows.
``run_suite`` returns one row per test.  Row-level tests of a model are counted
while the model is written (``row_conditions`` as an ``Observation``), so they
need no scan of their own; for a model that was not written so, they share one
aggregation pass.  A uniqueness test groups the values whose hash occurs twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import micros_between
from ..session import scratch_path
from ..sources.missing import read_parquet_if_there


# ------------------------------------------------------------ column tests

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-null values with their number of occurrences."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1))


def maybe_repeated(df: DataFrame, column: str, path: str | None = None, hashes: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` whose ``column`` may occur more than once (all rows of such
    values, and of values that share a 64-bit hash).  The hashes are counted and written
    first: only they are shuffled, and the few that stay need no shuffle of ``df``.
    ``hashes`` are such hashes (one column) where they are written already."""
    h = F.xxhash64(column)
    if hashes is None:
        df.groupBy(h.alias("_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_hash").write.parquet(path)
        hashes = df.sparkSession.read.parquet(path)
    return df.join(hashes, h == hashes[hashes.columns[0]], "left_semi")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose non-null value is outside the domain."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false (null passes)."""
    e = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~e)


def order_total_positive(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.filter(F.col("order_total") <= 0).select("order_id", "customer_id", "order_total")


def written_duplicate_order_ids(enriched: DataFrame) -> DataFrame:
    """``duplicate_order_ids`` of a written table."""
    return duplicate_order_ids(maybe_repeated(enriched, "order_id", scratch_path(enriched.sparkSession, "repeated", uuid.uuid4().hex)))


def duplicate_order_ids(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy("order_id").agg(F.count(F.lit(1)).alias("occurrences"))
                    .filter(F.col("occurrences") > 1))


# --------------------------------------------------------- status checks

def _interval_seconds(text: str) -> int:
    n, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def _ts_literal(as_of: datetime) -> Column:
    return F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def freshness(df: DataFrame, source: str, loaded_at: str, warn_after: str, error_after: str,
              as_of: datetime) -> DataFrame:
    """One row: newest ``loaded_at``, its age at ``as_of`` and pass/warn/error."""
    age = micros_between(F.col("max_loaded_at"), _ts_literal(as_of)).cast("double") / F.lit(60_000_000.0)
    return (df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
              .select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_minutes"))
              .withColumn("status",
                          F.when(F.col("max_loaded_at").isNull(), "error")
                           .when(F.col("age_minutes") * 60 > _interval_seconds(error_after), "error")
                           .when(F.col("age_minutes") * 60 > _interval_seconds(warn_after), "warn")
                           .otherwise("pass")))


def recent_volume(df: DataFrame, ts: str, window: str, as_of: datetime) -> DataFrame:
    """Rows with ``ts >= as_of - window``; status fail when there are none."""
    lo = _ts_literal(as_of) - F.expr(f"INTERVAL {window}")
    return (df.filter(F.col(ts).cast("timestamp_ntz") >= lo)
              .agg(F.count(F.lit(1)).alias("recent_rows"))
              .withColumn("status", F.when(F.col("recent_rows") > 0, "pass").otherwise("fail")))


def mart_sla(mart: DataFrame, date_col: str, sla_minutes: int, as_of: datetime) -> DataFrame:
    """Lag of the newest mart date (taken as midnight, like the reference
    check) behind ``as_of``; an empty mart is an error."""
    latest = F.max(F.col(date_col)).cast("timestamp_ntz")
    lag = (micros_between(F.col("latest"), _ts_literal(as_of)) / F.lit(60_000_000)).cast("bigint")
    return (mart.agg(latest.alias("latest"))
                .withColumn("lag_minutes", lag)
                .withColumn("status", F.when(F.col("latest").isNull(), "error")
                                       .when(F.col("lag_minutes") > sla_minutes, "error")
                                       .otherwise("pass")))


def lake_non_empty(spark: SparkSession, path: str) -> bool:
    lake = read_parquet_if_there(spark, path)
    return lake is not None and not lake.isEmpty()


# ------------------------------------------------------------------ suite

@dataclass(frozen=True)
class Check:
    name: str
    model: str
    column: str
    kind: str               # not_null | unique | accepted_values | expression | singular
    arg: object = None      # domain list, SQL expression, or a DataFrame builder


def row_conditions(checks: list[Check], model: str) -> dict[str, Column]:
    """Of a model's row-level tests, the condition of a violating row."""
    out = {}
    for c in checks:
        if c.model != model or not (c.kind in ("not_null", "accepted_values", "expression") or isinstance(c.arg, str)):
            continue
        if c.kind == "not_null":
            bad = F.col(c.column).isNull()
        elif c.kind == "accepted_values":
            bad = F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.arg)
        elif c.kind == "singular":
            bad = F.expr(c.arg)
        else:
            bad = ~F.expr(c.arg)
        out[c.name] = F.coalesce(bad, F.lit(False))
    return out


def run_suite(models: dict[str, DataFrame], checks: list[Check], observed: dict[str, int] | None = None,
              hashes: dict[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """One row per check: (check_name, model, column_name, test, violations,
    status).  ``observed`` has the violations of row-level checks that were
    counted while their model was written, ``hashes`` the written hashes that occur
    twice in a (model, column)."""
    observed, hashes = observed or {}, hashes or {}
    spark = next(iter(models.values())).sparkSession
    parts: list[DataFrame] = []
    known = [(c.name, int(observed[c.name])) for c in checks if c.name in observed]
    if known:  # one number a check
        parts.append(spark.createDataFrame(known, "check_name string, violations bigint"))
    for model in dict.fromkeys(c.model for c in checks):
        open_ = {name: bad for name, bad in row_conditions(checks, model).items() if name not in observed}
        if open_:
            wide = models[model].agg(*(F.count_if(bad).alias(name) for name, bad in open_.items()))
            stack = ", ".join(f"'{name}', `{name}`" for name in open_)
            parts.append(wide.select(F.expr(f"stack({len(open_)}, {stack}) as (check_name, violations)")))
    for c in checks:
        if c.kind == "unique":
            rows = maybe_repeated(models[c.model], c.column, scratch_path(spark, "repeated", uuid.uuid4().hex),
                                  hashes.get((c.model, c.column)))
            v = unique(rows, c.column).agg(F.count(F.lit(1)).alias("violations"))
        elif c.kind == "singular" and not isinstance(c.arg, str):
            v = c.arg(models).agg(F.count(F.lit(1)).alias("violations"))
        else:
            continue
        parts.append(v.select(F.lit(c.name).alias("check_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = out.sparkSession.createDataFrame(
        [(c.name, c.model, c.column, c.kind) for c in checks],
        "check_name string, model string, column_name string, test string")
    # meta has one row per check (a fixed, tiny list): broadcast is bounded
    return (out.join(F.broadcast(meta), "check_name")
               .select("check_name", "model", "column_name", "test",
                       F.col("violations").cast("bigint").alias("violations"),
                       F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status")))


def default_checks(accepted: dict[str, list[str]]) -> list[Check]:
    """The reference's column and singular tests (fixed values)."""
    return [
        Check("raw_orders_order_id_not_null", "raw_orders", "order_id", "not_null"),
        Check("raw_orders_customer_id_not_null", "raw_orders", "customer_id", "not_null"),
        Check("raw_orders_order_total_not_null", "raw_orders", "order_total", "not_null"),
        Check("raw_orders_order_total_non_negative", "raw_orders", "order_total", "expression", "order_total >= 0"),
        Check("raw_clicks_event_id_not_null", "raw_clicks", "event_id", "not_null"),
        Check("raw_clicks_event_id_unique", "raw_clicks", "event_id", "unique"),
        Check("raw_clicks_session_id_not_null", "raw_clicks", "session_id", "not_null"),
        Check("stg_orders_order_id_not_null", "stg_orders", "order_id", "not_null"),
        Check("stg_orders_order_id_unique", "stg_orders", "order_id", "unique"),
        Check("stg_orders_order_total_not_null", "stg_orders", "order_total", "not_null"),
        Check("stg_orders_order_total_positive", "stg_orders", "order_total", "expression", "order_total > 0"),
        Check("stg_orders_order_status_accepted", "stg_orders", "order_status", "accepted_values",
              accepted["order_status"]),
        Check("stg_clickstream_event_id_not_null", "stg_clickstream", "event_id", "not_null"),
        Check("stg_clickstream_funnel_stage_accepted", "stg_clickstream", "funnel_stage", "accepted_values",
              accepted["funnel_stage"]),
        Check("user_sessions_session_id_not_null", "user_sessions", "session_id", "not_null"),
        Check("user_sessions_session_id_unique", "user_sessions", "session_id", "unique"),
        Check("user_sessions_session_outcome_accepted", "user_sessions", "session_outcome", "accepted_values",
              accepted["session_outcome"]),
        Check("daily_revenue_order_date_not_null", "daily_revenue", "order_date", "not_null"),
        Check("daily_revenue_gross_revenue_non_negative", "daily_revenue", "gross_revenue", "expression",
              "gross_revenue >= 0"),
        Check("user_behavior_customer_id_not_null", "user_behavior", "customer_id", "not_null"),
        Check("user_behavior_customer_id_unique", "user_behavior", "customer_id", "unique"),
        Check("user_behavior_customer_segment_accepted", "user_behavior", "customer_segment", "accepted_values",
              accepted["customer_segment"]),
        Check("assert_order_total_positive", "stg_orders", "order_total", "singular", "order_total <= 0"),
        Check("assert_no_duplicate_order_ids", "orders_enriched", "order_id", "singular",
              lambda m: written_duplicate_order_ids(m["orders_enriched"])),
    ]
