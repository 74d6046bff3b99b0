"""Ordered model run: staging (views) -> intermediates (tables) -> marts
(tables) -> data tests.  A plain function calling DataFrame builders in
dependency order; Spark plans each step.

The two intermediates feed several marts, so they are written once and read
back (cutting the lineage); the files go under the cluster's shared
checkpoint folder unless an output folder is given.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution, marts, quality, sessions, staging
from ..schemas import CUSTOMER_SEGMENTS, FUNNEL_STAGES, ORDER_STATUSES, SESSION_OUTCOMES
from ..session import scratch_path


@dataclass
class ModelRun:
    base: str
    models: dict[str, DataFrame] = field(default_factory=dict)
    tests: DataFrame | None = None

    def failed_tests(self) -> list[str]:
        return [r.check_name for r in self.tests.filter("status <> 'pass'").select("check_name").collect()]


log = logging.getLogger("emporion.hourly")

def observed(df: DataFrame, counters: dict[str, Column] | None) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts the rows of each condition while it is read once."""
    if not counters:
        return df, None
    observation = Observation()
    return df.observe(observation, *(F.count_if(c).alias(name) for name, c in counters.items())), observation


def counted(observation: Observation) -> dict[str, int]:
    return {name: n for name, n in observation.get.items() if n is not None}


def materialize(df: DataFrame, path: str, view: str | None = None, table: str | None = None,
                analyze: bool = False, counters: dict[str, Column] | None = None, found: dict[str, int] | None = None,
                bucket_by: tuple[int, str] | None = None, dealt: bool = False, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return the re-read table.
    ``table`` registers it in the catalog (and ``analyze`` computes its
    statistics for the cost-based optimizer); ``bucket_by`` (number, column) then
    buckets and sorts it, so that joins and groups by that column need no
    shuffle (``dealt``: the rows lie so already).  ``codec`` compresses the files
    (default: the session's).  ``counters`` are conditions whose rows are counted on the way
    (no pass of their own); the counts are put into ``found``."""
    df, observation = observed(df, counters)
    options = {"compression": codec} if codec else {}
    spark = df.sparkSession
    if table:
        spark.catalog.dropTempView(table)   # a same-named temp view would shadow the table
        writer = df.write.mode("overwrite").options(path=path, **options)
        if bucket_by:
            # dealt as the buckets are: one sorted file a bucket
            df = df if dealt else df.repartition(bucket_by[0], bucket_by[1])
            writer = (df.write.mode("overwrite").options(path=path, **options)
                      .bucketBy(*bucket_by).sortBy(bucket_by[1]))
        writer.saveAsTable(table)
        if analyze:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        out = spark.table(table)
    else:
        df.write.mode("overwrite").options(**options).parquet(path)
        out = spark.read.parquet(path)
    if observation is not None:
        found.update(counted(observation))
    if view and view != table:   # a catalog table is already resolvable by name
        out.createOrReplaceTempView(view)
    return out


def run_models(spark: SparkSession, raw_orders: DataFrame, raw_clicks: DataFrame, out_dir: str | None = None,
               as_tables: bool = False) -> ModelRun:
    base = (out_dir or scratch_path(spark, "models", uuid.uuid4().hex)).rstrip("/")
    run = ModelRun(base)
    accepted = {"order_status": ORDER_STATUSES, "funnel_stage": FUNNEL_STAGES,
                "session_outcome": SESSION_OUTCOMES, "customer_segment": CUSTOMER_SEGMENTS}
    checks, found = quality.default_checks(accepted), {}
    # customers are what the wide tables are joined and grouped by
    buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), "customer_id") if as_tables else None

    def table(df: DataFrame, name: str, model: str | None = None) -> DataFrame:
        bucketed = buckets if "customer_id" in df.columns else None
        return materialize(df, f"{base}/{name}", view=name, table=name if as_tables else None, analyze=as_tables,
                           counters=quality.row_conditions(checks, model) if model else None, found=found, bucket_by=bucketed)

    stg_o = staging.stg_orders(raw_orders)
    stg_c = staging.stg_clickstream(raw_clicks)
    stg_o.createOrReplaceTempView("stg_orders")
    stg_c.createOrReplaceTempView("stg_clickstream")
    run.models.update(raw_orders=raw_orders, raw_clicks=raw_clicks, stg_orders=stg_o, stg_clickstream=stg_c)

    us = table(sessions.user_sessions(stg_c), "int_user_sessions", "user_sessions")
    en = table(attribution.orders_enriched(stg_o, us), "int_order_items_enriched", "orders_enriched")
    run.models.update(user_sessions=us, orders_enriched=en)

    run.models["daily_revenue"] = table(marts.daily_revenue(en, with_audit=True), "mart_daily_revenue", "daily_revenue")
    run.models["product_performance"] = table(marts.product_performance(en, with_audit=True),
                                              "mart_product_performance")
    run.models["user_behavior"] = table(marts.user_behavior(en, us, with_audit=True), "mart_user_behavior", "user_behavior")

    run.tests = table(quality.run_suite(run.models, checks, found), "data_tests")
    return run


def freshness_report(run: ModelRun, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """Source freshness rows (orders, clickstream) and the mart SLA row."""
    from ..schemas import FRESHNESS, MART_SLA_MINUTES
    parts = []
    for name, key in (("orders", "raw_orders"), ("clickstream", "raw_clicks")):
        warn, err = FRESHNESS[name]
        parts.append(quality.freshness(run.models[key], name, "processed_at", warn, err, as_of))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    sla = quality.mart_sla(run.models["daily_revenue"], "order_date", MART_SLA_MINUTES, as_of)
    return out, sla


class GateError(RuntimeError):
    """A check before or after the model run failed."""


def check_before(spark: SparkSession, raw_orders: DataFrame, raw_clicks: DataFrame, as_of: datetime,
                 lake_path: str | None = None) -> None:
    """Gates before a run: the lake (if one is named) holds rows, orders came in
    lately, and no source is stale beyond its error limit."""
    from ..schemas import FRESHNESS, RECENT_VOLUME_WINDOW

    failed = []
    if lake_path is not None and not quality.lake_non_empty(spark, lake_path):
        failed.append(f"no rows in the lake at {lake_path}")
    volume = quality.recent_volume(raw_orders, "processed_at", RECENT_VOLUME_WINDOW, as_of).first()
    if volume["status"] != "pass":
        failed.append(f"no orders in the last {RECENT_VOLUME_WINDOW}")
    for name, df in (("orders", raw_orders), ("clickstream", raw_clicks)):
        row = quality.freshness(df, name, "processed_at", *FRESHNESS[name], as_of).first()
        if row["status"] == "error":
            failed.append(f"{name} is stale: newest row {row['max_loaded_at']}")
        elif row["status"] == "warn":
            log.warning("%s is late: newest row %s", name, row["max_loaded_at"])
    if failed:
        raise GateError("; ".join(failed))


def check_after(run: ModelRun, as_of: datetime) -> None:
    """Gates after a run: data tests and the marts' SLA."""
    from ..schemas import MART_SLA_MINUTES

    failed = [f"data test {name}" for name in run.failed_tests()]
    sla = quality.mart_sla(run.models["daily_revenue"], "order_date", MART_SLA_MINUTES, as_of).first()
    if sla["status"] != "pass":
        failed.append(f"daily_revenue is {sla['lag_minutes']} minutes behind")
    if failed:
        raise GateError("; ".join(failed))


def run_hourly_batch(spark: SparkSession, lake_path: str, out_path: str, hour_start: datetime | None = None,
                     top_k: int | None = None, sessions: DataFrame | None = None, jdbc=None) -> dict[str, str] | None:
    """The hourly batch job: read one hour of the order lake, write revenue
    by category/state and ranked products for that hour.

    Missing lake -> warning, nothing written (returns None); an empty hour is
    skipped.  Outputs are partitioned by ``processing_hour`` and replaced per
    hour, so re-running an hour does not duplicate it.  ``hour_start``
    defaults to the last full UTC hour.  ``jdbc`` (a ``JdbcTarget``) also gets
    the hour's rows, in place of those it has of this hour.
    """
    from ..operators import hourly
    from ..sources.sinks import write_partitions

    def write(df: DataFrame, name: str) -> None:
        write_partitions(df, f"{out_path.rstrip('/')}/{name}", ["processing_hour"])
        if jdbc is not None:
            jdbc.append(df, name, label, scope="processing_hour")

    hour_start = hourly.utc_hour(hour_start) if hour_start else hourly.last_full_hour()[0]
    orders = hourly.read_hour_slice(spark, lake_path, hour_start)
    if orders is None:
        return None
    if orders.isEmpty():
        log.warning("no orders in hour %s - skipping", hour_start.isoformat())
        return {}
    label = hour_start.replace(tzinfo=None).isoformat(timespec="seconds") + "+00:00"
    revenue = hourly.hourly_revenue(orders, processing_hour=label, with_audit=True)
    products = hourly.hourly_top_products(orders, processing_hour=label, k=top_k, with_audit=True)
    write(revenue, "hourly_revenue_by_category")
    write(products, "hourly_top_products")
    if sessions is not None:
        # orders + clickstream: the hour's orders attributed to click sessions
        # (a complete session table, e.g. the materialised int_user_sessions;
        # only sessions of the hour's day can match)
        day = sessions.filter(F.col("session_date") == F.lit(hour_start.date()))  # UTC, as above
        enriched = attribution.orders_enriched(staging.stg_orders(orders), day)
        write(hourly.hourly_attribution(enriched, processing_hour=label), "hourly_attribution")
    return {"hour": label}
