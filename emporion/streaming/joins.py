"""Orders attributed to click sessions as both topics land.

The grain of a session is its key, not a time-out: a click can come hours after an
order and still extend the session that the order belongs to, or change its
outcome.  A join that emits an order once would have to hold every click of a day
and pair it with every order of its customer.  Here the landed lakes are the state:
new files of either lake name the customers and days they touch, those customers'
orders are attributed anew by the batch operator (the linear sweep of
``operators.attribution``), and the rows are upserted by ``order_id``.  An order
that comes before its session's last click, or a click that comes late, ends with
the row that ``orders_enriched`` gives it.

A micro-batch reads the touched days of both lakes (partition filters) and a click
day more on either side (``session_days``: how many days past its start a session
may go on); only the days' dates reach the driver.  Files of a replayed batch touch
the same keys again and give the same rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import attribution, sessions, staging
from . import sinks
from .relational import JdbcTarget


def _lake_stream(spark: SparkSession, lake: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(lake).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(lake).select("customer_id", "event_date")


def reattributed(orders: DataFrame, clicks: DataFrame, touched: DataFrame, days: list[date], session_days: int = 1) -> DataFrame:
    """``orders_enriched`` of the touched customers' orders: those of the touched
    days and of the days whose sessions a touched day's click may extend."""
    around = lambda before, after: sorted({d + timedelta(days=k) for d in days for k in range(-before, after + 1)})
    customers = touched.select("customer_id").distinct()
    mine = orders.where(F.col("event_date").isin(around(session_days, 0))).join(customers, "customer_id", "left_semi")
    seen = clicks.where(F.col("event_date").isin(around(2 * session_days, session_days))).join(customers, "customer_id", "left_semi")
    return attribution.orders_enriched(staging.stg_orders(mine), sessions.user_sessions(staging.stg_clickstream(seen)))


def start_attribution(spark: SparkSession, orders_lake: str, clicks_lake: str, path: str, checkpoint: str, trigger: dict,
                      session_days: int = 1, max_files: int | None = None, jdbc: JdbcTarget | None = None) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        touched = batch.where(F.col("customer_id").isNotNull()).distinct().persist()
        try:
            days = [r.event_date for r in touched.select("event_date").distinct().collect() if r.event_date is not None]
            if days:
                write(reattributed(spark.read.parquet(orders_lake), spark.read.parquet(clicks_lake), touched, days, session_days), batch_id)
        finally:
            touched.unpersist()

    def into_database(rows: DataFrame, batch_id: int) -> None:
        jdbc.upsert(rows, "attributed", ["order_id"], batch_id)

    write = sinks.keyed_upsert_writer(path, into_database if jdbc else None)
    both = _lake_stream(spark, orders_lake, max_files).unionByName(_lake_stream(spark, clicks_lake, max_files))
    return sinks.batch_sink(both, run, checkpoint, trigger=trigger)


def current_attribution(spark: SparkSession, path: str) -> DataFrame:
    """One row per order, as of the newest batch that touched its customer's day."""
    rows = sinks.current_rows(spark, path, ["order_id"])
    return attribution.with_defaults(rows)
