"""Inventory: clamped running stock, current stock, movement totals.

Stock follows ``stock = max(0, stock + change)`` per product in event order
(event_timestamp, update_id), starting from an initial level.  The recurrence
has a closed form (reflection at zero):

    X_t     = s0 + sum(change_1..t)
    stock_t = X_t - least(0, min(X_1..X_t))

so it is computed with sums and minimums only.  To keep a hot product from
landing in one task, the scan is done in two levels: events are cut into
(product, time-chunk) pieces (default one hour); each piece computes its local
running sum/min in parallel; a small per-product scan over the piece totals
yields each piece's starting offset and the minimum reached before it; a join
on (product, chunk) combines both.  Only the piece table (one row per product
and hour) is scanned per product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import LOW_STOCK_THRESHOLD

INITIAL_STOCK = 100


def clamped_stock(updates: DataFrame, initial_stock: int = INITIAL_STOCK, chunk: str = "hour",
                  ts: str = "event_timestamp") -> DataFrame:
    """Adds ``stock_after`` and ``low_stock_alert`` to every update."""
    u = updates.withColumn("_chunk", F.date_trunc(chunk, ts))
    local_w = (Window.partitionBy("product_id", "_chunk").orderBy(ts, "update_id")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_c", F.sum("quantity_change").over(local_w).cast("bigint"))
    u = u.withColumn("_m", F.min("_c").over(local_w))

    pieces = u.groupBy("product_id", "_chunk").agg(
        F.sum("quantity_change").cast("bigint").alias("_total"),
        F.min("_c").alias("_piece_min"),
    )
    before = (Window.partitionBy("product_id").orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn(
        "_offset", F.lit(initial_stock).cast("bigint") + F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("bigint"))
    pieces = pieces.withColumn(
        "_min_before", F.min(F.col("_offset") + F.col("_piece_min")).over(before)
    ).select("product_id", "_chunk", "_offset", "_min_before")

    j = u.join(pieces, ["product_id", "_chunk"])
    x = F.col("_offset") + F.col("_c")
    run_min = F.least(F.coalesce(F.col("_min_before"), x), F.col("_offset") + F.col("_m"))
    stock = (x - F.least(F.lit(0), run_min)).cast("int")
    return (j.withColumn("stock_after", stock)
             .withColumn("low_stock_alert", F.col("stock_after") < LOW_STOCK_THRESHOLD)
             .drop("_chunk", "_c", "_m", "_offset", "_min_before"))


def current_stock(stock: DataFrame, ts: str = "event_timestamp", by_warehouse: bool = False) -> DataFrame:
    """Latest stock per product (last update by (ts, update_id)).  With
    ``by_warehouse`` one row per (product, warehouse): the product's stock as
    of the last update seen at that warehouse."""
    order_key = F.struct(ts, "update_id")
    keys = ["product_id", "warehouse_id"] if by_warehouse else ["product_id"]
    return stock.groupBy(*keys).agg(
        F.max_by("stock_after", order_key).alias("stock"),
        F.max(ts).alias("last_update_at"),
        F.count(F.lit(1)).alias("updates"),
    ).withColumn("low_stock_alert", F.col("stock") < LOW_STOCK_THRESHOLD)


def movement(stock: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Per day, warehouse and update type: units in/out, net, alerts."""
    q = F.col("quantity_change")
    return stock.groupBy(F.to_date(ts).alias("movement_date"), "warehouse_id", "update_type").agg(
        F.count(F.lit(1)).alias("updates"),
        F.sum(F.when(q > 0, q).otherwise(0)).cast("bigint").alias("units_in"),
        F.sum(F.when(q < 0, -q).otherwise(0)).cast("bigint").alias("units_out"),
        F.sum(q).cast("bigint").alias("net_change"),
        F.count(F.when(F.col("low_stock_alert"), F.lit(1))).alias("low_stock_alerts"),
    )
