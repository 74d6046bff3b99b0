"""Staging: clean and standardise landed orders and clicks (no joins).

Flags that the reference computes from the *raw* column while the output
column of the same name is normalised are reproduced explicitly: a raw status
'cancelled' or ' CANCELLED' is not cancelled, and funnel_stage/is_conversion
see the raw event_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import utc_wall
from ..functions.expressions import (
    flag_equals,
    funnel_stage,
    lower_trim,
    order_value_tier,
    upper_trim,
)


def _wall(df: DataFrame, c: str):
    return F.col(c) if dict(df.dtypes)[c] == "timestamp_ntz" else utc_wall(F.col(c))


def stg_orders(raw: DataFrame) -> DataFrame:
    gate = (F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
            & (F.col("order_total") > 0) & (F.col("quantity") > 0))
    return raw.filter(gate).select(
        "order_id",
        "customer_id",
        "product_id",
        upper_trim("product_name").alias("product_name"),
        upper_trim("category").alias("category"),
        upper_trim("order_status").alias("order_status"),
        upper_trim("shipping_state").alias("shipping_state"),
        lower_trim("payment_method").alias("payment_method"),
        F.coalesce("quantity", F.lit(0)).alias("quantity"),
        F.coalesce("unit_price", F.lit(0).cast(raw.schema["unit_price"].dataType)).alias("unit_price"),
        F.coalesce("order_total", F.lit(0).cast(raw.schema["order_total"].dataType)).alias("order_total"),
        _wall(raw, "event_timestamp").alias("order_placed_at"),
        _wall(raw, "processed_at").alias("pipeline_processed_at"),
        flag_equals(F.col("order_status"), "CANCELLED").alias("is_cancelled"),
        order_value_tier("order_total").alias("order_value_tier"),
    )


def stg_product_names(raw: DataFrame) -> DataFrame:
    """Names of products as ``stg_orders`` gives them with each order."""
    return raw.select("product_id", upper_trim("product_name").alias("product_name"), upper_trim("category").alias("category"))


def stg_clickstream(raw: DataFrame) -> DataFrame:
    gate = (F.col("event_id").isNotNull() & F.col("session_id").isNotNull()
            & F.col("event_timestamp").isNotNull())
    return raw.filter(gate).select(
        "event_id",
        "session_id",
        "customer_id",
        upper_trim("event_type").alias("event_type"),
        lower_trim("page").alias("page"),
        lower_trim("device_type").alias("device_type"),
        lower_trim("browser").alias("browser"),
        lower_trim("referrer").alias("referrer"),
        "product_id",
        lower_trim("search_term").alias("search_term"),
        F.coalesce("results_count", F.lit(0)).alias("results_count"),
        F.coalesce("cart_value", F.lit(0).cast(raw.schema["cart_value"].dataType)).alias("cart_value"),
        _wall(raw, "event_timestamp").alias("event_occurred_at"),
        _wall(raw, "processed_at").alias("pipeline_processed_at"),
        flag_equals(F.col("event_type"), "CHECKOUT_COMPLETE").alias("is_conversion"),
        funnel_stage(F.col("event_type")).alias("funnel_stage"),
    )
