"""Canonical schemas and fixed domains.

Wire schemas are what producers put on a topic (JSON); landed schemas are the
typed tables the streams write (money as DECIMAL(24,2), event time as a
timestamp).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

#: exact for amounts below 10**22; sums of them stay exact
MONEY = DecimalType(24, 2)

# --- fixed values: must equal the reference's domains -----------------------
ORDER_STATUSES = ["PLACED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"]
CLICK_EVENT_TYPES = [
    "PAGE_VIEW", "PRODUCT_VIEW", "SEARCH", "ADD_TO_CART",
    "REMOVE_FROM_CART", "CHECKOUT_START", "CHECKOUT_COMPLETE",
]
FUNNEL_STAGES = ["AWARENESS", "CONSIDERATION", "INTENT", "PURCHASE_INTENT", "CONVERSION", "OTHER"]
SESSION_OUTCOMES = ["CONVERTED", "NEAR_CONVERSION", "HIGH_INTENT", "BROWSING", "BOUNCE"]
CUSTOMER_SEGMENTS = ["VIP", "LOYAL", "RETURNING", "NEW"]
INVENTORY_UPDATE_TYPES = ["SALE", "RESTOCK", "ADJUSTMENT"]
ORDER_WATERMARK = "10 minutes"
CLICK_WATERMARK = "15 minutes"
ORDER_WINDOW = "5 minutes"
FUNNEL_WINDOW = "10 minutes"
ATTRIBUTION_GRACE = "30 minutes"
SESSION_GAP = "30 minutes"
LOW_STOCK_THRESHOLD = 20
# source freshness (warn, error) on processed_at
FRESHNESS = {
    "orders": ("1 hour", "3 hours"),
    "clickstream": ("30 minutes", "2 hours"),
    "inventory_updates": ("1 hour", "6 hours"),
}
MART_SLA_MINUTES = 90
RECENT_VOLUME_WINDOW = "2 hours"
# -----------------------------------------------------------------------------

ORDER_WIRE = StructType([
    StructField("event_type", StringType()),
    StructField("order_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("category", StringType()),
    StructField("quantity", IntegerType()),
    StructField("unit_price", DoubleType()),
    StructField("order_total", DoubleType()),
    StructField("order_status", StringType()),
    StructField("shipping_state", StringType()),
    StructField("payment_method", StringType()),
    StructField("event_timestamp", StringType()),
])

CLICK_WIRE = StructType([
    StructField("event_type", StringType()),
    StructField("event_id", StringType()),
    StructField("session_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("page", StringType()),
    StructField("device_type", StringType()),
    StructField("browser", StringType()),
    StructField("referrer", StringType()),
    StructField("product_id", StringType()),
    StructField("search_term", StringType()),
    StructField("results_count", IntegerType()),
    StructField("cart_value", DoubleType()),
    StructField("event_timestamp", StringType()),
])

INVENTORY_WIRE = StructType([
    StructField("event_type", StringType()),
    StructField("update_id", StringType()),
    StructField("product_id", StringType()),
    StructField("warehouse_id", StringType()),
    StructField("update_type", StringType()),
    StructField("quantity_change", IntegerType()),
    StructField("stock_after", IntegerType()),
    StructField("low_stock_alert", BooleanType()),
    StructField("event_timestamp", StringType()),
])

# Shape of a Kafka source row; the file-based stand-in has the same columns.
KAFKA_ROW = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

PRODUCT_CATALOG = StructType([
    StructField("product_id", StringType()),
    StructField("product_name", StringType()),
    StructField("category", StringType()),
    StructField("base_price", MONEY),
    StructField("supplier", StringType()),
    StructField("is_active", BooleanType()),
])

# Money columns of the landed tables (wire doubles are cast to these).
ORDER_MONEY_COLUMNS = ["unit_price", "order_total"]
CLICK_MONEY_COLUMNS = ["cart_value"]
