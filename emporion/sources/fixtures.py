"""Adapters: the driver's test tables -> canonical raw (landed) event tables.

The test data has TPC-H-like tables and a generic ``events`` table; the
reference works on order, click and inventory events.  These functions derive
the landed event tables deterministically, as plain DataFrame plans, so the
work grows with the input tables (nothing is generated on the driver).

Deliberately planted defects (null customers, zero quantities, negative
totals, null prices, clicks without ids, padded names, lower-case categories, a lower-case
'cancelled') exercise the quality rules and staging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attribution import repeated_orders as repeated_orders_of
from ..schemas import MONEY

EPOCH = "2024-01-01 00:00:00"
SPAN_SECONDS = 2_592_000  # 30 days, the span of the events table
PROCESSING_DELAY_SECONDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds_after_epoch(n: Column) -> Column:
    return F.timestamp_add("SECOND", n, F.lit(EPOCH).cast("timestamp_ntz"))


def _order_id() -> Column:
    return F.concat(F.lit("ORD-"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey", F.lit("-"), "l_suppkey")


def _has_repeats(rows: DataFrame, key: str) -> bool:
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counted.where(F.col(key).isNotNull() & (F.col("n") > 1)).isEmpty()


def _product_columns() -> list[Column]:
    return [F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("product_name"), F.lower("p_type").alias("category")]


def product_names(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Product id, name and category as ``raw_orders`` has them, one row a product; None
    where a part's key is repeated, so that an order alone tells its product's name."""
    part = read_table(spark, sf_dir, "part")
    return None if _has_repeats(part, "p_partkey") else part.select(F.concat(F.lit("P"), "p_partkey").alias("product_id"), *_product_columns())


def repeated_orders(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """``attribution.repeated_orders`` of ``raw_orders``, from the keys of its tables
    alone.  Where the lineitems meet each order, customer, nation and part once, an id
    is repeated by lineitems only; where some key is repeated, any id may be (None)."""
    for name, key in (("nation", "n_nationkey"), ("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey")):
        if _has_repeats(read_table(spark, sf_dir, name), key):
            return None
    return repeated_orders_of(read_table(spark, sf_dir, "lineitem").select(_order_id().alias("order_id")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed order event per lineitem (lineitem x orders x customer x
    nation x part).  Event time is spread over 30 days by a fixed hash."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.lit(1) + F.col("l_quantity").cast("int") % 4).alias("units"), (F.col("l_returnflag") == "R").alias("returned"),
    )
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation has 25 rows at every scale factor: a fixed size bound
    na = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    # orders meet their customers first: the lineitems, by far the most rows, are
    # shuffled for orders and parts only, and of the two sides a task holds the orders
    # alone: a hash of them, where a merge would sort its lineitems as well.  On to the parts
    # they carry keys and numbers alone; nations and states of orders are named last
    placed = (od.join(cu, od.o_custkey == cu.c_custkey)
                .select("o_orderkey", "o_custkey", "o_orderstatus", "c_nationkey").hint("shuffle_hash"))
    states = ["CANCELLED", "cancelled", "SHIPPED", "PROCESSING"]
    state = (F.when(F.col("returned") & (F.col("l_linenumber") == 1), 0)
              .when(F.col("returned") & (F.col("l_linenumber") == 2), 1)
              .when(F.col("o_orderstatus") == "F", 2)
              .when(F.col("o_orderstatus") == "P", 3).otherwise(4))
    lines = li.join(placed, li.l_orderkey == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "units", "o_custkey", "c_nationkey", state.alias("state"))
    j = lines.join(pa, F.col("l_partkey") == F.col("p_partkey")).join(na, F.col("c_nationkey") == F.col("n_nationkey"))

    units = F.col("units")
    price = (F.col("p_retailprice") / 30).cast(MONEY)
    n = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % SPAN_SECONDS
    ts = _seconds_after_epoch(n)
    return j.select(
        _order_id().alias("order_id"),
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None).cast("string"))
         .when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("CUST-"), "o_custkey"))
         .otherwise(F.concat(F.lit("CUST-"), "o_custkey", F.lit("-"), F.col("l_partkey") % 20))
         .alias("customer_id"),
        F.concat(F.lit("P"), "l_partkey").alias("product_id"),
        *_product_columns(),
        F.when(F.col("l_orderkey") % 89 == 0, F.lit(0)).otherwise(units).cast("int").alias("quantity"),
        F.when(F.col("l_orderkey") % 83 == 0, F.lit(None).cast(MONEY)).otherwise(price).alias("unit_price"),
        (F.when(F.col("l_orderkey") % 97 == 0, F.lit(-1)).otherwise(F.lit(1)) * price * units)
         .cast(MONEY).alias("order_total"),
        F.when(F.col("state") == 0, states[0]).when(F.col("state") == 1, states[1]).when(F.col("state") == 2, states[2])
         .when(F.col("state") == 3, states[3]).otherwise("PLACED").alias("order_status"),
        F.col("n_name").alias("shipping_state"),
        F.when(F.col("l_orderkey") % 4 == 0, "credit_card")  # the order's key, as joined
         .when(F.col("l_orderkey") % 4 == 1, "debit_card")
         .when(F.col("l_orderkey") % 4 == 2, "paypal")
         .otherwise("apple_pay").alias("payment_method"),
        ts.alias("event_timestamp"),
        F.timestamp_add("SECOND", F.lit(PROCESSING_DELAY_SECONDS), ts).alias("processed_at"),
        # Kafka metadata of the landed copy: one partition, offset unique and
        # increasing with the order key (computed per row, no global sort)
        F.lit(0).alias("kafka_partition"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("kafka_offset"),
    )


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed click events from ``events``: one session per user and day; a
    fifth of the events show another device, so the 5-key session grain and
    session_id differ (as in the reference's real data)."""
    ev = read_table(spark, sf_dir, "events").withColumn("k", _k())
    et = F.col("event_type")
    k = F.col("k")
    uid = F.col("user_id")
    is_item = et.isin("view", "click")
    device_idx = (uid + F.when(k >= 80, 1).otherwise(0)) % 3
    referrer_idx = (uid + F.dayofmonth("ts")) % 6
    return ev.select(
        F.when(F.col("event_id") % 211 != 7, F.concat(F.lit("EVT-"), "event_id")).alias("event_id"),
        F.when(F.col("event_id") % 223 != 9, F.concat(F.lit("SES-"), uid, F.lit("-"), F.to_date("ts").cast("string"))).alias("session_id"),
        F.when(uid % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CUST-"), uid)).alias("customer_id"),
        F.when(et == "view", "PRODUCT_VIEW")
         .when(et == "click",
               F.when(k % 10 == 9, "REMOVE_FROM_CART").when(k % 2 == 0, "PAGE_VIEW").otherwise("ADD_TO_CART"))
         .when(et == "signup", "CHECKOUT_START")
         .when(et == "purchase", "CHECKOUT_COMPLETE")
         .otherwise("SEARCH").alias("event_type"),
        F.when(is_item, F.concat(F.lit("/product/P"), k))
         .when(et == "error", F.lit("/search"))
         .otherwise(F.lit("/checkout")).alias("page"),
        F.when(device_idx == 0, "desktop").when(device_idx == 1, "mobile").otherwise("tablet").alias("device_type"),
        F.when(uid % 4 == 0, "chrome").when(uid % 4 == 1, "safari")
         .when(uid % 4 == 2, "firefox").otherwise("edge").alias("browser"),
        F.when(referrer_idx == 0, "google").when(referrer_idx == 1, "direct")
         .when(referrer_idx == 2, "email_campaign").when(referrer_idx == 3, "instagram")
         .when(referrer_idx == 4, "facebook").otherwise("none").alias("referrer"),
        F.when(is_item, F.concat(F.lit("P"), k)).alias("product_id"),
        F.when(et == "error", F.concat(F.lit("term "), k % 9)).alias("search_term"),
        F.when(et == "error", k % 49).cast("int").alias("results_count"),
        F.when(et.isin("signup", "purchase"), F.col("value").cast(MONEY)).alias("cart_value"),
        F.col("ts").alias("event_timestamp"),
        F.timestamp_add("SECOND", F.lit(PROCESSING_DELAY_SECONDS), F.col("ts")).alias("processed_at"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed inventory updates from ``events`` (20 products, 4 warehouses).
    ``stock_after`` is not part of the raw rows; operators.inventory derives
    it (initial stock 100, clamped at zero)."""
    ev = read_table(spark, sf_dir, "events").withColumn("k", _k())
    k = F.col("k")
    uid = F.col("user_id")
    kind = k % 5
    return ev.select(
        F.concat(F.lit("INV-"), "event_id").alias("update_id"),
        F.concat(F.lit("P"), (uid * 7 + F.col("event_id")) % 20).alias("product_id"),
        F.concat(F.lit("WH-"), uid % 4).alias("warehouse_id"),
        F.when(kind < 3, "SALE").when(kind == 3, "RESTOCK").otherwise("ADJUSTMENT").alias("update_type"),
        F.when(kind < 3, -(F.lit(1) + uid % 5))
         .when(kind == 3, F.lit(5) + k % 12)
         .otherwise(k % 21 - 10).cast("int").alias("quantity_change"),
        F.col("ts").alias("event_timestamp"),
        F.timestamp_add("SECOND", F.lit(PROCESSING_DELAY_SECONDS), F.col("ts")).alias("processed_at"),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue derived from ``part`` (same columns as the CSV
    catalogue)."""
    return read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        (F.col("p_retailprice") / 30).cast(MONEY).alias("base_price"),
        F.col("p_brand").alias("supplier"),
        (F.col("p_size") % 10 != 0).alias("is_active"),
    )
