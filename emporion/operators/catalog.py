"""Orders joined to the product catalogue.

No broadcast hint: the catalogue derived from ``part`` grows with the data.
The planner broadcasts it only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time);
otherwise it is a shuffled join on product_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_with_catalog(stg_orders: DataFrame, products: DataFrame) -> DataFrame:
    p = products.select(
        "product_id",
        F.col("product_name").alias("catalog_product_name"),
        F.col("category").alias("catalog_category"),
        "base_price", "supplier", "is_active",
    )
    j = stg_orders.join(p, "product_id", "left")
    return j.select(
        "order_id", "customer_id", "product_id", "product_name", "category", "quantity",
        "unit_price", "order_total", "order_placed_at",
        "catalog_product_name", "catalog_category", "base_price", "supplier", "is_active",
        (F.col("unit_price") - F.col("base_price")).alias("price_delta"),
        F.when(F.col("base_price").isNull(), "UNKNOWN_PRODUCT")
         .when(~F.col("is_active"), "INACTIVE_PRODUCT")
         .when(F.col("unit_price") == F.col("base_price"), "LIST_PRICE")
         .when(F.col("unit_price") < F.col("base_price"), "BELOW_LIST")
         .otherwise("ABOVE_LIST").alias("price_check"),
    )
