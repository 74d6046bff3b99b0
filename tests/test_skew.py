"""Attribution with one customer holding a third of all orders and sessions:
same result as a brute-force evaluation of the reference SQL (DuckDB)."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporion.operators import attribution
from emporion.plans import oracle
from emporion.plans import queries as Q

HOT = "CUST-HOT"


def test_hot_customer_attribution_matches_brute_force(spark, scratch):
    orders = Q.stg_orders_df(spark, SF_SMALL).withColumn(
        "customer_id", F.when(F.abs(F.hash("order_id")) % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))
    sess = Q.sessions_df(spark, SF_SMALL).withColumn(
        "customer_id", F.when(F.abs(F.hash("session_id")) % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))
    orders.write.parquet(f"{scratch}/o")
    sess.write.parquet(f"{scratch}/s")
    o = spark.read.parquet(f"{scratch}/o")
    s = spark.read.parquet(f"{scratch}/s")
    assert o.filter(F.col("customer_id") == HOT).count() * 4 > o.count()
    got = attribution.orders_enriched(o, s).select("order_id", "session_id", "attribution_channel").collect()

    con = duckdb.connect()
    con.execute(f"create view stg_orders as select * from read_parquet('{scratch}/o/*.parquet')")
    con.execute(f"create view user_sessions as select * from read_parquet('{scratch}/s/*.parquet')")
    sql = "with " + oracle.ORDERS_ENRICHED.strip("\n") + \
        "\nselect order_id, session_id, attribution_channel from orders_enriched"
    exp = con.sql(sql).fetchall()
    key = lambda r: tuple("" if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(exp, key=key)
    hot_matched = sum(1 for r in got if r[1] is not None)
    assert hot_matched > 50
