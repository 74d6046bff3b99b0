"""Counts measured independently when the fixtures were designed (FIXTURES §3)."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from emporion.operators import attribution
from emporion.plans import queries as Q


def _counts(df, col):
    return dict(map(tuple, df.groupBy(col).count().collect()))


def test_sf001_numbers(spark):
    en = Q.QUERIES["orders_enriched"](spark, SF_MID)
    assert en.count() == 58_204
    assert en.filter("session_id is not null").count() == 639
    assert _counts(en, "order_value_tier") == {"HIGH_VALUE": 13_844, "MID_VALUE": 30_299, "LOW_VALUE": 14_061}
    ub = Q.QUERIES["user_behavior"](spark, SF_MID)
    assert _counts(ub, "customer_segment") == {"VIP": 973, "LOYAL": 3_309, "RETURNING": 4_455, "NEW": 4_214}
    assert Q.QUERIES["user_sessions"](spark, SF_MID).count() == 5_338
    assert Q.QUERIES["sessions_by_id"](spark, SF_MID).count() == 3_994
    cand = attribution.match_orders_to_sessions(Q.stg_orders_df(spark, SF_MID), Q.sessions_df(spark, SF_MID))
    assert cand.filter("match_rank = 2").select("order_id").distinct().count() == 24
    st = Q.QUERIES["inventory_stock"](spark, SF_MID)
    r = st.agg(F.min("stock_after"), F.max("stock_after"), F.count_if(F.col("stock_after") < 20),
               F.count_if(F.col("stock_after") == 0)).first()
    assert tuple(r) == (0, 552, 300, 87)


def test_sf0001_natural_duplicate(spark):
    raw = Q.QUERIES["parse_orders"](spark, SF_SMALL)
    assert raw.count() == 6_000 and raw.select("order_id").distinct().count() == 5_999
    en = Q.QUERIES["orders_enriched"](spark, SF_SMALL)
    assert en.filter("session_id is not null").count() == 78
    assert en.count() == en.select("order_id").distinct().count()
