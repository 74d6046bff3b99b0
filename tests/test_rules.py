"""Business-rule boundaries (tiers, segments, funnel stages, outcomes) and
the raw-vs-normalised flag behaviour of staging."""

from datetime import datetime
from decimal import Decimal


from emporion.functions.expressions import customer_segment, funnel_stage, order_value_tier, session_outcome
from emporion.operators import staging


def test_order_value_tier_boundaries(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ["49.99", "50.00", "99.99", "100.00"]], "t decimal(10,2)")
    got = [r[0] for r in df.select(order_value_tier("t")).collect()]
    assert got == ["LOW_VALUE", "MID_VALUE", "MID_VALUE", "HIGH_VALUE"]


def test_customer_segment_boundaries(spark):
    rows = [(199.99, 3), (200.0, 3), (200.0, 2), (499.99, 1), (500.0, 1), (10.0, 2), (10.0, 1)]
    df = spark.createDataFrame(rows, "ltv double, n long")
    got = [r[0] for r in df.select(customer_segment("ltv", "n")).collect()]
    assert got == ["RETURNING", "LOYAL", "RETURNING", "NEW", "VIP", "RETURNING", "NEW"]


def test_funnel_stage_mapping(spark):
    types = ["PAGE_VIEW", "SEARCH", "PRODUCT_VIEW", "ADD_TO_CART", "REMOVE_FROM_CART", "CHECKOUT_START",
             "CHECKOUT_COMPLETE", "page_view", None]
    df = spark.createDataFrame([(t,) for t in types], "e string")
    got = [r[0] for r in df.select(funnel_stage("e")).collect()]
    assert got == ["AWARENESS", "AWARENESS", "CONSIDERATION", "INTENT", "INTENT", "PURCHASE_INTENT",
                   "CONVERSION", "OTHER", "OTHER"]


def test_session_outcome_null_flags_fall_through(spark):
    rows = [(True, False, False, False), (None, True, None, None), (None, None, None, None),
            (False, False, False, True), (False, False, True, True)]
    df = spark.createDataFrame(rows, "converted boolean, reached_purchase_intent boolean, "
                                     "reached_intent boolean, reached_consideration boolean")
    got = [r[0] for r in df.select(session_outcome()).collect()]
    assert got == ["CONVERTED", "NEAR_CONVERSION", "BOUNCE", "BROWSING", "HIGH_INTENT"]


def _raw_order(oid, status, total="60.00", qty=1, customer="CUST-1"):
    return (oid, customer, "P1", " widget ", "tools", qty, Decimal("60.00"),
            None if total is None else Decimal(total), status, "NATION_1", " PayPal ",
            datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 0, 5))


RAW_SCHEMA = ("order_id string, customer_id string, product_id string, product_name string, category string, "
              "quantity int, unit_price decimal(10,2), order_total decimal(10,2), order_status string, "
              "shipping_state string, payment_method string, event_timestamp timestamp_ntz, "
              "processed_at timestamp_ntz")


def test_is_cancelled_uses_raw_status(spark):
    rows = [_raw_order("a", "CANCELLED"), _raw_order("b", "cancelled"), _raw_order("c", " CANCELLED"),
            _raw_order("d", None)]
    out = {r.order_id: (r.order_status, r.is_cancelled)
           for r in staging.stg_orders(spark.createDataFrame(rows, RAW_SCHEMA)).collect()}
    assert out == {"a": ("CANCELLED", True), "b": ("CANCELLED", False), "c": ("CANCELLED", False),
                   "d": (None, False)}


def test_staging_gate_and_normalisation(spark):
    rows = [_raw_order("ok", "placed"), _raw_order("zero", "PLACED", qty=0), _raw_order("neg", "PLACED", "-5.00"),
            _raw_order("nocust", "PLACED", customer=None), _raw_order(None, "PLACED"),
            _raw_order("nototal", "PLACED", None)]
    out = staging.stg_orders(spark.createDataFrame(rows, RAW_SCHEMA)).collect()
    assert [r.order_id for r in out] == ["ok"]
    r = out[0]
    assert (r.product_name, r.category, r.order_status, r.payment_method) == ("WIDGET", "TOOLS", "PLACED", "paypal")
    assert r.order_value_tier == "MID_VALUE"


def test_elapsed_time_ignores_session_zone_dst(spark):
    from datetime import datetime

    from emporion.functions.expressions import micros_between, whole_days_between
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(micros_between("a", "b").alias("us"), whole_days_between("a", "b").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.us == 2 * 3600 * 1_000_000 and r.d == 0   # wall-clock (UTC) difference, no DST hour lost
