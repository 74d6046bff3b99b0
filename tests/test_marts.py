"""Mart rules on hand-made rows: mode ties, row- vs calendar-based lags."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from emporion.operators import marts

ENRICHED = ("order_id string, customer_id string, product_id string, product_name string, category string, "
            "quantity int, unit_price decimal(10,2), order_total decimal(10,2), order_status string, "
            "shipping_state string, payment_method string, is_cancelled boolean, order_value_tier string, "
            "order_placed_at timestamp_ntz, pipeline_processed_at timestamp_ntz, session_id string, "
            "device_type string, browser string, attribution_channel string, session_outcome string, "
            "engagement_score long")


def _o(oid, cust, day, total, pay="paypal", chan="direct", cancelled=False):
    ts = datetime(2024, 1, 1) + timedelta(days=day, hours=1)
    return (oid, cust, "P1", "X", "C", 1, Decimal(total), Decimal(total), "PLACED", "S", pay, cancelled,
            "LOW_VALUE", ts, ts, None, "unknown", "unknown", chan, None, None)


SESS = ("session_id string, customer_id string, device_type string, browser string, referrer string, "
        "session_start timestamp_ntz, session_end timestamp_ntz, engagement_score long, converted boolean")


def test_mode_ties_pick_lowest_value(spark):
    rows = [_o("1", "C", 0, "10.00", pay="paypal"), _o("2", "C", 1, "10.00", pay="apple_pay"),
            _o("3", "C", 2, "10.00", pay="paypal"), _o("4", "C", 3, "10.00", pay="apple_pay"),
            _o("5", "C", 4, "10.00", pay="zzz", cancelled=True)]
    en = spark.createDataFrame(rows, ENRICHED)
    s = spark.createDataFrame([], SESS)
    r = marts.user_behavior(en, s).first()
    assert r.preferred_payment_method == "apple_pay"        # 2-2 tie -> lowest; cancelled row ignored
    assert (r.total_sessions, r.primary_device, r.primary_referrer) == (0, "unknown", "unknown")
    assert r.customer_tenure_days == 3 and r.orders_per_month == round(4 / (3 / 30.0), 2)


def test_row_lag_versus_calendar_lag_with_gaps(spark):
    days = [0, 1, 2, 3, 4, 5, 6, 9, 10]            # gap: days 7 and 8 missing
    rows = [_o(str(d), "C", d, f"{10 + d}.00") for d in days]
    en = spark.createDataFrame(rows, ENRICHED)
    byrow = {r.order_date: r.revenue_wow_prior for r in marts.daily_revenue(en).collect()}
    bycal = {r.order_date: r.revenue_7d_prior for r in marts.daily_revenue_calendar(en).collect()}
    d10 = date(2024, 1, 11)
    assert byrow[d10] == 11.0          # day 10 is the 9th row; 7 rows earlier = day 1
    assert bycal[d10] == 13.0          # 7 calendar days earlier = day 3
    assert byrow[date(2024, 1, 10)] == 10.0 and bycal[date(2024, 1, 10)] == 12.0
    assert bycal[date(2024, 1, 7)] is None


def test_hourly_top_k_keeps_ties_and_uses_group_limit(spark):
    from emporion.operators import hourly
    ts = datetime(2024, 1, 1, 5, 10)
    rows = [("O1", "C", "P1", "n", "cat", 1, Decimal("30.00"), ts), ("O2", "C", "P2", "n", "cat", 1, Decimal("30.00"), ts),
            ("O3", "C", "P3", "n", "cat", 1, Decimal("20.00"), ts), ("O4", "C", "P4", "n", "cat", 1, Decimal("10.00"), ts)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, product_name string, "
                                     "category string, quantity int, order_total decimal(10,2), "
                                     "event_timestamp timestamp_ntz")
    top = hourly.hourly_top_products(df, k=2)
    got = sorted((r.product_id, r.revenue_rank) for r in top.collect())
    assert got == [("P1", 1), ("P2", 1)]                     # rank 3 is the next one: gaps on ties
    assert sorted(r.revenue_rank for r in hourly.hourly_top_products(df).collect()) == [1, 1, 3, 4]
    assert "WindowGroupLimit" in top._jdf.queryExecution().optimizedPlan().toString()


def test_catalog_price_checks(spark):
    from emporion.operators import catalog
    ts = datetime(2024, 1, 1, 5)
    orders = spark.createDataFrame(
        [(o, "C", p, "N", "X", 1, Decimal(u), Decimal(u), ts) for o, p, u in
         [("1", "P1", "10.00"), ("2", "P1", "9.00"), ("3", "P1", "11.00"), ("4", "P2", "5.00"), ("5", "P9", "1.00")]],
        "order_id string, customer_id string, product_id string, product_name string, category string, "
        "quantity int, unit_price decimal(10,2), order_total decimal(10,2), order_placed_at timestamp_ntz")
    products = spark.createDataFrame([("P1", "a", "c", Decimal("10.00"), "s", True),
                                      ("P2", "b", "c", Decimal("5.00"), "s", False)],
                                     "product_id string, product_name string, category string, "
                                     "base_price decimal(10,2), supplier string, is_active boolean")
    got = {r.order_id: (r.price_check, r.price_delta) for r in catalog.orders_with_catalog(orders, products).collect()}
    assert got == {"1": ("LIST_PRICE", Decimal("0.00")), "2": ("BELOW_LIST", Decimal("-1.00")),
                   "3": ("ABOVE_LIST", Decimal("1.00")), "4": ("INACTIVE_PRODUCT", Decimal("0.00")),
                   "5": ("UNKNOWN_PRODUCT", None)}
