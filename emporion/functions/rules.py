"""Record-level quality rules as data: (name, predicate).

A record passes a rule only when the predicate is TRUE (null counts as a
failure), so ``valid`` and ``rejected`` partition the input exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


#: amounts of this size and more fit no money column
MONEY_LIMIT = 1e22


def in_range(column: str) -> Rule:
    """An amount, if there is one, that a money column holds."""
    return f"{column}_in_range", F.coalesce(F.abs(F.col(column)) < MONEY_LIMIT, F.lit(True))


def order_rules() -> list[Rule]:
    return [
        ("order_id_not_null", F.col("order_id").isNotNull()),
        ("customer_id_not_null", F.col("customer_id").isNotNull()),
        ("order_total_not_null", F.col("order_total").isNotNull()),
        ("order_total_positive", F.col("order_total") > 0),
        ("quantity_not_null", F.col("quantity").isNotNull()),
        ("quantity_positive", F.col("quantity") > 0),
        ("event_timestamp_not_null", F.col("event_timestamp").isNotNull()),
        in_range("order_total"),
        in_range("unit_price"),
    ]


def click_rules() -> list[Rule]:
    return [
        ("event_id_not_null", F.col("event_id").isNotNull()),
        ("session_id_not_null", F.col("session_id").isNotNull()),
        ("event_timestamp_not_null", F.col("event_timestamp").isNotNull()),
        in_range("cart_value"),
    ]


def inventory_rules() -> list[Rule]:
    return [
        ("update_id_not_null", F.col("update_id").isNotNull()),
        ("product_id_not_null", F.col("product_id").isNotNull()),
        ("event_timestamp_not_null", F.col("event_timestamp").isNotNull()),
    ]


def passes(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def all_pass(rules: list[Rule]) -> Column:
    out = F.lit(True)
    for _, pred in rules:
        out = out & passes(pred)
    return out


def failed_rule_names(rules: list[Rule]) -> Column:
    """Comma-separated names of the failed rules, in rule order."""
    return F.concat_ws(",", *[F.when(~passes(p), F.lit(name)) for name, p in rules])
