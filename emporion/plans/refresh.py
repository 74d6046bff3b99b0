"""Refresh of the models by what changed: the same tables as a rebuild gives, but only
the partitions that new rows reach are written again.

The models are kept partitioned: sessions, orders and the daily tables by date, customers
by a hash of their id.  A refresh takes the lakes (new rows included) and the new rows:

1. New clicks name sessions.  The kept version of such a session tells on which days its
   earlier clicks lie, so only these days of the click lake are read for the new version.
2. New orders, and the days of customers whose sessions changed, name orders.  ``placed_dates``
   of a kept order (all days on which its id occurs) tells which days of the order lake hold
   its rows; these orders are attributed anew.  Rows that come out as they were are no change.
3. Dates of changed orders are aggregated anew from the kept orders.  A mart row is written
   again where a changed row is one it reads: its own date, the seven rows before it (week over
   week), any earlier date of its product (running revenue).
4. Customers of changed orders and sessions are summed up anew from their kept rows.

No look-back is assumed: whether an id or a session is known already is asked of all kept
rows, by their key columns alone.  The daily tables (a row per product and day, or category,
state and day) are read whole for the running columns; events never are.

What a refresh is going to change is written down under ``_refresh/batch=<batch>`` before any
table is touched, and every step replaces whole partitions by rows that follow from it.  A run
that was cut short is repeated with the same batch and ends with the same tables.  One refresh
runs at a time.  Only dates and partition numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import attribution, marts, sessions, staging
from ..sources.missing import read_parquet_if_there

SESSION_KEYS = sessions.SESSION_KEYS
#: table -> the column it is partitioned by
PARTITIONS = {
    "int_user_sessions": "session_date",
    "int_order_items_enriched": "placed_date",
    "int_daily_revenue": "order_date",
    "int_product_daily": "order_date",
    "mart_daily_revenue": "order_date",
    "mart_product_performance": "order_date",
    "mart_user_behavior": "customer_part",
}
_DAILY_KEYS = ["category", "shipping_state"]


def _in(column: str, values: Iterable) -> Column:
    """``column`` is one of ``values``; None stands for null."""
    known = [v for v in values if v is not None]
    hit = F.col(column).isin(known) if known else F.lit(False)
    return hit | F.col(column).isNull() if None in values else hit


def _values(df: DataFrame, column: str) -> set:
    return {r[0] for r in df.select(column).distinct().collect()}


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi- or anti-join by keys that may be null."""
    b = b.select(*(F.col(k).alias(f"_{k}") for k in keys))
    return a.join(b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how)


@dataclass(frozen=True)
class Models:
    """The kept models under ``base``; ``parts`` is the number of customer partitions."""
    spark: SparkSession
    base: str
    parts: int = 64

    # ------------------------------------------------------------ what is kept

    def _orders(self, staged: DataFrame, live: DataFrame) -> DataFrame:
        days = staged.groupBy("order_id").agg(F.sort_array(F.collect_set(F.to_date("order_placed_at"))).alias("placed_dates"))
        return (attribution.orders_enriched(staged, live).join(days, "order_id")
                .withColumn("placed_date", F.to_date("order_placed_at")))

    def _customers(self, enriched: DataFrame, live: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("customer_id"), F.lit(self.parts)).cast("int")
        return marts.user_behavior(enriched, live, with_audit=True).withColumn("customer_part", part)

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        """A kept table; ``like`` names its columns where it may hold no file."""
        if like is None:
            return self.spark.read.parquet(self._path(name))
        return self.spark.read.schema(like.schema).parquet(self._path(name)).select(*like.columns)

    def _write(self, df: DataFrame, path: str, part: str) -> None:
        # partitions of even size, large dates split
        df.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(path)

    def _shapes(self, raw_orders: DataFrame, raw_clicks: DataFrame) -> dict[str, DataFrame]:
        """What each table is defined as; read for the schemas, never run by a refresh."""
        live = sessions.user_sessions(staging.stg_clickstream(raw_clicks))
        orders = self._orders(staging.stg_orders(raw_orders), live)
        daily, product = marts.daily_revenue_base(orders), marts.product_daily(orders)
        return {"int_user_sessions": live, "int_order_items_enriched": orders, "int_daily_revenue": daily,
                "int_product_daily": product, "mart_daily_revenue": marts.daily_revenue_of(daily, with_audit=True),
                "mart_product_performance": marts.product_performance_of(product, with_audit=True),
                "mart_user_behavior": self._customers(orders, live)}

    # ------------------------------------------------------------ first build

    def build(self, raw_orders: DataFrame, raw_clicks: DataFrame) -> None:
        """All tables from all rows."""
        shapes = self._shapes(raw_orders, raw_clicks)

        def put(name: str, df: DataFrame) -> DataFrame:
            self._write(df, self._path(name), PARTITIONS[name])
            return self.read(name, shapes[name])

        live = put("int_user_sessions", shapes["int_user_sessions"])
        orders = put("int_order_items_enriched", self._orders(staging.stg_orders(raw_orders), live))
        daily = put("int_daily_revenue", marts.daily_revenue_base(orders))
        product = put("int_product_daily", marts.product_daily(orders))
        put("mart_daily_revenue", marts.daily_revenue_of(daily, with_audit=True))
        put("mart_product_performance", marts.product_performance_of(product, with_audit=True))
        put("mart_user_behavior", self._customers(orders, live))

    # ------------------------------------------------------------ refresh

    def refresh(self, raw_orders: DataFrame, raw_clicks: DataFrame, new_orders: DataFrame, new_clicks: DataFrame,
                batch: int | str, day_column: str = "event_date") -> dict[str, list]:
        """Bring the tables up to ``raw_orders`` and ``raw_clicks``, which hold the new rows
        too.  Gives the partitions written again, by table.

        The lakes are read by ``day_column`` (the date of ``event_timestamp``); without such a
        column by that date itself.  Rows without a date belong to any day."""
        shapes = self._shapes(raw_orders, raw_clicks)
        notes = f"_refresh/batch={batch}"
        if read_parquet_if_there(self.spark, self._path(f"{notes}/planned")) is None:
            self._plan(notes, shapes, raw_orders, raw_clicks, new_orders, new_clicks, day_column)
            self.spark.range(1).write.mode("overwrite").parquet(self._path(f"{notes}/planned"))
        return self._apply(notes, shapes)

    def _note(self, notes: str, name: str, df: DataFrame) -> DataFrame:
        path = self._path(f"{notes}/{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _noted(self, notes: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(f"{notes}/{name}"))

    def _plan(self, notes: str, shapes: dict[str, DataFrame], raw_orders: DataFrame, raw_clicks: DataFrame,
              new_orders: DataFrame, new_clicks: DataFrame, day_column: str) -> None:
        def on_days(raw: DataFrame, days: set) -> DataFrame:
            if day_column not in raw.columns:
                raw = raw.withColumn(day_column, F.to_date(staging._wall(raw, "event_timestamp")))
            return raw.where(_in(day_column, days | {None}))

        # sessions that new clicks belong to
        clicks = staging.stg_clickstream(new_clicks)
        keys = self._note(notes, "session_keys", clicks.select(*SESSION_KEYS).distinct())
        kept = self.read("int_user_sessions", shapes["int_user_sessions"])
        before = self._note(notes, "sessions_before", _same(kept, keys, SESSION_KEYS, "left_semi"))
        span = F.explode(F.sequence(F.to_date("session_start"), F.to_date("session_end")))
        days = _values(before.select(span.alias("day")).union(clicks.select(F.to_date("event_occurred_at"))), "day")
        theirs = _same(staging.stg_clickstream(on_days(raw_clicks, days)), keys, SESSION_KEYS, "left_semi")
        after = self._note(notes, "sessions_after", sessions.user_sessions(theirs))

        # orders that are new or stand on a day of a customer whose sessions changed
        customer_days = self._note(notes, "customer_days", before.unionByName(after).where("customer_id is not null")
                                   .select("customer_id", F.col("session_date").alias("day")).distinct())
        near = staging.stg_orders(on_days(raw_orders, _values(customer_days, "day"))).withColumn("day", F.to_date("order_placed_at"))
        fresh = staging.stg_orders(new_orders)
        ids = self._note(notes, "order_ids", near.join(customer_days, ["customer_id", "day"], "left_semi").select("order_id")
                         .union(fresh.select("order_id")).distinct())
        kept_orders = self.read("int_order_items_enriched", shapes["int_order_items_enriched"])
        was = self._note(notes, "orders_before", kept_orders.join(ids, "order_id", "left_semi"))
        days = _values(was.select(F.explode("placed_dates").alias("day")).union(fresh.select(F.to_date("order_placed_at"))), "day")
        theirs = staging.stg_orders(on_days(raw_orders, days)).join(ids, "order_id", "left_semi")
        live = (_same(kept.where(_in("session_date", days)), keys, SESSION_KEYS, "left_anti")
                .unionByName(after.where(_in("session_date", days))))
        now = self._note(notes, "orders_after", self._orders(theirs, live))

        # of these, what came out otherwise than it was
        sides = was.withColumn("side", F.lit(-1)).unionByName(now.withColumn("side", F.lit(1)))
        differ = self._note(notes, "orders_changed", sides.groupBy(*was.columns).agg(F.sum("side").alias("side")).where("side <> 0")
                            .select("order_id", "placed_date", "customer_id"))
        self._note(notes, "customers", differ.select("customer_id")
                   .union(customer_days.select("customer_id")).where("customer_id is not null").distinct())

        # daily rows that may go
        changed = _values(differ, "placed_date")
        for name, group in (("int_daily_revenue", _DAILY_KEYS), ("int_product_daily", ["product_id"])):
            rows = self.read(name, shapes[name]).where(_in("order_date", changed))
            self._note(notes, f"{name}_before", rows.select(*group, "order_date").distinct())

    def _replace(self, notes: str, name: str, rows: DataFrame, partitions: set) -> list:
        """``rows`` in place of what ``partitions`` hold; other partitions keep their files."""
        if not partitions:
            return []
        part, staged, path = PARTITIONS[name], self._path(f"{notes}/{name}"), self._path(name)
        self._write(rows.where(_in(part, partitions)), staged, part)
        ready = self.spark.read.schema(rows.schema).parquet(staged)
        filled = _values(ready, part)
        if filled:
            (ready.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(part).parquet(path))
        for value in partitions - filled:
            folder = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            ready.drop(part).where(F.lit(False)).write.mode("overwrite").parquet(f"{path}/{part}={folder}")
        return sorted(partitions, key=lambda v: (v is not None, v))

    def _apply(self, notes: str, shapes: dict[str, DataFrame]) -> dict[str, list]:
        done = {}

        def now(name: str) -> DataFrame:
            return self.read(name, shapes[name])

        def put(name: str, rows: DataFrame, partitions: set) -> None:
            done[name] = self._replace(notes, name, rows, partitions)

        keys = self._noted(notes, "session_keys")
        before, after = self._noted(notes, "sessions_before"), self._noted(notes, "sessions_after")
        dates = _values(before.select("session_date").union(after.select("session_date")), "session_date")
        kept = now("int_user_sessions").where(_in("session_date", dates))
        put("int_user_sessions", _same(kept, keys, SESSION_KEYS, "left_anti").unionByName(after), dates)

        differ = self._noted(notes, "orders_changed")
        ids, dates = differ.select("order_id").distinct(), _values(differ, "placed_date")
        kept = now("int_order_items_enriched").where(_in("placed_date", dates)).join(ids, "order_id", "left_anti")
        again = self._noted(notes, "orders_after").join(ids, "order_id", "left_semi")
        put("int_order_items_enriched", kept.unionByName(again), dates)

        orders = now("int_order_items_enriched")
        of_dates = orders.where(_in("placed_date", dates))
        put("int_daily_revenue", marts.daily_revenue_base(of_dates), dates)
        put("int_product_daily", marts.product_daily(of_dates), dates)
        for name, source, group, rows_back, mart in (
                ("mart_daily_revenue", "int_daily_revenue", _DAILY_KEYS, 7, marts.daily_revenue_of),
                ("mart_product_performance", "int_product_daily", ["product_id"], None, marts.product_performance_of)):
            daily = now(source)
            gone = self._noted(notes, f"{source}_before")
            put(name, mart(daily, with_audit=True), dates | reached(daily, gone, group, rows_back, dates) if dates else set())

        customers = self._noted(notes, "customers")
        kept = now("mart_user_behavior")
        rows = self._customers(orders.join(customers, "customer_id", "left_semi"),
                               now("int_user_sessions").join(customers, "customer_id", "left_semi"))
        part = F.pmod(F.xxhash64("customer_id"), F.lit(self.parts)).cast("int").alias("customer_part")
        held = kept.join(customers, "customer_id", "left_semi").select("customer_part")
        parts = _values(held.union(customers.select(part)), "customer_part")
        put("mart_user_behavior", kept.where(_in("customer_part", parts)).join(customers, "customer_id", "left_anti")
            .unionByName(rows), parts)
        return done


def reached(daily: DataFrame, gone: DataFrame, group: list[str], rows_back: int | None, dates: set) -> set:
    """Dates of rows that read a changed one: rows of ``dates``, now or before (``gone``), that
    lie at most ``rows_back`` rows of their group before them (None: at any distance)."""
    first = F.lit("0001-01-01").cast("date")   # rows without a date come first
    at = F.coalesce("order_date", first).alias("at")
    by_date = Window.partitionBy(*group).orderBy("at")
    rows = daily.select(*group, "order_date", at)
    since = F.lag("at", rows_back).over(by_date) if rows_back else F.lit(None).cast("date")
    rows = rows.withColumn("since", F.coalesce(since, first)).withColumn("changed", F.lit(None).cast("date"))
    changed = (daily.where(_in("order_date", dates)).select(*group, at).union(gone.select(*group, at)).distinct()
               .select(*group, F.lit(None).cast("date").alias("order_date"), "at",
                       F.lit(None).cast("date").alias("since"), F.col("at").alias("changed")))
    last = F.max("changed").over(by_date.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    hit = rows.unionByName(changed).withColumn("last", last).where("since is not null and last >= since")
    return _values(hit, "order_date")

