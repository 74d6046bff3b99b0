"""Order -> session attribution (left outer, nearest session start).

Semantics: an order matches a session of the same customer whose
``session_date`` equals the order's date and whose
``[session_start, session_end + 30 min]`` contains the order time; the best
match is the one with the smallest |order time - session start|.  Every order
is kept (one row per order_id), unmatched ones get the defaults
'unknown'/'unknown'/'direct'.

``orders_enriched`` is an ordered sweep, linear in the rows:

* A session that contains the order's time has started by then, so the nearest
  start is the *latest live* one.  Session starts and orders of a customer and
  day are merged in time order; the sweep keeps the live sessions that no later
  one outlives, latest start on top, and drops the top for good once it has
  ended.  Each session is pushed and dropped once, however many orders meet it:
  no pair of rows is ever compared.
* The time line of a customer-day is cut into pieces (default: hours).  A piece
  begins with carry rows: a copy of each session that is live at its start.  A
  customer with huge activity is split over the pieces; the copies are at most
  one per piece a session covers (24 a day for hours).
* Rows are dealt by (customer, piece) and sorted by Spark (the sort spills); the
  sweep streams over them in Arrow batches and holds one batch and the live
  sessions, never a whole piece.  Orders without customer or time match nothing;
  they are dealt by their order_id, so the orders are read once.
* Sessions carry what orders them and what is asked of them: a carry row is narrow.
* Only order ids that occur more than once need a best match.  A caller that knows
  them (``repeated_orders``) names them: all other orders leave the sweep as they
  are, without a second shuffle, and carry only the columns that are asked for.
* The best match of a repeated order_id uses ``row_number() == 1`` so that
  Catalyst inserts a partial WindowGroupLimit before the shuffle (at most one
  row per order per map task crosses the network).  Ties are broken by
  session_id, device, browser, channel, then the order payload.

``match_orders_to_sessions`` lists all candidate pairs with their rank (an
equi-join with the same pieces as key and the range as residual); it is the
definition that the sweep is tested against.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.expressions import micros_between
from ..schemas import ATTRIBUTION_GRACE
from ..session import ship

ORDER_COLUMNS = [
    "order_id", "customer_id", "product_id", "product_name", "category", "quantity",
    "unit_price", "order_total", "order_status", "shipping_state", "payment_method",
    "is_cancelled", "order_value_tier", "order_placed_at", "pipeline_processed_at",
]

_SESSION_TIEBREAK = ["session_id", "device_type", "browser", "attribution_channel"]
SESSION_COLUMNS = [*_SESSION_TIEBREAK, "session_outcome", "engagement_score"]
_SESSION_PAYLOAD = ["session_start", *SESSION_COLUMNS]

_PAYLOAD_TIEBREAK = [
    "order_placed_at", "customer_id", "product_id", "product_name", "category", "quantity",
    "unit_price", "order_total", "order_status", "shipping_state", "payment_method",
    "pipeline_processed_at",
]


def _bucket(ts, minutes: int):
    """Start of the ``minutes``-wide bucket of ``ts`` (buckets aligned to the
    day; ``minutes`` divides 1440)."""
    if minutes == 60:
        return F.date_trunc("hour", ts)
    day = F.date_trunc("day", ts)
    offset = (F.floor(micros_between(day, ts) / (minutes * 60_000_000)) * minutes).cast("int")
    return F.timestamp_add("MINUTE", offset, day)


def _buckets(start, stop, minutes: int):
    return F.explode(F.sequence(_bucket(start, minutes), _bucket(stop, minutes),
                                F.expr(f"INTERVAL {minutes} MINUTES")))


def session_candidates(sessions: DataFrame, grace: str = ATTRIBUTION_GRACE, bucket_minutes: int = 60) -> DataFrame:
    """Sessions with a known customer, one row per time bucket covered by
    ``[session_start, session_end + grace]`` within the session's date."""
    if 1440 % bucket_minutes:
        raise ValueError("bucket_minutes must divide a day")
    s = sessions.filter(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").alias("_s_customer"),
        F.col("session_date").alias("_s_date"),
        "session_start",
        (F.col("session_end") + F.expr(f"INTERVAL {grace}")).alias("_cover_end"),
        "session_id", "device_type", "browser",
        F.col("referrer").alias("attribution_channel"),
        "session_outcome", "engagement_score",
    )
    day_end = F.col("_s_date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND")
    return s.withColumn("_bucket", _buckets(F.col("session_start"), F.least(F.col("_cover_end"), day_end),
                                            bucket_minutes))


def match_orders_to_sessions(orders: DataFrame, sessions: DataFrame, grace: str = ATTRIBUTION_GRACE,
                             bucket_minutes: int = 60) -> DataFrame:
    """All candidate (order, session) pairs plus unmatched orders, with
    ``match_rank`` (1 = best)."""
    o = orders.select(*ORDER_COLUMNS).withColumns({
        "_o_date": F.to_date("order_placed_at"),
        "_bucket": _bucket(F.col("order_placed_at"), bucket_minutes),
    })
    s = session_candidates(sessions, grace, bucket_minutes)
    cond = [
        o.customer_id == s._s_customer,
        o._o_date == s._s_date,
        o._bucket == s._bucket,
        o.order_placed_at.between(s.session_start, s._cover_end),
    ]
    return _ranked(o.join(s, cond, "left"))


def _ranked(matched: DataFrame) -> DataFrame:
    order_by = [F.abs(micros_between("session_start", "order_placed_at")).asc_nulls_last()]
    order_by += [F.col(c).asc_nulls_last() for c in (*_SESSION_TIEBREAK, *_PAYLOAD_TIEBREAK)]
    return matched.withColumn("match_rank", F.row_number().over(Window.partitionBy("order_id").orderBy(*order_by)))


def _sweep(batches: Iterator[pa.RecordBatch], keys: list[str], orders: list[str], payload: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of whole groups (equal ``keys``) in order of time, sessions before
    orders -> each order with the payload of the latest live session."""
    live, live_until, last = None, [], None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = pa.Table.from_batches([batch])
        fresh = np.zeros(n, dtype=bool)  # rows that begin a group
        first = [rows.column(k)[0] for k in keys]
        fresh[0] = last is None or any(not a.equals(b) for a, b in zip(first, last))
        last = [rows.column(k)[n - 1] for k in keys]
        for k in keys:
            c = rows.column(k).combine_chunks()
            # a row without customer is a group of its own
            fresh[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).fill_null(True).to_numpy(zero_copy_only=False)
        is_order = rows.column("_is_order").to_numpy()
        at, until = (rows.column(c).cast(pa.int64()).fill_null(0).to_pylist() for c in ("_at", "_cover_end"))
        pool = rows.select(payload) if live is None else pa.concat_tables([live, rows.select(payload)])
        shift, until = len(live_until), live_until + until
        stack, best = list(range(shift)), []
        for i, (new, order) in enumerate(zip(fresh.tolist(), is_order.tolist())):
            if new:
                stack.clear()
            if order:
                t = at[i]
                while stack and until[stack[-1]] < t:
                    stack.pop()
                best.append(stack[-1] if stack else None)
            else:
                end = until[shift + i]
                while stack and until[stack[-1]] <= end:
                    stack.pop()
                stack.append(shift + i)
        found = rows.select(orders).filter(pa.array(is_order))
        match = pool.take(pa.array(best, pa.int64()))
        live, live_until = pool.take(pa.array(stack, pa.int64())).combine_chunks(), [until[i] for i in stack]
        for c, field in zip(match.columns, match.schema):
            found = found.append_column(field, c)
        yield from found.to_batches()


def repeated_orders(orders: DataFrame) -> DataFrame:
    """``order_hash`` of the order ids that may occur more than once (all that do,
    and what shares a 64-bit hash with another id).  To be written before use: its size
    then tells Spark how to join it."""
    return (orders.groupBy(order_hash()).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("order_hash"))


def order_hash(order_id: str | Column = "order_id") -> Column:
    return F.xxhash64(order_id).alias("order_hash")


def latest_live_session(orders: DataFrame, sessions: DataFrame, grace: str = ATTRIBUTION_GRACE,
                        bucket_minutes: int = 60, columns: list[str] = ORDER_COLUMNS,
                        payload: list[str] = _SESSION_PAYLOAD, customers: int | None = None) -> DataFrame:
    """``columns`` of every order row and ``payload`` of the session that is live
    at its time with the latest start (ties: the least session_id, device, browser,
    channel), null where there is none.  ``customers``: as for ``orders_enriched``."""
    bucket_minutes = 1440 if customers else bucket_minutes
    o = orders.select(*{*columns, "order_id", "customer_id", "order_placed_at"})
    s = session_candidates(sessions, grace, bucket_minutes)
    # only the time itself is shuffled: it is the order's, or the session's start
    keys, placed = ["customer_id", "_bucket"], F.col("order_placed_at")
    carried = [c for c in columns if c not in ("customer_id", "order_placed_at")]
    found_columns = [c for c in payload if c != "session_start"]
    session_columns = [*_SESSION_TIEBREAK, *(c for c in found_columns if c not in _SESSION_TIEBREAK)]
    can_match = F.col("customer_id").isNotNull() & placed.isNotNull()
    apart = F.timestamp_add("SECOND", F.pmod(F.xxhash64("order_id"), F.lit(86_400)).cast("int"), F.lit("1970-01-01").cast("timestamp_ntz"))
    order_rows = o.select(
        "customer_id", F.when(can_match, _bucket(placed, bucket_minutes)).otherwise(apart).alias("_bucket"),
        placed.alias("_at"), F.lit(True).alias("_is_order"), *carried)
    start_rows = s.where(F.col("_cover_end").isNotNull() & (F.to_date("_bucket") == F.col("_s_date"))).select(
        F.col("_s_customer").alias("customer_id"), "_bucket",
        F.col("session_start").alias("_at"), F.lit(False).alias("_is_order"), *session_columns, "_cover_end")
    merged = order_rows.unionByName(start_rows, allowMissingColumns=True)
    if customers:  # the day is read off the time, not dealt; rows without time are a group of no session
        merged = merged.drop("_bucket").repartition(customers, "customer_id").withColumn("_bucket", _bucket(F.col("_at"), bucket_minutes))
    else:
        merged = merged.repartition(*keys)
    ordered = merged.sortWithinPartitions(*keys, "_at", "_is_order", *(F.col(c).desc_nulls_first() for c in _SESSION_TIEBREAK))
    types = {f.name: f.dataType for f in (*s.schema, *o.schema)}
    own, found = ["customer_id", "_at", *carried], ["_at", *found_columns]
    names = ["customer_id", "order_placed_at", *carried, "session_start", *found_columns]
    schema = StructType([StructField(c, types[c]) for c in names])  # any payload is null where nothing matches
    ship(orders.sparkSession)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sweep(batches, keys, own, found):
            yield pa.RecordBatch.from_arrays(b.columns, names=names)

    return ordered.mapInArrow(sweep, schema).select(*columns, *payload)


def orders_enriched(stg_orders: DataFrame, sessions: DataFrame, grace: str = ATTRIBUTION_GRACE,
                    bucket_minutes: int = 60, repeated: DataFrame | None = None,
                    columns: list[str] | None = None, session_columns: list[str] | None = None,
                    where: Column | None = None, customers: int | None = None) -> DataFrame:
    """``bucket_minutes`` sets the width of the pieces of the sweep: narrower
    ones split a hot customer-day into smaller groups at the cost of more carry
    rows; the result is the same for any width.

    ``repeated`` are the written ``repeated_orders`` (without it any order id may
    be repeated); ``columns`` and ``session_columns`` are the columns of orders and
    sessions that are asked for (default: all).  ``where`` are the orders asked for, by
    order columns alone: repeated ones are dropped by it after their best match is known
    (it may be one that goes), all others before the sweep.  ``customers`` is for a caller
    that groups the result by customer: all rows are dealt once, by customer alone, into
    that many partitions, and lie as in a table with that many buckets.  A customer then is
    one task's, as in that grouping; pieces would split nothing and are days, without carry rows."""
    wanted = [c for c in ORDER_COLUMNS if columns is None or c in columns]
    payload = [c for c in SESSION_COLUMNS if session_columns is None or c in session_columns]

    where = F.lit(True) if where is None else where

    def best(orders: DataFrame) -> DataFrame:
        first = _ranked(latest_live_session(orders, sessions, grace, bucket_minutes, customers=customers)).filter(F.col("match_rank") == 1)
        rows = with_defaults(first.filter(where), wanted, payload)
        return rows.repartition(customers, "customer_id") if customers else rows

    def only(orders: DataFrame) -> DataFrame:
        return with_defaults(latest_live_session(orders.filter(where), sessions, grace, bucket_minutes, wanted, payload, customers), wanted, payload)

    if repeated is None:
        return best(stg_orders)
    if repeated.isEmpty():
        return only(stg_orders)
    again = order_hash() == repeated["order_hash"]
    return (only(stg_orders.join(repeated, again, "left_anti"))
            .unionByName(best(stg_orders.join(repeated, again, "left_semi"))))


def with_defaults(best: DataFrame, columns: list[str] = ORDER_COLUMNS, payload: list[str] = SESSION_COLUMNS) -> DataFrame:
    default = {"device_type": "unknown", "browser": "unknown", "attribution_channel": "direct"}
    return best.select(*columns, *(F.coalesce(c, F.lit(default[c])).alias(c) if c in default else c for c in payload))
