"""Structured Streaming jobs: topic -> parse -> rules -> sinks.

Each job starts one raw query that writes lake, landing and quarantine from the
parsed stream as it is: no watermark and no deduplication stand before them, so
valid and rejected rows together are the input.  Watermarks (and, if asked for,
deduplication) stand only before the window aggregates.  Every query has its
own checkpoint under ``checkpoint_root``; a restarted job resumes from the
committed offsets and state, and the sinks are replay-safe, so an executor or
driver loss produces neither gaps nor duplicates.

Window aggregates count events as they are delivered.  In **append** mode each
(window, dims) row is emitted once, after the watermark passes the window end.
``update_mode=True`` gives early, repeated updates: the stream then keeps the
first level of the aggregate (a row per customer or key, no sets) in the
keyed-upsert sink, and ``current_order_windows`` / ``current_funnel_windows``
add it up on reading; with a relational target the windows that a batch touched
are upserted there by key.  Both modes give the same closed windows.
``dedupe=True`` drops redelivered copies of an event (all its wire columns equal)
within the watermark; in update mode, which allows one stateful operator, the
deduplicated events are a landed stream of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import inventory_rules
from ..operators import ingest, sessions, windows
from ..schemas import (
    CLICK_MONEY_COLUMNS,
    CLICK_WATERMARK,
    CLICK_WIRE,
    FUNNEL_WINDOW,
    ORDER_MONEY_COLUMNS,
    ORDER_WATERMARK,
    ORDER_WIRE,
    SESSION_GAP,
)
from . import joins, sinks
from .relational import JdbcTarget


#: of the first level of an aggregate (window and dimensions first) and of its rows
ORDER_PART_KEYS = ["window", "category", "shipping_state", "customer_id"]
ORDER_TOTAL_KEYS = ["window_start", "window_end", "category", "shipping_state"]
FUNNEL_PART_KEYS = ["window", "device_type", "referrer", "tag", "key"]
FUNNEL_TOTAL_KEYS = ["window_start", "window_end", "device_type", "referrer"]


@dataclass
class StreamPaths:
    lake: str
    landing: str
    rejected: str
    aggregates: str
    checkpoint_root: str
    sessions: str | None = None


@dataclass
class StreamJob:
    queries: list[StreamingQuery] = field(default_factory=list)

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def wait(self) -> None:
        for q in self.queries:
            q.awaitTermination()


def _observed(df: DataFrame, name: str) -> DataFrame:
    """Row count (and newest event time) per micro-batch, reported in the
    query progress (``observedMetrics``) from the same pass: no extra job."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.max("event_timestamp").alias("max_event_time"))


def _trigger(available_now: bool, interval: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def _raw_query(parsed: DataFrame, paths: StreamPaths, valid_fn, rejected_fn, trigger: dict, jdbc: JdbcTarget | None) -> StreamingQuery:
    # what could not be read stays in the quarantine only
    fan = sinks.raw_fanout_writer(paths.lake, paths.landing, paths.rejected, lambda b: valid_fn(b).drop(*ingest.RAW_COLUMNS), rejected_fn,
                                  jdbc.batch_writer("landing") if jdbc else None)
    return sinks.batch_sink(parsed, fan, f"{paths.checkpoint_root.rstrip('/')}/raw", trigger=trigger)


def _window_query(stream: DataFrame, paths: StreamPaths, parts_fn, totals_fn, part_keys: list[str], total_keys: list[str],
                  name: str, trigger: dict, update_mode: bool, jdbc: JdbcTarget | None) -> StreamingQuery:
    ck = f"{paths.checkpoint_root.rstrip('/')}/{name}"
    if update_mode:
        def current(batch: DataFrame, batch_id: int) -> None:
            """The windows that this batch touched, as they are now, into the database."""
            span = batch.agg(F.min("window.start").alias("low"), F.max("window.start").alias("high")).first()
            if span.low is None:
                return
            rows = sinks.current_rows(batch.sparkSession, paths.aggregates, part_keys,
                                      F.col("window.start").between(F.lit(span.low), F.lit(span.high)))
            touched = batch.select(*(F.col(k).alias(f"_{k}") for k in part_keys[:3])).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in part_keys[:3]]
            jdbc.upsert(totals_fn(rows.join(touched, same, "left_semi")), "aggregates", total_keys, batch_id)

        return sinks.batch_sink(parts_fn(stream), sinks.keyed_upsert_writer(paths.aggregates, current if jdbc else None), ck,
                                output_mode="update", trigger=trigger)
    agg = totals_fn(parts_fn(stream), with_audit=True)
    return sinks.batch_sink(agg, sinks.idempotent_batch_writer(paths.aggregates, jdbc=jdbc.batch_writer("aggregates") if jdbc else None),
                            ck, output_mode="append", trigger=trigger)


def _deduped(stream: DataFrame, identity: list[str], paths: StreamPaths, trigger: dict, update_mode: bool,
             watermark: str) -> tuple[DataFrame, list[StreamingQuery]]:
    """The stream without redelivered events (all wire columns equal), and the
    queries it needs.  Update mode allows one stateful operator, so there the
    deduplication is a query of its own whose output folder is read as a stream."""
    unique = stream.dropDuplicatesWithinWatermark(identity)
    if not update_mode:
        return unique, []
    folder = f"{paths.aggregates.rstrip('/')}_deduplicated"
    first = (unique.writeStream.format("parquet").option("path", folder).option("checkpointLocation", f"{paths.checkpoint_root.rstrip('/')}/dedupe")
             .outputMode("append").trigger(**trigger).start())
    if "availableNow" in trigger:
        first.awaitTermination()  # the second query reads what is there when it starts
    else:
        sinks.make_folder(stream.sparkSession, folder)
    again = stream.sparkSession.readStream.schema(stream.schema).parquet(folder)
    return again.withWatermark("event_timestamp", watermark), [first]


def start_orders_job(raw_topic: DataFrame, paths: StreamPaths, available_now: bool = False,
                     update_mode: bool = False, dedupe: bool = False, jdbc: JdbcTarget | None = None) -> StreamJob:
    def valid(batch: DataFrame) -> DataFrame:
        return ingest.to_money(ingest.valid_orders(batch), ORDER_MONEY_COLUMNS)

    parsed = _observed(ingest.parse_orders(raw_topic, keep_raw=True), "parsed_orders")
    wm, before = _observed(valid(ingest.parse_orders(raw_topic)), "valid_orders").withWatermark("event_timestamp", ORDER_WATERMARK), []
    if dedupe:
        wm, before = _deduped(wm, ORDER_WIRE.fieldNames(), paths, _trigger(available_now, "30 seconds"), update_mode, ORDER_WATERMARK)
    return StreamJob([
        _raw_query(parsed, paths, valid, ingest.rejected_orders, _trigger(available_now, "30 seconds"), jdbc),
        _window_query(wm, paths, windows.order_parts, windows.order_totals, ORDER_PART_KEYS, ORDER_TOTAL_KEYS, "agg",
                      _trigger(available_now, "1 minute"), update_mode, jdbc),
        *before,
    ])


def current_order_windows(spark: SparkSession, path: str) -> DataFrame:
    """Window rows as of the newest update-mode batch."""
    return windows.order_totals(sinks.current_rows(spark, path, ORDER_PART_KEYS))


def start_clicks_job(raw_topic: DataFrame, paths: StreamPaths, available_now: bool = False,
                     update_mode: bool = False, dedupe: bool = False, jdbc: JdbcTarget | None = None) -> StreamJob:
    def valid(batch: DataFrame) -> DataFrame:
        return ingest.to_money(ingest.valid_clicks(batch), CLICK_MONEY_COLUMNS)

    def funnel_parts(stream: DataFrame) -> DataFrame:
        return windows.funnel_parts(stream, duration=FUNNEL_WINDOW)

    agg_t = _trigger(available_now, "1 minute")
    parsed = _observed(ingest.parse_clicks(raw_topic, keep_raw=True), "parsed_clicks")
    wm, before = _observed(valid(ingest.parse_clicks(raw_topic)), "valid_clicks").withWatermark("event_timestamp", CLICK_WATERMARK), []
    if dedupe:
        wm, before = _deduped(wm, CLICK_WIRE.fieldNames(), paths, _trigger(available_now, "30 seconds"), update_mode, CLICK_WATERMARK)
    job = StreamJob([
        _raw_query(parsed, paths, valid, ingest.rejected_clicks, _trigger(available_now, "30 seconds"), jdbc),
        _window_query(wm, paths, funnel_parts, windows.funnel_totals, FUNNEL_PART_KEYS, FUNNEL_TOTAL_KEYS, "funnel", agg_t, update_mode, jdbc),
        *before,
    ])
    if paths.sessions:
        sess = sessions.click_session_windows(wm, SESSION_GAP)
        job.queries.append(sinks.batch_sink(sess, sinks.idempotent_batch_writer(paths.sessions),
                                            f"{paths.checkpoint_root.rstrip('/')}/sessions",
                                            output_mode="append", trigger=agg_t))
    return job


def current_funnel_windows(spark: SparkSession, path: str) -> DataFrame:
    return windows.funnel_totals(sinks.current_rows(spark, path, FUNNEL_PART_KEYS))


def start_inventory_job(raw_topic: DataFrame, paths: StreamPaths, available_now: bool = False,
                        jdbc: JdbcTarget | None = None) -> StreamJob:
    """Inventory topic -> parse -> rules -> lake + landing + quarantine."""
    rules = inventory_rules()
    return StreamJob([_raw_query(ingest.parse_inventory(raw_topic, keep_raw=True), paths, lambda b: ingest.valid(b, rules),
                                 lambda b: ingest.rejected(b, rules), _trigger(available_now, "30 seconds"), jdbc)])


def start_attribution_job(spark: SparkSession, orders_lake: str, clicks_lake: str, path: str, checkpoint_root: str,
                          available_now: bool = False, session_days: int = 1, max_files: int | None = None,
                          jdbc: JdbcTarget | None = None) -> StreamJob:
    """Landed orders and clicks -> attributed orders, upserted by ``order_id``."""
    return StreamJob([joins.start_attribution(spark, orders_lake, clicks_lake, path, f"{checkpoint_root.rstrip('/')}/attribution",
                                              _trigger(available_now, "10 minutes"), session_days, max_files, jdbc)])
