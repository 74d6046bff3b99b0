"""Command-line entry points (``python -m emporion <command>``), one per job:

  stream-orders | stream-clicks | stream-inventory   topic -> parse -> rules -> sinks
  stream-attribution                                landed orders and clicks -> orders with their session
  hourly                                            one hour of the order lake -> hourly tables
  models                                            staging -> intermediates -> marts -> data tests
  query                                             run one registered query on the test tables
  make-feed                                         Kafka-shaped Parquet feed from the test tables

Paths may be any Hadoop-compatible URI.  The session comes from
``SparkSession.builder.getOrCreate()`` (spark-submit settings apply).
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("emporion").getOrCreate()


def _topic(spark: SparkSession, a: argparse.Namespace, topic: str):
    from .streaming import sources
    if a.source == "kafka":
        return sources.kafka_topic(spark, a.bootstrap, a.topic or topic, a.starting_offsets, a.max_offsets)
    return sources.file_topic(spark, a.input, a.max_files)


def _paths(a: argparse.Namespace):
    from .streaming.jobs import StreamPaths
    root = a.output.rstrip("/")
    return StreamPaths(lake=f"{root}/lake", landing=f"{root}/landing", rejected=f"{root}/rejected",
                       aggregates=f"{root}/aggregates", checkpoint_root=a.checkpoint or f"{root}/_checkpoints",
                       sessions=f"{root}/sessions")


def _jdbc(a: argparse.Namespace):
    from .streaming.relational import JdbcTarget
    if not a.jdbc_url:
        return None
    return JdbcTarget(a.jdbc_url, a.jdbc_prefix, dict(p.split("=", 1) for p in a.jdbc_property))


def _stream(a: argparse.Namespace) -> int:
    from .streaming import jobs, sinks
    spark = _session()
    topic = {"stream-orders": "orders", "stream-clicks": "clickstream", "stream-inventory": "inventory_updates"}
    raw = _topic(spark, a, topic[a.command])
    paths = _paths(a)
    if a.command == "stream-orders":
        job = jobs.start_orders_job(raw, paths, available_now=a.available_now, update_mode=a.update_mode,
                                    dedupe=a.dedupe, jdbc=_jdbc(a))
    elif a.command == "stream-clicks":
        job = jobs.start_clicks_job(raw, paths, available_now=a.available_now, update_mode=a.update_mode,
                                    dedupe=a.dedupe, jdbc=_jdbc(a))
    else:
        job = jobs.start_inventory_job(raw, paths, available_now=a.available_now, jdbc=_jdbc(a))
    if a.available_now:
        job.wait()
    else:
        sinks.await_any(spark, job.queries)
    return 0


def _attribution(a: argparse.Namespace) -> int:
    from .streaming import jobs, sinks
    spark = _session()
    job = jobs.start_attribution_job(spark, a.orders_lake, a.clicks_lake, a.output, a.checkpoint or f"{a.output.rstrip('/')}_checkpoints",
                                     a.available_now, a.session_days, a.max_files, _jdbc(a))
    if a.available_now:
        job.wait()
    else:
        sinks.await_any(spark, job.queries)
    return 0


def _hourly(a: argparse.Namespace) -> int:
    from .plans.pipeline import run_hourly_batch
    spark = _session()
    hour = None
    if a.hour:
        hour = datetime.fromisoformat(a.hour)
        hour = hour.replace(tzinfo=timezone.utc) if hour.tzinfo is None else hour.astimezone(timezone.utc)
    sessions = spark.read.parquet(a.sessions) if a.sessions else None
    res = run_hourly_batch(spark, a.lake, a.output, hour, top_k=a.top_k, sessions=sessions, jdbc=_jdbc(a))
    print(f"[hourly] {res}")
    return 0


def _models(a: argparse.Namespace) -> int:
    from .plans.pipeline import GateError, check_after, check_before, run_models
    spark = _session()
    orders, clicks = spark.read.parquet(a.orders), spark.read.parquet(a.clicks)
    as_of = datetime.fromisoformat(a.as_of) if a.as_of else datetime.now(timezone.utc)
    as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of
    if a.gates:
        try:
            check_before(spark, orders, clicks, as_of, a.lake)
        except GateError as exc:
            print(f"[models] not started: {exc}", file=sys.stderr)
            return 2
    run = run_models(spark, orders, clicks, out_dir=a.output, as_tables=a.tables)
    failed = run.failed_tests()
    for r in run.tests.orderBy("check_name").collect():
        print(f"{r.status.upper():5s} {r.check_name} ({r.violations})")
    if a.gates:
        try:
            check_after(run, as_of)
        except GateError as exc:
            print(f"[models] {exc}", file=sys.stderr)
            return 1
    return 1 if failed and a.fail_on_test else 0


def _refresh(a: argparse.Namespace) -> int:
    from .plans.refresh import Models
    spark = _session()
    models = Models(spark, a.output, parts=a.customer_parts)
    orders, clicks = spark.read.parquet(a.orders), spark.read.parquet(a.clicks)
    if a.build:
        models.build(orders, clicks)
        return 0
    if a.batch is None or not (a.new_orders or a.new_clicks):
        print("[refresh] needs --batch and --new-orders or --new-clicks (or --build)", file=sys.stderr)
        return 2
    new_orders = spark.read.parquet(a.new_orders) if a.new_orders else orders.where("false")
    new_clicks = spark.read.parquet(a.new_clicks) if a.new_clicks else clicks.where("false")
    for name, written in models.refresh(orders, clicks, new_orders, new_clicks, a.batch).items():
        print(f"[refresh] {name}: {len(written)} partitions")
    return 0


def _query(a: argparse.Namespace) -> int:
    from .plans.queries import QUERIES
    spark = _session()
    df = QUERIES[a.name](spark, a.sf_dir)
    if a.output:
        df.write.mode("overwrite").parquet(a.output)
    else:
        df.show(a.show, truncate=False)
    return 0


def _make_feed(a: argparse.Namespace) -> int:
    """Write one folder per ``--days-per-file`` slice of event time, in time
    order, so a file stream with ``maxFilesPerTrigger=1`` replays the topic."""
    from pyspark.sql import functions as F

    from .plans import queries as Q
    spark = _session()
    rows = {"orders": Q.order_topic_rows, "clicks": Q.click_topic_rows,
            "inventory": Q.inventory_topic_rows}[a.topic](spark, a.sf_dir)
    first = rows.agg(F.min(F.to_date("timestamp")).alias("d")).first().d
    sliced = rows.withColumn("_slice", (F.datediff(F.to_date("timestamp"), F.lit(first)) / a.days_per_file)
                             .cast("int"))
    last = sliced.agg(F.max("_slice")).first()[0]
    for i in range(last + 1):   # one write per slice, oldest first: file times follow event time
        sliced.filter(F.col("_slice") == i).drop("_slice").write.mode("overwrite").parquet(
            f"{a.output.rstrip('/')}/slice={i:04d}")
    return 0


def _jdbc_arguments(parser: argparse.ArgumentParser, prefix: str) -> None:
    parser.add_argument("--jdbc-url", help="also write the results to a database (driver on the classpath)")
    parser.add_argument("--jdbc-prefix", default=prefix, help="table name prefix")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="emporion")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("stream-orders", "stream-clicks", "stream-inventory"):
        s = sub.add_parser(name)
        s.add_argument("--source", choices=["kafka", "files"], default="kafka")
        s.add_argument("--bootstrap", default="localhost:9092")
        s.add_argument("--topic")
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--max-offsets", type=int, help="rate limit per trigger; default: none")
        s.add_argument("--input", help="folder of Kafka-shaped Parquet files (--source files)")
        s.add_argument("--max-files", type=int, default=1)
        s.add_argument("--output", required=True)
        s.add_argument("--checkpoint")
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--update-mode", action="store_true")
        s.add_argument("--dedupe", action="store_true", help="drop redelivered events before the windows")
        _jdbc_arguments(s, f"{name.removeprefix('stream-')}_")
    t = sub.add_parser("stream-attribution")
    t.add_argument("--orders-lake", required=True)
    t.add_argument("--clicks-lake", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--checkpoint")
    t.add_argument("--available-now", action="store_true")
    t.add_argument("--session-days", type=int, default=1, help="days past its start a session may go on")
    t.add_argument("--max-files", type=int)
    _jdbc_arguments(t, "orders_")
    h = sub.add_parser("hourly")
    h.add_argument("--lake", required=True)
    h.add_argument("--output", required=True)
    h.add_argument("--hour", help="ISO start of the hour; default: last full UTC hour")
    h.add_argument("--top-k", type=int)
    _jdbc_arguments(h, "hourly_")
    h.add_argument("--sessions", help="session table (e.g. the model run's int_user_sessions) for attribution")
    m = sub.add_parser("models")
    m.add_argument("--orders", required=True, help="landed orders (Parquet)")
    m.add_argument("--clicks", required=True, help="landed clicks (Parquet)")
    m.add_argument("--output")
    m.add_argument("--tables", action="store_true", help="register catalog tables and ANALYZE them")
    m.add_argument("--fail-on-test", action="store_true")
    m.add_argument("--gates", action="store_true", help="check volume, freshness and lake before, tests and SLA after; fail on error")
    m.add_argument("--as-of", help="ISO time of the checks; default: now")
    m.add_argument("--lake", help="order lake that must hold rows (--gates)")
    r = sub.add_parser("refresh", help="bring kept models up to new rows, writing only the partitions they reach")
    r.add_argument("--orders", required=True, help="order lake, new rows included")
    r.add_argument("--clicks", required=True, help="click lake, new rows included")
    r.add_argument("--new-orders", help="the new rows alone (a landing batch)")
    r.add_argument("--new-clicks", help="the new rows alone (a landing batch)")
    r.add_argument("--output", required=True)
    r.add_argument("--batch", help="name of this refresh; a run that was cut short is repeated with the same one")
    r.add_argument("--build", action="store_true", help="first build from all rows")
    r.add_argument("--customer-parts", type=int, default=64)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--output")
    q.add_argument("--show", type=int, default=20)
    f = sub.add_parser("make-feed")
    f.add_argument("topic", choices=["orders", "clicks", "inventory"])
    f.add_argument("--sf-dir", required=True)
    f.add_argument("--output", required=True)
    f.add_argument("--days-per-file", type=int, default=8)
    a = p.parse_args(argv)
    handler = {"stream-attribution": _attribution, "hourly": _hourly, "models": _models, "refresh": _refresh, "query": _query, "make-feed": _make_feed}.get(a.command, _stream)
    return handler(a)


if __name__ == "__main__":
    sys.exit(main())
