"""The command-line jobs run end to end (in-process, sharing the test session)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporion import cli
from emporion.plans import queries as Q
from emporion.sources import fixtures


def test_cli_stream_hourly_models_query(spark, scratch):
    feed = f"{scratch}/feed"
    Q.order_topic_rows(spark, SF_SMALL).write.parquet(feed)
    out = f"{scratch}/out"
    assert cli.main(["stream-orders", "--source", "files", "--input", feed, "--max-files", "0",
                     "--output", out, "--available-now"]) == 0
    lake = spark.read.parquet(f"{out}/lake")
    assert lake.count() > 5000 and "event_date" in lake.columns
    day = lake.agg(F.min("event_timestamp")).first()[0]
    hour = day.replace(minute=0, second=0, microsecond=0).isoformat()
    assert cli.main(["hourly", "--lake", f"{out}/lake", "--output", f"{out}/hourly", "--hour", hour]) == 0
    assert spark.read.parquet(f"{out}/hourly/hourly_revenue_by_category").count() > 0
    fixtures.raw_orders(spark, SF_SMALL).write.parquet(f"{scratch}/orders")
    fixtures.raw_clicks(spark, SF_SMALL).write.parquet(f"{scratch}/clicks")
    assert cli.main(["models", "--orders", f"{scratch}/orders", "--clicks", f"{scratch}/clicks",
                     "--output", f"{scratch}/models"]) == 0
    assert cli.main(["models", "--orders", f"{scratch}/orders", "--clicks", f"{scratch}/clicks",
                     "--output", f"{scratch}/models2", "--fail-on-test"]) == 1   # known failing tests
    assert cli.main(["query", "daily_revenue", "--sf-dir", SF_SMALL, "--output", f"{scratch}/q"]) == 0
    assert spark.read.parquet(f"{scratch}/q").count() > 0


def test_cli_make_feed_then_stream_clicks(spark, scratch):
    assert cli.main(["make-feed", "clicks", "--sf-dir", SF_SMALL, "--output", f"{scratch}/feed"]) == 0
    assert cli.main(["stream-clicks", "--source", "files", "--input", f"{scratch}/feed", "--output",
                     f"{scratch}/out", "--available-now", "--dedupe"]) == 0
    kept = sum(spark.read.parquet(f"{scratch}/out/{x}").count() for x in ("lake", "rejected"))
    assert kept == Q.click_topic_rows(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{scratch}/out/aggregates").count() > 0


def test_cli_models_as_catalog_tables(spark, scratch):
    fixtures.raw_orders(spark, SF_SMALL).write.parquet(f"{scratch}/orders")
    fixtures.raw_clicks(spark, SF_SMALL).write.parquet(f"{scratch}/clicks")
    assert cli.main(["models", "--orders", f"{scratch}/orders", "--clicks", f"{scratch}/clicks",
                     "--output", f"{scratch}/models", "--tables"]) == 0
    assert spark.table("mart_daily_revenue").count() > 0
    stats = spark.sql("DESCRIBE TABLE EXTENDED int_order_items_enriched").filter("col_name = 'Statistics'").collect()
    assert stats


def test_cli_inventory_feed_and_stream(spark, scratch):
    assert cli.main(["make-feed", "inventory", "--sf-dir", SF_SMALL, "--output", f"{scratch}/feed"]) == 0
    assert cli.main(["stream-inventory", "--source", "files", "--input", f"{scratch}/feed", "--output",
                     f"{scratch}/out", "--available-now"]) == 0
    lake = spark.read.parquet(f"{scratch}/out/lake")
    assert lake.count() == Q.inventory_topic_rows(spark, SF_SMALL).count()
    assert lake.filter("stock_after < 20").count() == lake.filter("low_stock_alert").count()


def test_cli_stream_orders_update_mode(spark, scratch):
    assert cli.main(["make-feed", "orders", "--sf-dir", SF_SMALL, "--output", f"{scratch}/feed"]) == 0
    assert cli.main(["stream-orders", "--source", "files", "--input", f"{scratch}/feed", "--output",
                     f"{scratch}/out", "--available-now", "--update-mode"]) == 0
    from emporion.streaming import jobs
    assert jobs.current_order_windows(spark, f"{scratch}/out/aggregates").count() > 5000


def test_cli_model_gates(spark, scratch, capsys):
    fixtures.raw_orders(spark, SF_SMALL).write.parquet(f"{scratch}/orders")
    fixtures.raw_clicks(spark, SF_SMALL).write.parquet(f"{scratch}/clicks")
    models = ["models", "--orders", f"{scratch}/orders", "--clicks", f"{scratch}/clicks", "--output", f"{scratch}/m", "--gates"]
    assert cli.main([*models, "--as-of", "2024-03-01T00:00:00+00:00"]) == 2      # stale and no recent rows
    assert "stale" in capsys.readouterr().err
    assert cli.main([*models, "--as-of", "2024-01-31T00:05:00", "--lake", f"{scratch}/none"]) == 2
    assert "no rows in the lake" in capsys.readouterr().err
    assert cli.main([*models, "--as-of", "2024-01-31T00:05:00", "--lake", f"{scratch}/orders"]) == 1   # failing data tests, late mart
    assert "data test" in capsys.readouterr().err
