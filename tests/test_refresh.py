"""Refresh by changed days equals a rebuild, and leaves other partitions' files alone."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporion.plans import refresh
from emporion.sources import fixtures


def lakes(spark, scratch):
    """Orders and clicks with a batch number, written by date: batch 0 is the past, 1 the
    newest days with late rows of earlier ones, 2 a few late rows only."""
    orders, clicks = fixtures.raw_orders(spark, SF_SMALL), fixtures.raw_clicks(spark, SF_SMALL)
    day = F.to_date("event_timestamp")
    late = F.when(day >= "2024-01-29", 1)
    orders = orders.withColumn("batch", late.when(F.xxhash64("order_id") % 997 == 0, 1)
                               .when((F.xxhash64("order_id") % 499 == 0) & (day >= "2024-01-20"), 2).otherwise(0))
    clicks = clicks.withColumn("batch", late.when(F.xxhash64("event_id") % 199 == 0, 1)
                               .when((F.xxhash64("event_id") % 97 == 0) & (day >= "2024-01-20"), 2).otherwise(0))
    # ids that come again on another day, one of them as the only row of a far one
    again = orders.where("batch = 0 and xxhash64(order_id) % 500 = 7")
    orders = orders.unionByName(again.withColumn("batch", F.lit(1)).withColumn("event_timestamp", F.expr("event_timestamp + interval 3 days")))
    one = orders.where("batch = 0 and order_total > 0 and quantity > 0 and customer_id is not null").orderBy("order_id", "event_timestamp").limit(1)
    far = F.lit("2023-11-05 10:00:00").cast(orders.schema["event_timestamp"].dataType)
    orders = orders.unionByName(one.withColumn("batch", F.lit(0)).withColumn("order_id", F.lit("FAR")).withColumn("event_timestamp", far))
    for name, df in (("orders", orders), ("clicks", clicks)):
        df.withColumn("event_date", day).write.partitionBy("event_date").parquet(f"{scratch}/{name}")
    return spark.read.parquet(f"{scratch}/orders"), spark.read.parquet(f"{scratch}/clicks")


def rows(models, name):
    df = models.read(name)
    df = df.select(*sorted(c for c in df.columns if c != "updated_at"))
    return sorted(map(repr, df.collect()))


def files(base, name):
    return {p.relative_to(base).as_posix() for p in Path(base, name).rglob("*.parquet")}


def upto(df, batch):
    return df.where(F.col("batch") <= batch).drop("batch")


def of(df, batch):
    return df.where(F.col("batch") == batch).drop("batch")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("refresh"))
    orders, clicks = lakes(spark, scratch)
    for batch in (1, 2):
        assert of(orders, batch).count() > 0 and of(clicks, batch).count() > 0
    whole = refresh.Models(spark, f"{scratch}/whole", parts=8)
    whole.build(upto(orders, 2), upto(clicks, 2))
    refresh.Models(spark, f"{scratch}/start", parts=8).build(upto(orders, 0), upto(clicks, 0))
    return scratch, orders, clicks, whole


def test_refresh_equals_rebuild(spark, world):
    scratch, orders, clicks, whole = world
    base = f"{scratch}/kept"
    shutil.copytree(f"{scratch}/start", base)
    kept = refresh.Models(spark, base, parts=8)
    for batch in (1, 2):
        had = {name: files(base, name) for name in refresh.PARTITIONS}
        done = kept.refresh(upto(orders, batch), upto(clicks, batch), of(orders, batch), of(clicks, batch), batch)
        for name, part in refresh.PARTITIONS.items():
            written = {f"{name}/{part}={v}/" for v in done[name]}
            old = {f for f in had[name] if not any(f.startswith(w) for w in written)}
            assert old <= files(base, name)                       # untouched partitions keep their files
            assert not {f for f in had[name] - old} & files(base, name)
            if part != "customer_part":
                assert old, name
    for name in refresh.PARTITIONS:
        assert rows(kept, name) == rows(whole, name), name
    # the same batch once more changes nothing
    kept.refresh(upto(orders, 2), upto(clicks, 2), of(orders, 2), of(clicks, 2), 2)
    for name in refresh.PARTITIONS:
        assert rows(kept, name) == rows(whole, name), name


@pytest.mark.parametrize("step", [1, 4])
def test_cut_short_and_repeated(spark, world, step, monkeypatch):
    """A run that dies before its step-th table is repeated with the same batch."""
    scratch, orders, clicks, whole = world
    base = f"{scratch}/cut-{step}"
    shutil.copytree(f"{scratch}/start", base)
    kept = refresh.Models(spark, base, parts=8)
    args = (upto(orders, 2), upto(clicks, 2), *(df.where("batch > 0").drop("batch") for df in (orders, clicks)), 1)
    real, calls = refresh.Models._replace, []

    def dies(self, *a):
        if len(calls) == step:
            raise RuntimeError("lost")
        calls.append(a[1])
        return real(self, *a)

    with monkeypatch.context() as m:
        m.setattr(refresh.Models, "_replace", dies)
        with pytest.raises(RuntimeError):
            kept.refresh(*args)
    kept.refresh(*args)
    for name in refresh.PARTITIONS:
        assert rows(kept, name) == rows(whole, name), name


def test_emptied_days_and_empty_batches(spark, world):
    """An id that comes again elsewhere empties its day; a batch without rows writes nothing."""
    scratch, orders, clicks, _ = world
    base = f"{scratch}/empty"
    shutil.copytree(f"{scratch}/start", base)
    kept = refresh.Models(spark, base, parts=8)
    old, seen = upto(orders, 0), upto(clicks, 0)
    none = kept.refresh(old, seen, old.where("false"), seen.where("false"), "none")
    assert not any(none.values())
    far = old.where("order_id = 'FAR'")
    earlier = far.withColumn("event_timestamp", F.expr("event_timestamp - interval 2 days")).withColumn("event_date", F.expr("event_date - interval 2 days").cast("date"))
    both = old.unionByName(earlier)
    kept.refresh(both, seen, earlier, seen.where("false"), "moved")
    dates = {str(r.placed_date): r.placed_dates for r in kept.read("int_order_items_enriched").where("order_id = 'FAR'").collect()}
    assert [len(d) for d in dates.values()] == [2]
    again = refresh.Models(spark, f"{scratch}/again", parts=8)
    again.build(both, seen)
    for name in refresh.PARTITIONS:
        assert rows(kept, name) == rows(again, name), name


def test_refresh_of_empty_models(spark, world):
    scratch, orders, clicks, _ = world
    old, seen = upto(orders, 0), upto(clicks, 0)
    far = old.where("order_id = 'FAR'")
    nothing = refresh.Models(spark, f"{scratch}/nothing", parts=8)
    nothing.build(old.where("false"), seen.where("false"))
    nothing.refresh(far, seen.where("false"), far, seen.where("false"), 0)
    assert nothing.read("mart_daily_revenue").count() == 1


def test_command(spark, world):
    from emporion import cli
    scratch, orders, clicks, _ = world
    base, days = f"{scratch}/cmd", "event_date between '2024-01-24' and '2024-01-26'"
    paths = {}
    for name, df, since in (("orders", orders, 0), ("clicks", clicks, 0), ("new_orders", orders, 2), ("new_clicks", clicks, 2)):
        paths[name] = f"{scratch}/cmd-{name}"
        df.where(days).where(F.col("batch") >= since).drop("batch").write.mode("overwrite").parquet(paths[name])
    args = ["refresh", "--orders", paths["orders"], "--clicks", paths["clicks"], "--output", base, "--customer-parts", "4"]
    assert cli.main(args) == 2                       # neither a first build nor new rows
    assert cli.main([*args, "--build"]) == 0
    before = {name: rows(refresh.Models(spark, base, 4), name) for name in refresh.PARTITIONS}
    # rows that are in the tables already change nothing
    assert cli.main([*args, "--batch", "7", "--new-orders", paths["new_orders"], "--new-clicks", paths["new_clicks"]]) == 0
    assert {name: rows(refresh.Models(spark, base, 4), name) for name in refresh.PARTITIONS} == before
