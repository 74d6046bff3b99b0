"""UTC conversions in both hours of a clock change, in several session zones."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emporion.functions.expressions import micros_between
from emporion.functions.timeutil import from_utc_wall, utc_date, utc_wall

INSTANTS = ["2024-11-03 04:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00", "2024-03-10 06:59:59.999999", "2024-03-10 07:00:00",
            "2024-10-27 00:30:00", "2024-10-27 01:30:00", "1969-12-31 23:59:59.5"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin", "Asia/Kolkata"])
def test_no_hour_is_folded(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in INSTANTS], "t string").withColumn("i", F.concat("t", F.lit("+00:00")).cast("timestamp"))
        rows = df.select("t", utc_wall(F.col("i")).alias("w"), (F.unix_micros(from_utc_wall(utc_wall(F.col("i")))) == F.unix_micros("i")).alias("back"),
                         utc_date(F.col("i")).alias("d"),
                         micros_between(F.lit("2024-11-03 04:30:00").cast("timestamp_ntz"), utc_wall(F.col("i"))).alias("n")).collect()
        for r in rows:
            at = datetime.fromisoformat(r.t)
            assert r.w == at and r.back and r.d == at.date()
            assert r.n == round((at - datetime(2024, 11, 3, 4, 30)).total_seconds() * 1e6)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
