from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tapeline.functions import dates
from tapeline.operators import calendar

# Open days, and where dates fall among them.
DAYS = ["1991-01-02", "1991-01-03", "1991-01-04", "1991-01-07", "1991-01-08"]


def frame(spark, days):
    return spark.createDataFrame([(date.fromisoformat(d),) for d in days], "d date")


def slots(spark, raw, days=DAYS):
    df = spark.createDataFrame([(r,) for r in raw], "raw string").withColumn("date", dates.day("raw"))
    return {r["raw"]: r["cal_idx"] for r in calendar.to_slots(df, "date", frame(spark, days)).collect()}


def test_forward_to_next_open_day(spark):
    got = slots(spark, ["19910103", "19910106", "19910102", "19910108", "19910105 09:30"])
    assert got == {"19910103": 1, "19910106": 3, "19910102": 0, "19910108": 4, "19910105 09:30": 3}


def test_dates_without_a_slot(spark):
    assert slots(spark, ["19900101", "19920101", "", "1991", None, "notadate"]) == {}


def test_empty_calendar(spark):
    assert slots(spark, ["19910103"], []) == {}


def test_changed_days(spark):
    assert calendar.changed_days(frame(spark, DAYS[:3]), frame(spark, DAYS)).count() == 0
    assert [r["idx"] for r in calendar.changed_days(frame(spark, DAYS), frame(spark, DAYS[:4])).collect()] == [4]


def test_load_cutoff(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 12, 29),), (datetime(2024, 1, 5, 12, 30),), (datetime(2024, 1, 5, 17, 0),)], "ts timestamp_ntz")
    out = df.orderBy("ts").select(dates.load_cutoff("ts").alias("a"), dates.load_cutoff("ts", "bad").alias("b")).collect()
    assert [r["a"] for r in out] == [r["b"] for r in out] == [date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 5)]


def test_once_keys(spark):
    row = spark.range(1).select(dates.partition_key("domain", code=F.lit("000001.SZ")).alias("a"), dates.partition_key("domain", code=F.lit("X"), period=F.lit("202401")).alias("b")).first()
    assert tuple(row) == ("000001.SZ__once__", "X_202401")
