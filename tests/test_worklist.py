from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapeline.catalog import TABLES, TableSpec
from tapeline.functions import dates
from tapeline.operators import worklist


def test_natural_days(spark):
    row = spark.range(1).select(dates.natural_days(F.lit("2024-02-27").cast("date"), F.lit("2024-03-02").cast("date")).alias("d")).first()
    assert [str(d) for d in row["d"]] == ["2024-03-02", "2024-03-01", "2024-02-29", "2024-02-28", "2024-02-27"]


def test_strategies_of_the_catalogue(spark):
    start, end = F.lit("2024-01-05").cast("date"), F.lit("2024-01-08").cast("date")  # Friday to Monday
    every = worklist.every_day(start, end, spark)
    open_ = every.where("weekday(d) < 5")
    codes = spark.createDataFrame([("1.SZ",), ("1.SZ",), (None,), ("",), ("2.SH",)], "code string")
    keys = lambda name: sorted(r["date_val"] for r in worklist.expected(TABLES[name], open_, every, codes).collect())
    assert keys("stk_limit") == ["20240105", "20240108"]
    assert keys("repurchase") == ["20240105", "20240106", "20240107", "20240108"]  # announced on any day
    assert keys("dividend") == ["1.SZ_202401", "2.SH_202401"]
    assert keys("stock_basic") == ["__once__"]
    assert [r["date_val"] for r in worklist.expected(TableSpec("y", strategy="date_range"), open_, every).collect()] == ["2024"]
    assert worklist.expected(TableSpec("f", strategy="freq"), open_, every).count() == 4
    with pytest.raises(ValueError, match="codes"):
        worklist.expected(TABLES["dividend"], open_, every)
    for spec in TABLES.values():  # every table of the catalogue has a strategy
        assert worklist.expected(spec, open_, every, codes).columns == ["table_name", "date_val", "start", "end"]


def test_what_is_left(spark):
    every = worklist.every_day(F.lit("2024-01-01").cast("date"), F.lit("2024-02-02").cast("date"), spark)
    codes = {"dividend": spark.createDataFrame([("1.SZ",)], "code string")}
    log = spark.createDataFrame([("dividend", "1.SZ_202401", 2), ("dividend", "1.SZ_202402", 2), ("stock_basic", "__once__", 1), ("repurchase", "20240101", 2), ("repurchase", "20240102", 0)], "table_name string, date_val string, ok int")
    left = worklist.work_list([TABLES[t] for t in ("dividend", "stock_basic", "repurchase")], every, every, log, codes).collect()
    assert [(r["strategy"], r["date_val"]) for r in left if r["table_name"] != "repurchase"] == [("domain", "1.SZ_202402")]
    assert len([r for r in left if r["table_name"] == "repurchase"]) == 32
