from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapeline.operators import upsert, worklist

EOD = "ts_code string, trade_date string, val double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_by_key(spark):
    old = spark.createDataFrame([("A", "20200101", 1.0), ("A", "20200102", 2.0)], EOD)
    new = spark.createDataFrame([("A", "20200101", 99.0)], EOD)
    assert rows(upsert.upsert(old, new, ["ts_code", "trade_date"], [F.desc("val")])) == [("A", "20200101", 99.0), ("A", "20200102", 2.0)]


def test_whole_row_is_replaced_and_last_wins(spark):
    old = spark.createDataFrame([("A", 1.0, "x")], "ts_code string, val double, note string")
    new = spark.createDataFrame([("A", 2.0, 1), ("A", 3.0, 2)], "ts_code string, val double, seq int")
    out = upsert.upsert(old, new, ["ts_code"], [F.desc("seq")])
    assert [(r["ts_code"], r["val"], r["note"]) for r in out.collect()] == [("A", 3.0, None)]


def test_null_keys_and_empty_rows(spark):
    b = spark.createDataFrame([("A", "20200101", 1.0), (None, "20200101", 2.0), ("C", None, 3.0), (None, None, None)], EOD)
    key = ["ts_code", "trade_date"]
    assert rows(upsert.drop_empty(b, key)) == [("A", "20200101", 1.0)]
    assert upsert.drop_empty(b, key, keep_null_key=True).count() == 3


def test_rows_without_a_key_have_none_in_common(spark):
    key, order = ["ts_code", "trade_date"], [F.desc("val")]
    old = spark.createDataFrame([("A", "1", 1.0), ("B", None, 5.0)], EOD)
    new = spark.createDataFrame([("A", "1", 2.0), ("C", None, 3.0), ("C", None, 4.0), ("B", None, 5.0), ("C", None, 4.0), (None, None, None)], EOD)
    once = upsert.upsert(old, new, key, order, null_keys=True)
    want = sorted([("A", "1", 2.0), ("B", None, 5.0), ("C", None, 3.0), ("C", None, 4.0), ("C", None, 4.0), (None, None, None)], key=str)
    assert rows(once) == want
    assert rows(upsert.upsert(once, new, key, order, null_keys=True)) == want  # a repeated batch changes nothing
    assert rows(upsert.upsert(old, new, key, order)) == [("A", "1", 2.0), ("B", None, 5.0)]


def test_unknown_columns_go(spark):
    b = spark.createDataFrame([("A", 1.0, "x")], "ts_code string, val double, extra string")
    assert upsert.known_columns(b, ["ts_code", "val"]).columns == ["ts_code", "val"]


def test_empty_batch(spark):
    old = spark.createDataFrame([("A", "20200101", 1.0)], EOD)
    assert rows(upsert.upsert(old, old.limit(0), ["ts_code", "trade_date"], [F.desc("val")])) == rows(old)


def test_partition_replace_keeps_several_rows(spark):
    old = spark.createDataFrame([("A", "20240101", 1.0), ("A", "20240101", 2.0), ("B", "20240101", 3.0)], EOD)
    new = spark.createDataFrame([("A", "20240102", 7.0)], EOD)
    assert rows(upsert.replace_partitions(old, new, ["ts_code"])) == [("A", "20240102", 7.0), ("B", "20240101", 3.0)]


LOG = "table_name string, date_val string, ok int, retry_count int, last_try timestamp_ntz"
NOW = datetime(2024, 2, 1)


def log(spark, *r):
    return spark.createDataFrame([(t, d, ok, n, NOW) for t, d, ok, n in r], LOG)


def test_log_transition_and_bad_state(spark):
    old = log(spark, ("a", "1", 0, 2))
    new = spark.createDataFrame([("a", "1", 1, datetime(2024, 2, 2)), ("b", "1", 2, NOW)], "table_name string, date_val string, ok int, last_try timestamp_ntz")
    assert rows(upsert.merge_log(old, new)) == [("a", "1", 1, 2, datetime(2024, 2, 2)), ("b", "1", 2, 0, NOW)]
    with pytest.raises(Exception, match="no such state: 99"):
        upsert.merge_log(old, new.withColumn("ok", F.lit(99))).collect()


def test_repeated_results_count_once(spark):
    old = log(spark, ("a", "1", 0, 2))
    later = datetime(2024, 2, 2)
    new = spark.createDataFrame([("a", "1", 1, NOW), ("a", "1", 2, later), ("a", "1", 0, later), ("b", "1", 1, NOW), ("b", "1", 1, NOW)], "table_name string, date_val string, ok int, last_try timestamp_ntz")
    assert rows(upsert.merge_log(old, new)) == [("a", "1", 2, 2, later), ("b", "1", 1, 0, NOW)]


def test_retry_until_abandoned(spark):
    old = log(spark, ("a", "1", 0, 4), ("a", "2", 0, 5), ("x", "1", 0, 0), ("a", "3", 2, 0))
    out = {(r["table_name"], r["date_val"]): (r["ok"], r["retry_count"], r["again"]) for r in upsert.retry(old, spark.createDataFrame([("a",)], "table_name string"), F.lit(NOW)).collect()}
    assert out == {("a", "1"): (0, 5, True), ("a", "2"): (3, 5, False), ("x", "1"): (0, 0, False), ("a", "3"): (2, 0, False)}


def test_stale_empties_are_due_again(spark):
    old = log(spark, ("a", "1", 2, 0), ("a", "2", 1, 0))
    assert upsert.stale_empties(old, F.lit(datetime(2024, 2, 8)).cast("timestamp_ntz")).count() == 0
    assert [r["date_val"] for r in upsert.stale_empties(old, F.lit(datetime(2024, 2, 9)).cast("timestamp_ntz")).collect()] == ["1"]


def test_new_domain_values_are_pending(spark):
    codes = spark.createDataFrame([("000001.SZ",), ("000002.SZ",), ("000003.SZ",), ("",), (None,)], "code string")
    days = spark.sql("SELECT DATE '2024-01-01' AS d")
    expected = worklist.expected_by_domain(codes, worklist.periods(days, "once"), F.lit("dividend"))
    done = log(spark, ("dividend", "000001.SZ__once__", 1, 0))
    assert sorted(r["code"] for r in worklist.pending_domain(expected, done).collect()) == ["000002.SZ", "000003.SZ"]


def test_empty_in_latest_period_is_asked_again(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-03-31')) AS d")
    expected = worklist.expected_by_domain(spark.createDataFrame([("X",)], "code string"), worklist.periods(days, "monthly"), F.lit("w"))
    done = log(spark, ("w", "X_202401", 2, 0), ("w", "X_202402", 0, 0), ("w", "X_202403", 2, 0))
    assert sorted(r["period"] for r in worklist.pending_domain(expected, done).collect()) == ["202402", "202403"]


def test_write_partitions_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    upsert.write_partitions(spark.createDataFrame([(9, "a")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path)) == [(2, "b"), (9, "a")]


def test_snapshot_replace(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    upsert.replace_snapshot(spark.range(3), path)
    upsert.replace_snapshot(spark.read.parquet(path).where("id > 0"), path)  # reads what it replaces
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    with pytest.raises(Exception, match="broken"):
        upsert.replace_snapshot(spark.range(2).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    upsert.replace_snapshot(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0 and not [p for p in tmp_path.iterdir() if "_old-" in p.name]
