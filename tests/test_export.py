"""Incremental exports: several source tables, failures, added fields, and the same vectors as from one build."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tapeline.catalog import ExportSpec, FieldDef
from tapeline.operators import export, incremental, rollup
from tapeline.sources import daybin

A = ExportSpec("a", "stock", naming="standard")
B = ExportSpec("b", "market", "day", None, virtual="_market_b")
ROWS = "ts_code string, trade_date string, x double, y double"


def tables(spark, upto, wide=True):
    rows = [(c, f"2024-01-{d:02d}", float(d), float(d * k)) for k, c in enumerate(["1.SZ", "2.SZ", "3.SH"], 1) for d in range(1, upto + 1) if (d + k) % 3]
    a = spark.createDataFrame(rows, ROWS).withColumn("trade_date", F.to_date("trade_date"))
    b = spark.createDataFrame([(f"2024-01-{d:02d}", d * 10.0) for d in range(1, upto + 1)], "day string, z double").withColumn("day", F.to_date("day"))
    fields = (FieldDef("x", "x"), FieldDef("y", "y")) if wide else (FieldDef("x", "x"),)
    return {"a": export.Export(a, A, fields), "b": export.Export(b, B, (FieldDef("z", "z"),))}


@pytest.fixture(scope="module")
def days(spark):
    return spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-31')) AS d").where("weekday(d) < 5")


def vectors(spark, path):
    return sorted((r["instrument"], r["field"], r["cal_idx"], r["value"]) for r in daybin.read(spark, path).where("value IS NOT NULL").collect())


def run(spark, exports, days, at):
    out = export.run(spark, exports, days, f"{at}/state", f"{at}/vectors", F.lit("2024-02-01"))
    return {(r["source_table"], r["instrument"]): r["action"] for r in out.collect()}


def test_in_steps_as_in_one(spark, days, tmp_path):
    whole, steps = tmp_path / "whole", tmp_path / "steps"
    run(spark, tables(spark, 30), days, whole)
    assert set(run(spark, tables(spark, 10, wide=False), days, steps).values()) == {"new"}
    assert run(spark, tables(spark, 19), days, steps) == {("a", i): "backfill" for i in ("SZ1", "SZ2", "SH3")} | {("b", "_market_b"): "tail"}
    assert set(run(spark, tables(spark, 30), days, steps).values()) == {"tail"}
    assert set(run(spark, tables(spark, 30), days, steps).values()) == {"none"}
    assert vectors(spark, f"{steps}/vectors") == vectors(spark, f"{whole}/vectors")
    state = {(r["source_table"], r["instrument"]): (str(r["last_date"]), r["row_count"], r["status"], r["fields"]) for r in export.read_state(spark, f"{steps}/state").collect()}
    assert len(state) == 4 and state["b", "_market_b"] == ("2024-01-30", 30, "done", ["z"]) and state["a", "SZ1"][3] == ["x", "y"]


def test_history_that_grew_is_built_anew(spark, days, tmp_path):
    run(spark, tables(spark, 20), days, tmp_path)
    more = tables(spark, 20)
    late = more["a"].table.where("ts_code = '1.SZ' AND trade_date = DATE '2024-01-04'").withColumn("x", F.lit(99.0))
    earlier = spark.createDataFrame([("2.SZ", "2023-12-29", 7.0, None)], ROWS).withColumn("trade_date", F.to_date("trade_date"))
    more["a"] = export.Export(more["a"].table.unionByName(late).unionByName(earlier), A, more["a"].fields)
    assert run(spark, more, days, tmp_path) == {("a", "SZ1"): "rebuild", ("a", "SZ2"): "rebuild", ("a", "SH3"): "none", ("b", "_market_b"): "none"}
    assert ("SZ1", "x", 3, 99.0) in vectors(spark, f"{tmp_path}/vectors")


def test_failed_runs_are_finished_by_the_next(spark, days, tmp_path, monkeypatch):
    real = daybin.write

    def fails(slots, fields, *a, **k):
        if "z" in fields:
            raise OSError("disk full")
        real(slots, fields, *a, **k)

    monkeypatch.setattr(daybin, "write", fails)
    with pytest.raises(OSError, match="disk full"):
        run(spark, tables(spark, 10), days, tmp_path)
    status = {(r["source_table"], r["instrument"]): r["status"] for r in export.read_state(spark, f"{tmp_path}/state").collect()}
    assert status["a", "SZ1"] == "done" and status["b", "_market_b"] == "partial"
    monkeypatch.undo()
    assert {k: v for k, v in run(spark, tables(spark, 10), days, tmp_path).items() if v != "none"} == {("b", "_market_b"): "new"}
    whole = tmp_path / "whole"
    run(spark, tables(spark, 10), days, whole)
    assert vectors(spark, f"{tmp_path}/vectors") == vectors(spark, f"{whole}/vectors")


def test_reset(spark, days, tmp_path):
    run(spark, tables(spark, 5), days, tmp_path)
    export.reset(spark, f"{tmp_path}/state", f"{tmp_path}/vectors")
    assert export.read_state(spark, f"{tmp_path}/state").count() == 0 and not (tmp_path / "vectors").exists()
    assert set(run(spark, tables(spark, 5), days, tmp_path).values()) == {"new"}


def test_state_of_one_table_says_nothing_of_another(spark):
    schema = "instrument string, source_table string, last_date date, first_date date, fields array<string>, row_count bigint, status string"
    state = spark.sql("SELECT 'I' AS instrument, t AS source_table, DATE '2024-01-03' AS last_date, DATE '2024-01-01' AS first_date, array('x') AS fields, 3L AS row_count, 'done' AS status FROM VALUES ('a'), ('b') v(t)").to(spark.createDataFrame([], schema).schema)
    source = spark.sql("SELECT 'I' AS instrument, t AS source_table, d AS date FROM VALUES ('a'), ('b') v(t) LATERAL VIEW explode(sequence(DATE '2024-01-01', DATE '2024-01-03')) e AS d")
    got = incremental.decide(source, state, source, ["x"]).collect()
    assert sorted((r["source_table"], r["action"]) for r in got) == [("a", "none"), ("b", "none")]
    more = source.unionByName(spark.sql("SELECT 'I' AS instrument, 'b' AS source_table, DATE '2024-01-04' AS date"))
    assert {r["source_table"]: r["action"] for r in incremental.decide(more, state, more, ["x"]).collect()} == {"a": "none", "b": "tail"}
    assert [r["source_table"] for r in incremental.tail_rows(more, state).collect()] == ["b"]
    assert {r["source_table"]: r["row_count"] for r in incremental.advance(state, incremental.tail_rows(more, state)).collect()} == {"a": 3, "b": 4}


def days_of(spark, *numbers):
    return spark.createDataFrame([(date(2024, 1, n),) for n in numbers], "d date")


PRICED = ExportSpec("p", "stock", naming="standard", computed=(("vwap", "vwap"),))


def bars(spark, rows):
    """Rows of one instrument by day of January 2024: amount and volume, either of which may be missing."""
    table = spark.createDataFrame([("1.SZ", date(2024, 1, d), a, v) for d, a, v in rows], "ts_code string, trade_date date, amount double, vol double")
    return {"p": export.Export(table, PRICED, (FieldDef("amount", "amount"), FieldDef("vol", "vol"), FieldDef("vwap", computed="vwap")))}


def test_late_rows_of_a_written_slot_complete_it(spark, tmp_path):
    """Fri 5, Sat 6, then Sun 7 and Mon 8: the slot of the 8th has what each day knew last, and its price."""
    cal = days_of(spark, 4, 5, 8, 9, 10)
    rows = [(5, 1.0, 2.0), (6, 6.0, 3.0), (7, None, 4.0), (8, 8.0, None), (9, 9.0, 9.0)]
    for upto, amount, vol in ((6, 6.0, 3.0), (7, 6.0, 4.0), (8, 8.0, 4.0), (9, 8.0, 4.0)):
        run(spark, bars(spark, [r for r in rows if r[0] <= upto]), cal, tmp_path)
        got = {(f, k): v for _, f, k, v in vectors(spark, f"{tmp_path}/vectors")}
        assert (got["amount", 2], got["vol", 2], got["vwap", 2]) == (amount, vol, pytest.approx(10 * amount / vol))
    run(spark, bars(spark, rows), cal, tmp_path / "whole")
    assert vectors(spark, f"{tmp_path}/vectors") == vectors(spark, f"{tmp_path}/whole/vectors")


def test_rows_beyond_the_calendar_wait_for_it(spark, tmp_path):
    rows = [(5, 1.0, 2.0), (6, 6.0, 3.0)]
    run(spark, bars(spark, rows), days_of(spark, 4, 5), tmp_path)
    assert run(spark, bars(spark, rows), days_of(spark, 4, 5, 8), tmp_path) == {("p", "SZ1"): "tail"}
    assert [(f, k, v) for _, f, k, v in vectors(spark, f"{tmp_path}/vectors") if f == "amount"] == [("amount", 0 + 1, 1.0), ("amount", 2, 6.0)]


@pytest.mark.parametrize(("old", "new"), [
    ((2, 3, 4, 5, 8, 9, 10), (1, 2, 3, 4, 5, 8, 9, 10)), ((2, 3, 4, 5, 8, 9, 10), (2, 4, 5, 8, 9, 10)), ((2, 3, 5, 8, 9, 10), (2, 3, 4, 5, 6, 8, 10)),
    ((2, 3, 4, 5, 8, 9), (3, 4, 5, 9, 10)), ((5, 8, 9), (2, 3, 5, 8, 9, 10)), ((2, 5, 9), (3, 8, 10)),
])
def test_changed_calendar_equals_one_build(spark, tmp_path, old, new):
    rows = [(d, None if d % 4 == 0 else float(d), None if d % 3 == 0 else d / 2) for d in range(1, 10)]
    run(spark, bars(spark, rows[:8]), days_of(spark, *old), tmp_path)
    run(spark, bars(spark, rows), days_of(spark, *new), tmp_path)
    run(spark, bars(spark, rows), days_of(spark, *new), tmp_path / "whole")
    assert vectors(spark, f"{tmp_path}/vectors") == vectors(spark, f"{tmp_path}/whole/vectors")


def test_a_changed_calendar_reads_changed_days_only(spark, tmp_path):
    rows = [(d, float(d), 1.0) for d in range(2, 12)]
    run(spark, bars(spark, rows), days_of(spark, 2, 3, 4, 5, 8, 9, 10, 11), tmp_path)
    other = [(d, 100.0 + d, 1.0) for d in range(2, 12)]  # the table says something else now, which only shows where it is read
    assert set(run(spark, bars(spark, other), days_of(spark, 2, 3, 4, 5, 6, 8, 9, 10, 11), tmp_path).values()) == {"none"}
    amounts = {k: v for _, f, k, v in vectors(spark, f"{tmp_path}/vectors") if f == "amount"}
    assert amounts == {0: 2.0, 1: 3.0, 2: 4.0, 3: 5.0, 4: 106.0, 5: 108.0, 6: 9.0, 7: 10.0, 8: 11.0}


def test_one_bad_instrument_is_an_error_and_the_rest_is_done(spark, days, tmp_path):
    exports = tables(spark, 10)
    bad = exports["a"].table.withColumn("x", F.when(F.col("ts_code") == "2.SZ", F.lit(1e300)).otherwise(F.col("x")))
    run(spark, {**exports, "a": export.Export(bad, A, exports["a"].fields)}, days, tmp_path)
    status = {r["instrument"]: r["status"] for r in export.read_state(spark, f"{tmp_path}/state").collect()}
    assert status == {"SZ1": "done", "SZ2": "error", "SH3": "done", "_market_b": "done"}
    assert {v[0] for v in vectors(spark, f"{tmp_path}/vectors")} == {"SZ1", "SH3", "_market_b"}
    assert {k for k, v in run(spark, exports, days, tmp_path).items() if v != "none"} == {("a", "SZ2")}
    run(spark, exports, days, tmp_path / "whole")
    assert vectors(spark, f"{tmp_path}/vectors") == vectors(spark, f"{tmp_path}/whole/vectors")


def test_field_is_rebuilt_in_all_tables(spark, days, tmp_path):
    exports = tables(spark, 10)
    wrong = exports["a"].table.withColumn("y", F.lit(-1.0))
    run(spark, {**exports, "a": export.Export(wrong, A, exports["a"].fields)}, days, tmp_path)
    got = export.rebuild_field(spark, exports, "y", days, f"{tmp_path}/state", f"{tmp_path}/vectors", F.lit("2024-02-01"))
    assert {r["action"] for r in got.collect()} == {"backfill"}
    run(spark, exports, days, tmp_path / "whole")
    assert vectors(spark, f"{tmp_path}/vectors") == vectors(spark, f"{tmp_path}/whole/vectors")
    with pytest.raises(ValueError, match="no table"):
        export.rebuild_field(spark, exports, "none", days, f"{tmp_path}/state", f"{tmp_path}/vectors", F.lit("2024-02-01"))


def test_monthly_counts_decide_as_the_rows_do(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(n) for n in range(70)]
    rows = spark.createDataFrame([(f"I{k}", "t", f"c{k}", d) for k in range(5) for n, d in enumerate(days) if (n * (k + 3)) % 7 < 4], "instrument string, source_table string, code string, date date")
    at = str(tmp_path / "counts")
    rollup.refresh(rows, ["202401", "202402", "202403"], at, "t")
    rollup.refresh(rows.where("date BETWEEN DATE '2024-02-01' AND DATE '2024-02-29' AND instrument <> 'I3'"), ["202402"], at, "t")
    left = rows.where("instrument <> 'I3' OR month(date) <> 2")
    state = spark.createDataFrame([(f"I{k}", "t", date(2024, 1 + k % 3, 10 + k)) for k in range(4)], "instrument string, source_table string, last_date date")
    for end in (None, date(2024, 2, 17), date(2023, 12, 31)):
        want = incremental.history(left.where(F.col("date") <= F.lit(end)) if end else left, state)
        key = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()))
        assert key(incremental.counted_history(rollup.read(spark, at), state, end)) == key(want)
    rollup.refresh(rows.where("false"), ["202403"], at, "t")
    assert {r["month"] for r in rollup.read(spark, at).collect()} == {"202401", "202402"}


def test_late_rows_are_read_from_late_partitions(spark, tmp_path):
    table = spark.sql("SELECT concat(i, '.SZ') AS ts_code, d AS trade_date, 1.0D AS x, date_format(d, 'yyyyMM') AS month FROM range(4) r(i) LATERAL VIEW explode(sequence(DATE '2024-01-01', DATE '2024-06-30')) e AS d")
    table.write.partitionBy("month").parquet(f"{tmp_path}/t")
    own = export.Export(spark.read.schema("ts_code string, trade_date date, x double, month string").parquet(f"{tmp_path}/t"), A, (FieldDef("x", "x"),), "month")
    marks = spark.createDataFrame([("1.SZ", date(2024, 5, 20)), ("2.SZ", date(2024, 6, 3))], "code string, last_date date")
    late = own.after(marks)
    assert late.count() == 11 + 30 + 27
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and ">= 202405)" in plan and "GreaterThanOrEqual(trade_date,2024-05-20)" in plan
    assert {f.split("month=")[1][:6] for f in (r[0] for r in late.select(F.input_file_name()).distinct().collect()) if "month=" in f} <= {"202405", "202406"}
