from __future__ import annotations

import json
import os

import pytest

from tapeline.catalog import TABLES, TableSpec
from tapeline.operators import upsert
from tapeline.streaming.ingest import ingest, merge_batch

COLUMNS = {"ts_code": "string", "trade_date": "date", "val": "double"}


def land(path, name, *items, code=0, at=0):
    path.mkdir(exist_ok=True)
    f = path / name
    f.write_text(json.dumps({"code": code, "msg": "", "data": {"fields": ["ts_code", "trade_date", "val"], "items": list(items)}}) + "\n")
    os.utime(f, (1_700_000_000 + at, 1_700_000_000 + at))


def run(spark, tmp_path, spec):
    at = {k: str(tmp_path / k) for k in ("landed", "table", "rejects", "checkpoint")}
    ingest(spark, at["landed"], at["table"], at["rejects"], spec, COLUMNS, at["checkpoint"]).awaitTermination()
    out = spark.read.parquet(at["table"]).select("ts_code", "trade_date", "val").collect()
    return sorted((r["ts_code"], str(r["trade_date"]), r["val"]) for r in out)


def test_keyed_table_over_two_runs(spark, tmp_path):
    spec = TableSpec("bars", ("ts_code", "trade_date"), "trade_date", "trade_date")
    land(tmp_path / "landed", "a.json", ["A", "20240102", "1.0"], ["A", "20240202", "2.0"], [None, "20240102", "9"])
    land(tmp_path / "landed", "bad.json", code=-1)
    assert run(spark, tmp_path, spec) == [("A", "2024-01-02", 1.0), ("A", "2024-02-02", 2.0)]
    land(tmp_path / "landed", "b.json", ["A", "20240102", "99"], ["B", "20240103", "x"], at=10)
    want = [("A", "2024-01-02", 99.0), ("A", "2024-02-02", 2.0), ("B", "2024-01-03", None)]
    assert run(spark, tmp_path, spec) == want
    assert run(spark, tmp_path, spec) == want  # nothing new
    assert [r["reject"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["code -1"]


def test_event_table_replaces_days_and_codes(spark, tmp_path):
    day = TABLES["block_trade"]
    land(tmp_path / "landed", "a.json", ["A", "20240102", "1"], ["A", "20240102", "1"], ["A", "20240103", "2"])
    assert len(run(spark, tmp_path, day)) == 3
    land(tmp_path / "landed", "b.json", ["B", "20240102", "7"], at=10)
    assert run(spark, tmp_path, day) == [("A", "2024-01-03", 2.0), ("B", "2024-01-02", 7.0)]


def test_code_replace_reaches_other_months(spark, tmp_path):
    spec = TableSpec("holders", (), "trade_date", "domain", replace_key="ts_code")
    land(tmp_path / "landed", "a.json", ["A", "20240102", "1"], ["B", "20240102", "2"])
    run(spark, tmp_path, spec)
    land(tmp_path / "landed", "b.json", ["A", "20240302", "3"], at=10)
    assert run(spark, tmp_path, spec) == [("A", "2024-03-02", 3.0), ("B", "2024-01-02", 2.0)]


def test_rows_without_a_whole_key_are_kept_once(spark, tmp_path):
    spec = TableSpec("dividend", ("ts_code", "trade_date"), "trade_date", "domain", keep_null_key=True)
    land(tmp_path / "landed", "a.json", ["A", None, "1"], ["A", None, "2"], ["A", "20240102", "3"])
    want = [("A", "2024-01-02", 3.0), ("A", "None", 1.0), ("A", "None", 2.0)]
    assert run(spark, tmp_path, spec) == want
    land(tmp_path / "landed", "b.json", ["A", None, "2"], ["A", None, "1"], at=10)
    assert run(spark, tmp_path, spec) == want


def test_a_broken_payload_doesnt_end_the_stream(spark, tmp_path):
    spec = TableSpec("bars", ("ts_code", "trade_date"), "trade_date", "trade_date")
    land(tmp_path / "landed", "a.json", ["A", "20240102", "1.0"])
    (tmp_path / "landed" / "b.json").write_text(json.dumps({"code": 0, "data": {"fields": ["val", "val"], "items": [["1", "2"]]}}) + "\n")
    assert run(spark, tmp_path, spec) == [("A", "2024-01-02", 1.0)]
    assert [r["reject"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["field names"]


def test_a_key_without_a_date_moves_between_months(spark, tmp_path):
    spec = TableSpec("basic", ("ts_code",), "trade_date", "domain")
    land(tmp_path / "landed", "a.json", ["A", "20240102", "1"], ["B", "20240102", "2"], ["C", "20240202", "3"])
    run(spark, tmp_path, spec)
    land(tmp_path / "landed", "b.json", ["A", "20240203", "4"], ["B", "20240203", "5"], at=10)
    assert run(spark, tmp_path, spec) == [("A", "2024-02-03", 4.0), ("B", "2024-02-03", 5.0), ("C", "2024-02-02", 3.0)]
    assert not (tmp_path / "table" / "month=202401").exists()
    land(tmp_path / "landed", "c.json", ["C", None, "6"], ["A", "20240102", "7"], at=20)
    assert run(spark, tmp_path, spec) == [("A", "2024-01-02", 7.0), ("B", "2024-02-03", 5.0), ("C", "None", 6.0)]


def test_a_batch_that_failed_midway_is_merged_again(spark, tmp_path, monkeypatch):
    spec, path = TableSpec("basic", ("k",), "d", "domain"), str(tmp_path / "t")
    rows = lambda *xs: spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}', DATE '{d}', {v}, {v})" for k, d, v in xs) + " t(k, d, v, seq)")
    merge = lambda batch: merge_batch(batch, spec, path, "k string, d date, v int")
    merge(rows(("A", "2024-01-01", 1), ("B", "2024-01-01", 1)))
    batch = rows(("A", "2024-02-01", 2), ("B", "2024-02-01", 2))
    for step in (1, 2, 3, 4):  # the table, emptied months, the keys, emptied months of the keys
        left = [step]

        def fails(real, left=left):
            def call(*args):
                left[0] -= 1
                if not left[0]:
                    raise OSError("disk full")
                return real(*args)

            return call

        for name in ("write_partitions", "drop_partitions"):
            monkeypatch.setattr(upsert, name, fails(getattr(upsert, name)))
        with pytest.raises(OSError, match="disk full"):
            merge(batch)
        monkeypatch.undo()
        merge(batch)
        assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("A", 2), ("B", 2)]
        batch = rows(*((k, f"2024-0{3 + step}-01", 2) for k in "AB"))


def test_months_that_are_not_stored_are_written_once(spark, tmp_path, monkeypatch):
    from tapeline.catalog import TABLES
    from tapeline.sources import paths
    from tapeline.streaming import ingest as own

    staged, stage = {}, paths.stage
    monkeypatch.setattr(paths, "stage", lambda df, name: (out := stage(df, name), staged.setdefault(name, []).append(out.count()))[0])
    schema, path = "ts_code string, trade_date date, amount double", str(tmp_path / "table")
    batch = lambda first, last, amount: spark.sql(f"SELECT 'A' AS ts_code, d AS trade_date, {amount}D AS amount FROM (SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS d)")
    own.merge_batch(batch("2024-01-01", "2024-02-20", 1), TABLES["block_trade"], path, schema)
    own.merge_batch(batch("2024-02-15", "2024-05-31", 2), TABLES["block_trade"], path, schema)
    got = {(r["trade_date"].month, r["amount"]): r["n"] for r in spark.read.parquet(path).groupBy("trade_date", "amount").count().selectExpr("trade_date", "amount", "count AS n").collect()}
    assert got == {(1, 1.0): 1, (2, 1.0): 1, (2, 2.0): 1, (3, 2.0): 1, (4, 2.0): 1, (5, 2.0): 1}
    rows = spark.read.parquet(path).selectExpr("month(trade_date) AS m", "amount").groupBy("m", "amount").count()
    assert {(r["m"], r["amount"]): r["count"] for r in rows.collect()} == {(1, 1.0): 31, (2, 1.0): 14, (2, 2.0): 15, (3, 2.0): 31, (4, 2.0): 30, (5, 2.0): 31}
    assert staged["merged"] == [0, 29]  # February alone is merged
