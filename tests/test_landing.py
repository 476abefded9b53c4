from __future__ import annotations

import json

from pyspark.sql import functions as F

from tapeline.functions import codes
from tapeline.sources import landing


def payload(code=0, fields=("ts_code", "val"), items=(("A", "1.5"),), **more):
    return json.dumps({"code": code, "msg": "m", "data": {"fields": list(fields), "items": [list(i) for i in items]}} | more)


def test_reasons(spark):
    cases = {
        payload(): None, payload(items=()): None, payload(code=-1): "code -1", payload(code=40203): "code 40203", payload(items=(("A", "1", "2"),)): "item length",
        json.dumps({"msg": "no code"}): "malformed", json.dumps({"code": 0, "data": None}): "no data", "": "malformed",
        payload(fields=("a", "a"), items=(("1", "2"),)): "field names", payload(fields=("a", None), items=(("1", "2"),)): "field names", '{"code":0,"data":{"fields":["a"],"items":[null]}}': "item length",
    }
    df = spark.createDataFrame([(p,) for p in cases], "payload string")
    assert {r["payload"]: r["reject"] for r in landing.parse_payloads(df).collect()} == cases


def test_rows_with_types(spark):
    df = spark.createDataFrame([(payload(items=(("A", "1.5"), ("B", "x"), ("C", None))),)], "payload string")
    out = landing.payload_rows(landing.parse_payloads(df), {"ts_code": "string", "val": "double", "absent": "int"})
    assert [tuple(r) for r in out.orderBy("row_no").collect()] == [(0, "A", 1.5, None), (1, "B", None, None), (2, "C", None, None)]


def test_one_bad_payload_doesnt_stop_the_rest_and_each_is_parsed_once(spark):
    df = spark.createDataFrame([(payload(fields=("ts_code", "ts_code"), items=(("A", "B"),)),), (payload(),)], "payload string")
    out = landing.payload_rows(landing.parse_payloads(df), {"ts_code": "string", "val": "double"})
    assert [tuple(r) for r in out.collect()] == [(0, "A", 1.5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def kept(spark, pages):
    df = spark.createDataFrame([("q", *p) for p in pages], "q string, page_no int, n_rows int, first string, status string")
    out = landing.stitch_pages(df, ["q"], 2, F.col("first"))
    return sorted((r["page_no"], r["failed"]) for r in out.collect())


def test_pages(spark):
    assert kept(spark, [(0, 2, "a", "ok"), (1, 2, "b", "ok"), (2, 1, "c", "ok"), (3, 2, "d", "ok")]) == [(0, False), (1, False), (2, False)]
    assert kept(spark, [(0, 2, "a", "ok"), (1, 2, "a", "ok")]) == [(0, False)]
    assert kept(spark, [(0, 2, "a", "ok"), (1, 0, None, "error")]) == [(0, False)]
    assert kept(spark, [(0, 0, None, "error")]) == [(0, True)]


def test_fingerprint_depends_on_values(spark):
    a, b = spark.createDataFrame([("x", 1), ("x", 2)], "api string, n int").select(codes.batch_id(F.struct("api", "n")).alias("id")).collect()
    assert a["id"] != b["id"] and len(a["id"]) == 16 and a["id"] == a["id"].upper()
