"""The vector queries that use all instruments and lines, against brute force in Python."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow.parquet as pq
import pytest

from tapeline.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def slots():
    day = lambda x: x.date() if hasattr(x, "date") else x
    li = [r | {"d": day(r["l_shipdate"])} for r in pq.read_table(f"{SF}/lineitem.parquet").to_pylist()]
    cal = sorted({d for d in [r["d"] for r in li] + [day(x) for x in pq.read_table(f"{SF}/orders.parquet")["o_orderdate"].to_pylist()] if d.weekday() < 5})
    out = {}
    for r in li:
        i = bisect_left(cal, r["d"])
        if r["d"] >= cal[0] and i < len(cal):
            q, p = out.get((r["l_suppkey"], i), (float("-inf"), None))
            x = r["l_extendedprice"] if r["l_quantity"] > 25 else None
            out[r["l_suppkey"], i] = (max(q, r["l_quantity"]), x if p is None else p if x is None else max(p, x))
    return out


def test_all_are_aligned_and_trimmed(spark, slots):
    days = {}
    for inst, i in slots:
        days.setdefault(inst, []).append(i)
    want = {(k, i): slots.get((k, i), (None, None)) for k, v in days.items() for i in range(min(v), max(v) + 1)}
    assert {(r["inst"], r["cal_idx"]): (r["q"], r["p"]) for r in QUERIES["dense_align_all"](spark, SF).collect()} == want
    bounds = {(r["inst"], r["field"]): (r["first_idx"], r["last_idx"]) for r in QUERIES["trim_bounds_all"](spark, SF).collect()}
    assert {k: bounds[k, "q"] for k in days} == {k: (min(v), max(v)) for k, v in days.items()}


@pytest.mark.parametrize("name", ["daybin_roundtrip_all", "daybin_append_all"])
def test_all_are_written_and_read(spark, slots, name):
    got = {(int(r["instrument"]), r["cal_idx"]) for r in QUERIES[name](spark, SF).where("field = 'q' AND value IS NOT NULL AND NOT isnan(value)").collect()}
    assert got == set(slots)
