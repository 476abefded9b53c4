from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tapeline.catalog import EXPORTS, ExportSpec, derive_fields
from tapeline.operators import features, incremental, instruments, quality
from tapeline.plans import QUERIES

TRADE = "ts_code string, trade_date date, price double, vol double, amount double"


def day(s):
    return date.fromisoformat(s)


def days(spark, *ds):
    return spark.createDataFrame([(day(d),) for d in ds], "d date")


def test_weighted_mean_and_sums(spark):
    df = spark.createDataFrame([
        ("A", day("2024-01-02"), 10.0, 1.0, None), ("A", day("2024-01-02"), 20.0, -3.0, None), ("A", day("2024-01-02"), None, None, None),
        ("B", day("2024-01-02"), 5.0, 0.0, 2.0), ("B", day("2024-01-02"), 6.0, None, 1.0),
    ], TRADE)
    out = features.sum_count(df, ["ts_code"], {"amount": "amount"}, {"price": ("price", "vol")}, "n")
    assert {r["ts_code"]: (r["amount"], r["price"], r["n"]) for r in out.collect()} == {"A": (0.0, 17.5, 3), "B": (3.0, None, 2)}


def test_types(spark):
    df = spark.createDataFrame([("A", "HK_SH"), ("A", "2"), ("B", "1"), ("C", "other"), ("C", None)], "k string, type string")
    assert {r["k"]: tuple(r)[1:] for r in features.split_by_type(df, ["k"], "type").collect()} == {"A": (1, 1, 2), "B": (1, 0, 1), "C": (0, 0, 2)}


def test_later_null_keeps_earlier_value(spark):
    df = spark.createDataFrame([("A", 3, day("2024-01-06"), 1.0, 5.0), ("A", 3, day("2024-01-07"), 2.0, None)], "k string, cal_idx int, date date, a double, b double")
    want = [("A", 3, 2.0, 5.0)]
    assert [tuple(r) for r in features.last_in_slot(df, ["k", "cal_idx"], ["a", "b"], ["date"]).collect()] == want
    wide = [f"w{i}" for i in range(features.WIDE)]
    out = features.last_in_slot(df.select("*", *[F.col("b").alias(w) for w in wide]), ["k", "cal_idx"], wide, ["date"]).first()
    assert [out[w] for w in wide] == [5.0] * features.WIDE
    by_two = features.last_in_slot(df.select("*", *[F.col("b").alias(w) for w in wide]), ["k", "cal_idx"], wide, ["date", "a"]).first()
    assert [by_two[w] for w in wide] == [5.0] * features.WIDE


def test_many_fields_are_aggregated_before_the_shuffle(spark):
    names = [f"f{i}" for i in range(70)]
    df = spark.range(400).selectExpr("concat('k', id % 3) AS k", "CAST(id % 7 AS int) AS cal_idx", "id AS place", *[f"CASE WHEN (id + {i}) % 5 <> 0 THEN id * {i}.0D END AS {f}" for i, f in enumerate(names)])
    out = features.last_in_slot(df, ["k", "cal_idx"], names, ["place"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2 * -(-len(names) // features.GROUP) and "Window" not in plan
    whole = features.last_in_slot(df, ["k", "cal_idx"], names, ["place", "f1"])
    key = lambda d: sorted(tuple(r[c] is not None and r[c] for c in ["k", "cal_idx", *names]) for r in d.collect())
    assert key(out) == key(whole)


def test_build_moves_weekends_forward_and_prices(spark):
    spec = EXPORTS["idx_factor_pro"]
    df = spark.createDataFrame([("000001.SZ", day("2024-01-05"), 9.0, 10.0, 100.0), ("000001.SZ", day("2024-01-06"), 8.0, 0.0, 50.0), ("000001.SZ", day("2030-01-01"), 1.0, 1.0, 1.0)], TRADE)
    fields = derive_fields(spec, df.schema)
    assert [f.name for f in fields] == ["amount", "volume", "idx_price", "vwap"]
    out = features.build(df, spec, fields, days(spark, "2024-01-04", "2024-01-05", "2024-01-08"))
    assert sorted(tuple(r) for r in out.select("instrument", "cal_idx", "volume", "vwap").collect()) == [("SZ000001", 1, 10.0, 100.0), ("SZ000001", 2, 0.0, None)]


def test_only_vwap_still_reads_its_inputs(spark):
    spec = EXPORTS["idx_factor_pro"]
    df = spark.createDataFrame([("A.SZ", day("2024-01-05"), 9.0, 10.0, 100.0)], TRADE)
    fields = [f for f in derive_fields(spec, df.schema) if f.name == "vwap"]
    assert [r["vwap"] for r in features.build(df, spec, fields, days(spark, "2024-01-05")).collect()] == [100.0]


def test_three_letter_exchange_keeps_its_rows(spark):
    spec = ExportSpec("t", "index", prefix="x")
    df = spark.createDataFrame([("000985.CSI", day("2024-01-05"), 1.0, 1.0, 1.0)], TRADE)
    out = features.build(df, spec, derive_fields(spec, df.schema), days(spark, "2024-01-05")).first()
    assert (out["instrument"], out["code"]) == ("CSI000985", "000985.CSI")


def test_encoded_and_counted(spark):
    st = spark.createDataFrame([("A.SZ", day("2024-01-05"), "*st"), ("B.SZ", day("2024-01-05"), None)], "ts_code string, trade_date date, type string")
    spec = EXPORTS["stock_st"]
    out = features.build(st, spec, derive_fields(spec, st.schema), days(spark, "2024-01-05"))
    assert sorted(tuple(r) for r in out.select("code", "st_is_st").collect()) == [("A.SZ", 1.0), ("B.SZ", 0.0)]
    hot = spark.createDataFrame([("A.SZ", day("2024-01-05"), None), ("A.SZ", day("2024-01-05"), 7)], "ts_code string, trade_date date, hot_num bigint")
    spec = EXPORTS["kpl_concept_cons"]
    out = features.build(hot, spec, derive_fields(spec, hot.schema), days(spark, "2024-01-05")).first()
    assert (out["kcc_concept_cnt"], out["kcc_hot_num_total"]) == (2.0, 7.0)


def test_adjusted_names(spark):
    df = spark.createDataFrame([], "ts_code string, trade_date date, open double, open_hfq double, pe double, ma_hfq_5 double, ma_bfq_5 double, vol double, amount double, adj_factor double")
    names = [f.name for f in derive_fields(EXPORTS["stk_factor_pro"], df.schema)]
    assert names == ["open", "volume", "amount", "factor", "pe", "ma_5", "vwap"]
    assert "idx_ma_bfq_5" in [f.name for f in derive_fields(EXPORTS["idx_factor_pro"], df.schema)]


def test_gap_of_40_joins_and_41_splits(spark):
    df = spark.createDataFrame([("I", "A", day("2024-01-01")), ("I", "A", day("2024-02-10")), ("I", "A", day("2024-03-22")), ("I", "B", day("2024-01-01"))], "index_code string, con_code string, date date")
    out = sorted(tuple(r) for r in instruments.constituents(df).collect())
    assert out == [("I", "A", day("2024-01-01"), day("2024-02-10")), ("I", "A", day("2024-03-22"), day("2099-12-31")), ("I", "B", day("2024-01-01"), day("2024-01-01"))]


def test_prefix_and_tail_equal_the_whole(spark):
    spec = ExportSpec("t", "stock", prefix="x")
    rows = [(f"{c}.SZ", day(f"2024-01-{d:02}"), float(d), float(d * 2), 1.0) for c in "AB" for d in range(1, 20)]
    df = spark.createDataFrame(rows, TRADE)
    cal = days(spark, *[f"2024-01-{d:02}" for d in range(1, 25) if d % 3])
    fields = derive_fields(spec, df.schema)
    whole = features.build(df, spec, fields, cal)
    mark = day("2024-01-11")  # an open day, so no later row falls on a slot that is written
    state = spark.createDataFrame([("A.SZ", "t", mark, day("2024-01-01"), ["x"], 11, "done"), ("B.SZ", "t", mark, day("2024-01-01"), ["x"], 11, "done")],
                                  "instrument string, source_table string, last_date date, first_date date, fields array<string>, row_count bigint, status string")
    src = df.withColumns({"instrument": F.col("ts_code"), "source_table": F.lit("t"), "date": F.col("trade_date")})
    first = features.build(df.where(F.col("trade_date") <= mark), spec, fields, cal)
    tail = features.build(incremental.tail_rows(src, state), spec, fields, cal)
    assert sorted(map(tuple, first.unionByName(tail).collect())) == sorted(map(tuple, whole.collect()))


def test_decisions(spark):
    st = "instrument string, source_table string, last_date date, first_date date, fields array<string>, row_count bigint, status string"
    f, m = day("2024-01-02"), day("2024-01-03")
    state = spark.createDataFrame([
        ("none", "t", m, f, ["a"], 2, "done"), ("tail", "t", day("2024-01-02"), f, ["a"], 1, "done"), ("early", "t", m, m, ["a"], 2, "done"), ("grown", "t", m, f, ["a"], 1, "done"),
        ("field", "t", m, f, [], 2, "done"), ("mark", "t", None, f, ["a"], 2, "done"), ("bad", "t", m, f, ["a"], 2, "error"),
    ], st)
    names = ["none", "tail", "early", "grown", "field", "mark", "bad", "new"]
    src = spark.createDataFrame([(n, "t", d) for n in names for d in (f, m)], "instrument string, source_table string, date date")
    got = {r["instrument"]: r["action"] for r in incremental.decide(src, state, src, ["a"]).collect()}
    assert got == {"none": "none", "tail": "tail", "early": "rebuild", "grown": "rebuild", "field": "backfill", "mark": "rebuild", "bad": "new", "new": "new"}


def test_tiers_and_gap_issue(spark):
    cal = spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2020-01-01' + INTERVAL 999 DAYS)) AS d")
    cut = lambda name, n: cal.where(F.col("d") >= F.date_add(F.lit("2020-01-01").cast("date"), n)).select(F.lit(name).alias("table_name"), "d")
    cover = quality.dated_coverage(cut("perfect", 1).unionByName(cut("small", 50)).unionByName(cut("100", 100)).unionByName(cut("101", 101)), cal)
    assert {r["table_name"]: r["tier"] for r in cover.collect()} == {"perfect": "perfect", "small": "small_gap", "100": "big_gap", "101": "big_gap"}
    log = spark.createDataFrame([], "table_name string, ok int")
    assert [tuple(r) for r in quality.issues(log, cover).collect()] == [("101", "gap", 101)]


def test_densify_takes_one_shuffle(spark):
    slots = spark.createDataFrame([("A", 3, 1.0, None), ("A", 6, None, 2.0), ("A", 7, 3.0, 3.0), ("B", 5, 4.0, 4.0)], "k string, cal_idx int, x double, y double")
    out = features.densify(slots, ["k"], ["x", "y"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, out.collect())) == [("A", 3, 1.0, None), ("A", 4, None, None), ("A", 5, None, None), ("A", 6, None, 2.0), ("A", 7, 3.0, 3.0), ("B", 5, 4.0, 4.0)]


def test_bitmaps_agree_with_distinct_days_and_take_one_shuffle(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2020-12-31')) AS d").where("weekday(d) < 5")
    rows = spark.sql("SELECT concat('t', t) AS table_name, d, concat('c', c) AS code, date_format(d, 'yyyyMM') AS period FROM range(3) a(t), range(4) b(c) LATERAL VIEW explode(sequence(DATE '2020-01-03', DATE '2020-12-20')) e AS d WHERE hash(t, c, d) % 5 < t")
    rows = rows.unionByName(spark.sql("SELECT 'none' AS table_name, DATE '2020-01-04' AS d, CAST(NULL AS string) AS code, '202001' AS period UNION ALL SELECT 'none', NULL, 'c1', NULL"))
    marks = quality.bitmaps(rows, days)
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    one, two = quality.bitmaps(rows.where("code <= 'c1'"), days), quality.bitmaps(rows.where("code > 'c1' OR code IS NULL"), days)
    assert key(marks) == key(quality.unite(one.unionByName(two)))
    has = F.col("table_name") != "none"  # a table without a bit has no bitmap
    assert key(quality.covered(marks, days)) == key(quality.dated_coverage(rows.where(has), days))
    assert key(quality.uncovered(marks, days)) == key(quality.missing_days(rows.where(has), days))
    assert key(quality.months_per_code(marks)) == key(quality.periods_per_code(rows.where(has)))
    assert marks._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(table_name") == 1


def test_sketches_are_within_their_error(spark):
    rows = spark.range(40_000).selectExpr("concat('c', id % 9000) AS code", "id % 5 AS part", "id % 9000 AS number")
    sketches = quality.distinct_sketches(rows, ["part"], "code").withColumn("of", F.lit("all"))
    n = quality.sketched_counts(sketches, ["of"]).first()["n"]
    assert abs(n - 9000) < 4 * 0.0163 * 9000
    assert quality.distinct_counts(quality.distinct_marks(rows, ["part"], "number").withColumn("of", F.lit("all")), ["of"]).first()["n"] == 9000


def test_wide_fields_are_computed_after_the_shuffle(spark):
    rows = spark.createDataFrame([(i, d, q, (7 * i + q) % 4) for i in range(3) for d in range(4) for q in (1, 2, 3, 6)], "k int, d int, q int, o int")
    made = {f"f{n}": F.when(F.col("q") % n != 0, F.col("q") * n) for n in range(2, 2 + features.WIDE)}
    got = features.last_in_slot(rows, ["k"], made, ["d", "o", "q"])
    want = {}
    for k, d, q, o in sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1], r[3], r[2])):
        want.setdefault(k, dict.fromkeys(made)).update({f"f{n}": q * n for n in range(2, 2 + features.WIDE) if q % n})
    assert {r["k"]: {f: r[f] for f in made} for r in got.collect()} == want
    few = dict(list(made.items())[:3])
    assert {r["k"]: {f: r[f] for f in few} for r in features.last_in_slot(rows, ["k"], few, ["d", "o", "q"]).collect()} == {k: {f: v[f] for f in few} for k, v in want.items()}
    plan = QUERIES["slot_last_wide"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and plan.index("Project") < plan.index("RepartitionByExpression")
    dealt = plan[plan.index("RepartitionByExpression") :]
    assert "f64" not in dealt and "decimal" not in dealt  # one number a row is dealt, not sixty-four and their places


def test_priced_bars_are_dealt_once(spark):
    plan = QUERIES["priced_build"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line and "l_extendedprice" not in line]
    assert sum("ts_code" in line and "REPARTITION_BY_NUM" in line for line in dealt) == 1
    assert not [line for line in dealt if "cal_idx" in line or "trade_date" in line]  # neither days nor slots are dealt again
