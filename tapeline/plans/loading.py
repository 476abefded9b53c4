"""Queries over landing, merging and the load log."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.catalog import ExportSpec, FieldDef, TableSpec
from tapeline.functions import codes, dates
from tapeline.operators import calendar, features, quality, upsert, worklist
from tapeline.plans.inputs import BARS, CODE_OF, CODES, DATES, LOG, NOW, bars, calendar_table, code, days, log, query, read, supplier_codes
from tapeline.sources import landing, paths
from tapeline.streaming.ingest import ingest, merge_batch


def now():
    """The instant that state queries take as now."""
    return F.lit(NOW).cast("timestamp_ntz")


# --- landing -------------------------------------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    i = F.col("event_id")
    item = F.array(i.cast("string"), F.when(i % 5 == 0, "n/a").otherwise(F.col("value").cast("string")), F.get_json_object("props", "$.k"))
    items = F.when(i % 11 == 0, F.array().cast("array<array<string>>")).when(i % 13 == 0, F.array(F.slice(item, 1, 2))).otherwise(F.array(item))
    data = F.struct(F.array(*map(F.lit, ("event_id", "value", "k"))).alias("fields"), items.alias("items"))
    body = F.to_json(F.struct(F.when(i % 7 == 0, -1).otherwise(0).alias("code"), F.lit("m").alias("msg"), data.alias("data")), {"ignoreNullFields": "false"})
    return e.select(F.when(i % 17 == 0, F.lit("not json")).otherwise(body).alias("payload"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
          FROM events WHERE event_id % 17 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0""")
def landed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = landing.parse_payloads(_payloads(spark, sf_dir))
    return landing.payload_rows(parsed, {"event_id": "bigint", "value": "double", "k": "bigint"}).drop("row_no")


@query("""SELECT CASE WHEN event_id % 17 = 0 THEN 'malformed' WHEN event_id % 7 = 0 THEN 'code -1' ELSE 'item length' END AS reject, count(*) AS n
          FROM events WHERE event_id % 17 = 0 OR event_id % 7 = 0 OR (event_id % 13 = 0 AND event_id % 11 <> 0) GROUP BY 1""")
def landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.parse_payloads(_payloads(spark, sf_dir)).where("reject IS NOT NULL").groupBy("reject").agg(F.count("*").alias("n"))


PAGED = """paged AS (SELECT event_id // 1000 AS rq, (event_id % 1000) // 100 AS page_no, event_id % 100 AS row_no,
           CASE WHEN event_id // 1000 % 3 = 0 AND (event_id % 1000) // 100 IN (0, 6) THEN -(event_id % 100) - 1 ELSE event_id END AS content
           FROM events WHERE NOT (event_id // 1000 % 3 = 1 AND (event_id % 1000) // 100 = 4 AND event_id % 100 >= 50))"""


@query(f"""WITH {PAGED} SELECT rq, CAST(count(DISTINCT page_no) AS BIGINT) AS n_pages, count(*) AS n_rows, CAST(sum(content) AS BIGINT) AS total FROM paged
           WHERE page_no < CASE rq % 3 WHEN 0 THEN 6 WHEN 1 THEN 5 ELSE 5 END GROUP BY rq""")
def page_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 1000).alias("rq"), F.floor(F.col("event_id") % 1000 / 100).alias("page_no"), (F.col("event_id") % 100).alias("row_no"), "event_id")
    rows = e.where("NOT (rq % 3 = 1 AND page_no = 4 AND row_no >= 50)").select("rq", "page_no", "row_no", F.expr("CASE WHEN rq % 3 = 0 AND page_no IN (0, 6) THEN -row_no - 1 ELSE event_id END").alias("content"))
    pages = rows.groupBy("rq", "page_no").agg(F.count("*").alias("n_rows"), F.min_by("content", "row_no").alias("first")).withColumn("status", F.expr("CASE WHEN rq % 3 = 2 AND page_no = 5 THEN 'error' ELSE 'ok' END"))
    kept = landing.stitch_pages(pages, ["rq"], 100, F.col("first"))
    return rows.join(kept.select("rq", "page_no"), ["rq", "page_no"], "left_semi").groupBy("rq").agg(F.countDistinct("page_no").alias("n_pages"), F.count("*").alias("n_rows"), F.sum("content").alias("total"))


@query(f"WITH {CODES} SELECT s_suppkey, code, CASE WHEN code LIKE '%.SH' THEN NULL ELSE s_acctbal END AS s_acctbal FROM codes")
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = supplier_codes(spark, sf_dir).select("s_suppkey", "code", "s_acctbal")
    parts = [s.where(F.col("code").endswith(x)) for x in ("SZ", "BJ", "CSI")] + [s.where(F.col("code").endswith("SH")).drop("s_acctbal")]
    return landing.union_shards(parts)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.known_columns(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "not_landed"])


@query("""SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_partkey END AS l_partkey, CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS l_quantity FROM lineitem
          WHERE l_orderkey % 10 <> 0 OR l_orderkey % 5 <> 0""")
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "lineitem").select(F.expr("CASE WHEN l_orderkey % 10 <> 0 THEN l_partkey END").alias("l_partkey"), F.expr("CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END").alias("l_quantity"))
    return upsert.drop_empty(b)


@query("""SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END AS l_orderkey, l_linenumber, l_quantity, k FROM lineitem, (VALUES ('kept'), ('dropped')) t(k)
          WHERE k = 'kept' OR l_orderkey % 10 <> 0""")
def drop_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "lineitem").select(F.expr("CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END").alias("l_orderkey"), "l_linenumber", "l_quantity")
    kept = upsert.drop_empty(b, ["l_orderkey", "l_linenumber"], keep_null_key=True).withColumn("k", F.lit("kept"))
    return kept.unionByName(upsert.drop_empty(b, ["l_orderkey", "l_linenumber"]).withColumn("k", F.lit("dropped")))


# --- merging -------------------------------------------------------------------------------------------------

WINNER = "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_shipdate DESC"


@query(f"""WITH ranked AS (SELECT *, l_partkey % 2 = 0 AS old, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey % 2 ORDER BY {WINNER}) AS rn FROM lineitem),
           one AS (SELECT * FROM ranked WHERE rn = 1)
           SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM one o
           WHERE NOT old OR NOT EXISTS (SELECT 1 FROM one n WHERE NOT n.old AND n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber)""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    order = [F.desc(c.split()[0]) for c in WINNER.split(", ")]
    old = upsert.latest(li.where("l_partkey % 2 = 0"), key, order)
    return upsert.upsert(old, li.where("l_partkey % 2 <> 0"), key, order).select(*key, "l_partkey", "l_quantity", "l_extendedprice")


@query(f"""WITH {BARS}, new AS (SELECT * FROM bars WHERE l_linenumber > 4 AND inst % 2 = 0)
           SELECT inst, d, l_orderkey, l_linenumber, l_extendedprice FROM new UNION ALL
           SELECT inst, d, l_orderkey, l_linenumber, l_extendedprice FROM bars b WHERE l_linenumber <= 4 AND NOT EXISTS (SELECT 1 FROM new n WHERE n.inst = b.inst AND n.d = b.d)""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir).select("inst", "d", "l_orderkey", "l_linenumber", "l_extendedprice")
    return upsert.replace_partitions(b.where("l_linenumber <= 4"), b.where("l_linenumber > 4 AND inst % 2 = 0"), ["inst", "d"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyless table: the second batch replaces the first on disk."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = paths.fresh_path(spark, "snapshot")
    for part in (o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1")):
        upsert.replace_snapshot(part, path)
    return spark.read.parquet(path)


@query("""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS y FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 1""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by year on disk, of which a batch of one year overwrites only that year."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("y"))
    path = paths.fresh_path(spark, "by_year")
    upsert.write_partitions(o, path, ["y"])
    upsert.write_partitions(o.where("y = '1997' AND o_orderkey % 2 = 1"), path, ["y"])
    return spark.read.schema("o_orderkey bigint, o_totalprice double, y string").parquet(path)


# --- scans and filters ---------------------------------------------------------------------------------------


@query(f"WITH {BARS} SELECT inst, d, l_extendedprice FROM bars WHERE d >= DATE '1998-01-01'")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("inst", "d", "l_extendedprice").where("d >= DATE '1998-01-01'")


@query(f"""WITH {BARS}, b(k, low) AS (VALUES ('default', DATE '1998-01-01'), ('none', DATE '0001-01-01'), ('given', DATE '2000-01-01'))
           SELECT k, count(*) AS n, min(d) AS first_d FROM bars, b WHERE d >= low GROUP BY k""")
def since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, default = bars(spark, sf_dir), F.lit("1998-01-01")
    parts = [features.since(b, "d", bound, default).agg(F.count("*").alias("n"), F.min("d").alias("first_d")).select(F.lit(k).alias("k"), "n", "first_d") for k, bound in (("default", None), ("none", ""), ("given", "2000-01-01"))]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT '_market_margin' AS code, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def spec_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    spec = ExportSpec("margin", "market", "d", "o_orderpriority", virtual="_market_margin", predicate="o_orderpriority = '1-URGENT'")
    return features.source_rows(o, spec, [FieldDef("p", "o_totalprice")])


@query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (1, 2, 3, 4, 5) AND s_suppkey % 10 IN (0, 1)")
def in_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").withColumn("m", F.col("s_suppkey") % 10)
    return codes.any_of(s, {"s_nationkey": [1, 2, 3, 4, 5], "m": [0, 1]}).select("s_suppkey", "s_nationkey")


@query(f"WITH {CODES} SELECT s_suppkey, code FROM codes WHERE regexp_matches(code, '\\.(SZ|SH|BJ)$')")
def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_codes(spark, sf_dir).where(codes.listed_suffix(F.lower("code")) & codes.present("code")).select("s_suppkey", "code")


# --- calendar ------------------------------------------------------------------------------------------------


@query(f"WITH {DATES} SELECT d FROM cal WHERE d >= DATE '1996-01-01' AND d <= DATE '2000-12-31'")
def open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.open_days(calendar_table(spark, sf_dir), "SSE", F.lit("1996-01-01").cast("date"), F.lit("2000-12-31").cast("date"))


@query(f"WITH {DATES} SELECT d, idx FROM cal")
def calendar_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.calendar_index(days(spark, sf_dir))


@query(f"WITH {DATES} SELECT d, lag(d) OVER (ORDER BY d) AS prev FROM cal")
def prev_open_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.previous_open(days(spark, sf_dir))


@query(f"""WITH {DATES}, {BARS} SELECT b.l_orderkey, b.l_linenumber, b.d, c.idx AS cal_idx FROM bars b ASOF JOIN cal c ON b.d <= c.d WHERE b.d >= (SELECT min(d) FROM cal)""")
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.to_slots(bars(spark, sf_dir).select("l_orderkey", "l_linenumber", "d"), "d", days(spark, sf_dir))


@query(f"""WITH {DATES}, fewer AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS idx FROM cal WHERE idx <> 100)
           SELECT CAST(cal.idx AS INTEGER) AS idx, cal.d AS old_d, f.d AS new_d FROM cal LEFT JOIN fewer f ON cal.idx = f.idx WHERE f.d IS NULL OR f.d <> cal.d""")
def calendar_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = days(spark, sf_dir)
    return calendar.changed_days(old, calendar.calendar_index(old).where("idx <> 100").select("d"))


# --- work list -----------------------------------------------------------------------------------------------


@query(f"""WITH {DATES} SELECT 'bars' AS table_name, strftime(d, '%Y%m%d') AS date_val, d AS start, d AS "end" FROM cal UNION ALL
           SELECT DISTINCT 'orders', strftime(d, '%Y'), make_date(year(d), 1, 1), make_date(year(d), 12, 31) FROM cal""")
def expected_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = days(spark, sf_dir)
    return worklist.expected_by_day(c, F.lit("bars")).unionByName(worklist.expected_by_year(c, F.lit("orders")))


@query(f"""WITH {DATES} SELECT 'bars' AS table_name, strftime(d, '%Y%m%d') || '_' || f AS date_val, d AS start, d AS "end" FROM cal, (VALUES ('W'), ('M')) t(f)""")
def day_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.expected_by_frequency(days(spark, sf_dir), F.lit("bars"))


@query(f"""WITH {DATES}, {CODES}, spans AS (SELECT DISTINCT strftime(d, '%Y%m') AS period, CAST(date_trunc('month', d) AS DATE) AS start, last_day(d) AS "end" FROM cal)
           SELECT 'weights' AS table_name, code || '_' || period AS date_val, code, period, start, "end" FROM codes, spans""")
def domain_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.expected_by_domain(supplier_codes(spark, sf_dir), worklist.periods(days(spark, sf_dir), "monthly"), F.lit("weights"))


@query("""SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS period, CAST(l_shipdate AS DATE) AS start, CAST(l_shipdate AS DATE) AS "end" FROM lineitem UNION ALL
          SELECT DISTINCT strftime(l_shipdate, '%Y'), make_date(year(l_shipdate), 1, 1), make_date(year(l_shipdate), 12, 31) FROM lineitem UNION ALL
          SELECT '__once__', NULL, NULL""")
def period_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bars(spark, sf_dir).select("d").distinct()
    return reduce(DataFrame.unionByName, [worklist.periods(d, m) for m in ("daily", "yearly", "once")])


EXPECTED_LOG = f"""{LOG}, expected AS (SELECT t.table_name, p.date_val FROM (SELECT DISTINCT table_name FROM log) t, (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS date_val FROM orders) p)"""


def _expected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("table_name"))
    months = worklist.periods(o.select("d"), "monthly")
    return o.select("table_name").distinct().crossJoin(F.broadcast(months)).select("table_name", F.col("period").alias("date_val"), "period")  # kinds of orders by months


@query(f"WITH {EXPECTED_LOG} SELECT table_name, date_val FROM expected e WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.table_name = e.table_name AND l.date_val = e.date_val AND ok IN (1, 2))")
def pending_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.pending(_expected_months(spark, sf_dir).drop("period"), log(spark, sf_dir))


@query(f"""WITH {EXPECTED_LOG}, latest AS (SELECT table_name, max(date_val) AS top FROM expected GROUP BY 1)
           SELECT e.table_name, e.date_val FROM expected e JOIN latest USING (table_name)
           WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.table_name = e.table_name AND l.date_val = e.date_val AND (ok = 1 OR (ok = 2 AND e.date_val <> top)))""")
def pending_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.pending_domain(_expected_months(spark, sf_dir), log(spark, sf_dir)).select("table_name", "date_val")


@query(f"""WITH {EXPECTED_LOG}, {DATES}, years AS (SELECT DISTINCT 'orders' AS table_name, strftime(d, '%Y') AS date_val FROM cal)
           SELECT e.table_name, 'domain' AS strategy, count(*) AS n_expected, count(*) FILTER (l.ok IS NULL OR l.ok NOT IN (1, 2)) AS n_pending FROM expected e LEFT JOIN log l USING (table_name, date_val) GROUP BY 1 UNION ALL
           SELECT table_name, 'date_range', count(*), count(*) FROM years GROUP BY 1""")
def plan_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.preview({"domain": _expected_months(spark, sf_dir), "date_range": worklist.expected_by_year(days(spark, sf_dir), F.lit("orders"))}, log(spark, sf_dir))


def _calendar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Open days, and all days; the calendar is derived once."""
    table = paths.stage(calendar_table(spark, sf_dir), "calendar")
    span = table.agg(F.min("cal_date").alias("a"), F.max("cal_date").alias("z"))
    return table.where("is_open = 1").select(F.col("cal_date").alias("d")), span.select(F.explode(dates.natural_days(F.col("a"), F.col("z"))).alias("d"))


#: Tables of each strategy; repurchases are dated by announcement, so they are asked for on every day.
ASKED = (TableSpec("bars", date_col="trade_date", strategy="trade_date"), TableSpec("repurchase", (), "ann_date", "trade_date"), TableSpec("orders", strategy="date_range"),
         TableSpec("weekly", strategy="freq"), TableSpec("weights", strategy="domain"), TableSpec("basic", strategy="once"))


ASKED_SQL = f"""{DATES}, {CODES}, span AS (SELECT min(d) AS a, max(d) AS z FROM dates), every AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
           months AS (SELECT DISTINCT strftime(d, '%Y%m') AS period, CAST(date_trunc('month', d) AS DATE) AS start, last_day(d) AS "end" FROM cal),
           expected AS (SELECT 'bars' AS table_name, 'trade_date' AS strategy, strftime(d, '%Y%m%d') AS date_val, d AS start, d AS "end", NULL AS period FROM cal
                        UNION ALL SELECT 'repurchase', 'trade_date', strftime(d, '%Y%m%d'), d, d, NULL FROM every
                        UNION ALL SELECT DISTINCT 'orders', 'date_range', strftime(d, '%Y'), make_date(year(d), 1, 1), make_date(year(d), 12, 31), NULL FROM cal
                        UNION ALL SELECT 'weekly', 'freq', strftime(d, '%Y%m%d') || '_' || f, d, d, NULL FROM cal, (VALUES ('W'), ('M')) t(f)
                        UNION ALL SELECT 'weights', 'domain', code || '_' || period, start, "end", period FROM codes, months UNION ALL SELECT 'basic', 'once', '__once__', NULL, NULL, NULL)"""


@query(f"""WITH {ASKED_SQL},
           log AS (SELECT table_name, date_val, row_number() OVER (PARTITION BY table_name ORDER BY date_val) % 4 AS ok FROM expected WHERE table_name NOT IN ('orders', 'basic'))
           SELECT table_name, strategy, date_val, start, "end" FROM expected e LEFT JOIN log l USING (table_name, date_val)
           WHERE l.ok IS NULL OR NOT (l.ok = 1 OR l.ok = 2 AND (strategy <> 'domain' OR period <> (SELECT max(period) FROM months)))""")
def catalogue_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to load of a table of each strategy, against a log that has part of them."""
    open_, every = _calendar(spark, sf_dir)
    listed = supplier_codes(spark, sf_dir)
    asked = [worklist.expected(s, open_, every, listed) for s in ASKED if s.name not in ("orders", "basic")]
    rank = F.row_number().over(Window.partitionBy("table_name").orderBy("date_val"))
    logged = reduce(DataFrame.unionByName, asked).select("table_name", "date_val", (rank % 4).alias("ok"))
    return worklist.work_list(ASKED, open_, every, logged, {"weights": listed})


KEYED = f"""{LOG}, keyed AS (SELECT table_name, last_try, CASE CAST(date_val AS INTEGER) % 5 WHEN 0 THEN 'trade_date' WHEN 1 THEN 'date_range' WHEN 2 THEN 'freq' WHEN 3 THEN 'domain' ELSE 'once' END AS strategy,
            CASE CAST(date_val AS INTEGER) % 5 WHEN 0 THEN strftime(last_try, '%Y%m%d') WHEN 1 THEN strftime(last_try, '%Y') WHEN 2 THEN strftime(last_try, '%Y%m%d') || '_W' WHEN 3 THEN table_name || '_' || date_val ELSE '__once__' END AS key FROM log)"""


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("date_val").cast("int") % 5
    d = F.to_date("last_try")
    strategy = F.when(m == 0, "trade_date").when(m == 1, "date_range").when(m == 2, "freq").when(m == 3, "domain").otherwise("once")
    key = (
        F.when(m == 0, dates.partition_key("trade_date", d)).when(m == 1, dates.partition_key("date_range", d)).when(m == 2, dates.partition_key("freq", d, freq=F.lit("W")))
        .when(m == 3, dates.partition_key("domain", code=F.col("table_name"), period=F.col("date_val"))).otherwise(dates.partition_key("once"))
    )
    return log(spark, sf_dir).select("table_name", "last_try", strategy.alias("strategy"), key.alias("key"))


@query(f"""WITH {KEYED} SELECT table_name, key,
           CASE strategy WHEN 'trade_date' THEN CAST(last_try AS DATE) WHEN 'date_range' THEN make_date(year(last_try), 1, 1) WHEN 'freq' THEN CAST(last_try AS DATE) END AS start,
           CASE strategy WHEN 'trade_date' THEN CAST(last_try AS DATE) WHEN 'date_range' THEN make_date(year(last_try), 12, 31) WHEN 'freq' THEN CAST(last_try AS DATE) WHEN 'domain' THEN DATE '{NOW}' END AS "end" FROM keyed""")
def partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = dates.partition_bounds(F.col("strategy"), F.col("key"), F.lit(NOW).cast("date"))
    return _keyed(spark, sf_dir).select("table_name", "key", start.alias("start"), end.alias("end"))


@query(f"""WITH {KEYED} SELECT table_name, strategy, CASE strategy WHEN 'date_range' THEN strftime(last_try, '%Y') WHEN 'once' THEN '__once__' ELSE strftime(last_try, '%Y%m%d') END AS refresh FROM keyed""")
def refresh_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("table_name", "strategy", dates.refresh_key(F.col("strategy"), F.to_date("last_try")).alias("refresh"))


@query("""SELECT event_id, CASE WHEN hour(ts + INTERVAL 8 HOUR) * 60 + minute(ts + INTERVAL 8 HOUR) >= 1230 THEN CAST(ts + INTERVAL 8 HOUR AS DATE)
          ELSE CAST(ts + INTERVAL 8 HOUR AS DATE) - 1 END AS until FROM events""")
def load_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", dates.load_cutoff("ts").alias("until"))


# --- log -----------------------------------------------------------------------------------------------------


@query(f"""WITH {LOG}, new AS (SELECT table_name, CASE WHEN ok = 0 THEN date_val ELSE date_val || 'x' END AS date_val, 1 AS ok, TIMESTAMP '{NOW}' AS last_try FROM log WHERE retry_count < 3)
           SELECT table_name, date_val, CAST(coalesce(n.ok, l.ok) AS INTEGER) AS ok, coalesce(retry_count, 0) AS retry_count, coalesce(n.last_try, l.last_try) AS last_try
           FROM log l FULL JOIN new n USING (table_name, date_val)""")
def log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = log(spark, sf_dir)
    new = old.where("retry_count < 3").select("table_name", F.expr("CASE WHEN ok = 0 THEN date_val ELSE concat(date_val, 'x') END").alias("date_val"), F.lit(1).alias("ok"), now().alias("last_try"))
    return upsert.merge_log(old, new)


@query(f"""WITH {LOG}, landed AS (SELECT o_orderpriority AS table_name, strftime(o_orderdate, '%Y%m') AS date_val, count(*) AS n FROM orders WHERE (year(o_orderdate) * 12 + month(o_orderdate)) % 5 <> 1 GROUP BY ALL)
           SELECT table_name, date_val, CAST(CASE WHEN retry_count = 0 THEN 0 WHEN n > 0 THEN 1 ELSE 2 END AS INTEGER) AS ok, TIMESTAMP '{NOW}' AS last_try FROM log LEFT JOIN landed USING (table_name, date_val)""")
def result_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed side has all orders but those of whole months, which are empty."""
    asked = log(spark, sf_dir)
    landed = read(spark, sf_dir, "orders").where((F.year("o_orderdate") * 12 + F.month("o_orderdate")) % 5 != 1).select(F.col("o_orderpriority").alias("table_name"), F.date_format("o_orderdate", "yyyyMM").alias("date_val"))
    return upsert.result_states(asked.select("table_name", "date_val"), landed, asked.where("retry_count = 0"), now())


@query(f"""WITH {LOG} SELECT table_name, date_val, CAST(CASE WHEN f AND retry_count >= 5 THEN 3 ELSE ok END AS INTEGER) AS ok, CAST(CASE WHEN f AND retry_count < 5 THEN retry_count + 1 ELSE retry_count END AS INTEGER) AS retry_count,
           CASE WHEN f AND retry_count < 5 THEN TIMESTAMP '{NOW}' ELSE last_try END AS last_try, f AND retry_count < 5 AS again FROM (SELECT *, ok = 0 AND table_name <> '5-LOW' AS f FROM log)""")
def retry_abandon(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = log(spark, sf_dir)
    return upsert.retry(l, l.where("table_name <> '5-LOW'"), now())


@query(f"""WITH {LOG} SELECT table_name, min(date_val) AS first_val, max(date_val) AS last_val, count(*) AS n FROM log WHERE ok = 2 AND last_try < TIMESTAMP '{NOW}' - INTERVAL 7 DAY GROUP BY 1""")
def stale_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.stale_ranges(upsert.stale_empties(log(spark, sf_dir), now()))


@query("""WITH last AS (SELECT o_orderpriority AS table_name, max(CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderpriority NOT LIKE '3%' GROUP BY 1),
          t AS (SELECT DISTINCT o_orderpriority AS table_name FROM orders)
          SELECT t.table_name, coalesce(d, DATE '1995-01-01') AS start FROM t LEFT JOIN last USING (table_name) WHERE d IS NULL OR d < DATE '2030-01-01'""")
def daily_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("table_name"), F.to_date("o_orderdate").alias("d"))
    return worklist.daily_start(o, o.where("table_name NOT LIKE '3%'"), F.lit("1995-01-01").cast("date"), F.lit("2030-01-01").cast("date"))


@query(f"WITH {KEYED} SELECT table_name, key AS date_val FROM keyed WHERE key NOT IN ('1998', '__once__')")
def partition_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _keyed(spark, sf_dir).select("table_name", F.col("key").alias("date_val"))
    return upsert.forget(k, worklist.always_again(k, "1998"))


@query(f"WITH {LOG} SELECT table_name, date_val, ok FROM log WHERE NOT (table_name = '1-URGENT' AND date_val = '199703')")
def single_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = log(spark, sf_dir)
    return upsert.forget(l, l.where("table_name = '1-URGENT' AND date_val = '199703'").select("table_name", "date_val")).select("table_name", "date_val", "ok")


@query(f"WITH {LOG} SELECT table_name, date_val, ok FROM log WHERE table_name NOT LIKE '5%'")
def log_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = log(spark, sf_dir)
    return upsert.purge_unknown(l, l.where("table_name NOT LIKE '5%'")).select("table_name", "date_val", "ok")


@query(f"WITH {LOG} SELECT table_name, count(*) FILTER (ok = 0) AS ok_0, count(*) FILTER (ok = 1) AS ok_1, count(*) FILTER (ok = 2) AS ok_2, count(*) FILTER (ok = 3) AS ok_3 FROM log GROUP BY 1")
def load_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.state_counts(log(spark, sf_dir))


@query(f"""SELECT DISTINCT {CODE_OF.format('l_suppkey')} || '__once__' AS date_val FROM lineitem WHERE l_suppkey % 3 <> 0""")
def domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a driver table under filters, once each."""
    found = bars(spark, sf_dir).where("inst % 3 <> 0").select(code("inst").alias("code"))
    return worklist.expected_by_domain(found, worklist.periods(days(spark, sf_dir), "once"), F.lit("holders")).select("date_val")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS ts_code, CAST(o_orderdate AS DATE) AS trade_date, o_totalprice AS val FROM orders WHERE o_orderkey % 7 <> 0")
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payload files, a seventh of them errors, read as a stream and merged into a table by month."""
    o = read(spark, sf_dir, "orders")
    fields = {"ts_code": F.col("o_orderkey").cast("string"), "trade_date": F.date_format("o_orderdate", "yyyyMMdd"), "val": F.col("o_totalprice").cast("string")}
    data = F.struct(F.array(*map(F.lit, fields)).alias("fields"), F.array(F.array(*fields.values())).alias("items"))
    lines = o.select(F.to_json(F.struct(F.when(F.col("o_orderkey") % 7 == 0, -1).otherwise(0).alias("code"), F.lit("").alias("msg"), data.alias("data"))).alias("value"))
    base = paths.fresh_path(spark, "stream")
    lines.write.text(f"{base}/landed")
    spec = TableSpec("orders", ("ts_code", "trade_date"), "trade_date", "trade_date")
    ingest(spark, f"{base}/landed", f"{base}/table", f"{base}/rejects", spec, {"ts_code": "string", "trade_date": "date", "val": "double"}, f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("ts_code", "trade_date", "val")


@query("""SELECT o_custkey AS custkey, arg_max(CAST(o_orderdate AS DATE), ROW(o_orderdate, o_orderkey)) AS day, arg_max(o_orderkey, ROW(o_orderdate, o_orderkey)) AS orderkey FROM orders GROUP BY 1""")
def roaming_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table on disk whose key has no date, merged from three batches: a key that comes again leaves its old month, so each has one row."""
    path, spec = paths.fresh_path(spark, "accounts"), TableSpec("accounts", ("custkey",), "day", "domain")
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("orderkey"), F.struct("o_orderdate", "o_orderkey").alias("seq"))
    for first, last in ((0, 1994), (1995, 1996), (1997, 9999)):
        merge_batch(orders.where(F.year("day").between(first, last)), spec, path, "custkey bigint, day date, orderkey bigint")
    return spark.read.parquet(path).select("custkey", "day", "orderkey")


#: Instants and days of a daily load: it is one evening of 1998, and some tables are there already.
TONIGHT, TARGET, SINCE = "1998-07-20", "1998-07-17", "1992-01-01"
DAILY_LOG = f"""{ASKED_SQL}, log AS (SELECT table_name, date_val, CAST(k % 4 AS INTEGER) AS ok, CAST(k % 7 AS INTEGER) AS retry_count, TIMESTAMP '{TONIGHT}' - to_days(CAST(k % 15 AS INTEGER)) AS last_try
              FROM (SELECT table_name, date_val, row_number() OVER (PARTITION BY table_name ORDER BY date_val) AS k FROM expected)),
              last AS (SELECT 'bars' AS table_name, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-20' UNION ALL SELECT 'orders', max(CAST(o_orderdate AS DATE)) FROM orders
                       UNION ALL SELECT 'weekly', max(CAST(l_shipdate AS DATE)) FROM lineitem),
              first AS (SELECT t.table_name, coalesce(d, DATE '{SINCE}') AS start FROM (SELECT DISTINCT table_name FROM expected) t LEFT JOIN last USING (table_name) WHERE d IS NULL OR d < DATE '{TARGET}'),
              gone AS (SELECT table_name, '{TARGET[:4]}' AS date_val FROM first WHERE table_name = 'orders' UNION ALL SELECT 'basic', '__once__'),
              kept AS (SELECT table_name, date_val, CASE WHEN ok = 0 AND retry_count >= 5 THEN 3 ELSE ok END AS ok, CASE WHEN ok = 0 AND retry_count < 5 THEN retry_count + 1 ELSE retry_count END AS retry_count
                       FROM log l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.table_name = l.table_name AND g.date_val = l.date_val) AND NOT (ok = 2 AND last_try < TIMESTAMP '{TONIGHT}' - INTERVAL 7 DAY))"""


def _daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    open_, every = _calendar(spark, sf_dir)
    codes_ = {"weights": supplier_codes(spark, sf_dir)}
    asked = reduce(DataFrame.unionByName, [worklist.expected(s, open_, every, codes_.get(s.name)) for s in ASKED])
    tonight, k = F.lit(TONIGHT).cast("timestamp_ntz"), F.col("k")
    ranked = asked.select("table_name", "date_val", F.row_number().over(Window.partitionBy("table_name").orderBy("date_val")).alias("k"))
    before = ranked.select("table_name", "date_val", (k % 4).cast("int").alias("ok"), (k % 7).cast("int").alias("retry_count"), (tonight - F.make_dt_interval(days=k % 15)).alias("last_try"))
    ship = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    rows = ship.where("d < DATE '1998-06-20'").withColumn("table_name", F.lit("bars")).unionByName(ship.withColumn("table_name", F.lit("weekly")))
    rows = rows.unionByName(read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), F.lit("orders").alias("table_name")))
    return worklist.daily(ASKED, open_, every, paths.stage(before, "log"), rows, date.fromisoformat(SINCE), date.fromisoformat(TARGET), tonight, codes_)


@query(f"""WITH {DAILY_LOG}, open AS (SELECT e.* FROM expected e LEFT JOIN kept k USING (table_name, date_val) WHERE k.ok IS NULL OR NOT (k.ok = 1 OR k.ok = 2 AND (strategy <> 'domain' OR period <> (SELECT max(period) FROM months)))),
           found AS (SELECT o.*, 0 AS k, 'due' AS reason FROM open o LEFT JOIN first f USING (table_name) WHERE strategy IN ('domain', 'once') OR (o."end" >= f.start AND o.start <= DATE '{TARGET}')
                     UNION ALL SELECT e.*, 1, 'stale' FROM expected e JOIN log l USING (table_name, date_val) WHERE strategy = 'trade_date' AND l.ok = 2 AND last_try < TIMESTAMP '{TONIGHT}' - INTERVAL 7 DAY
                     UNION ALL SELECT e.*, 2, 'retry' FROM expected e JOIN log l USING (table_name, date_val) WHERE l.ok = 0 AND l.retry_count < 5)
           SELECT table_name, strategy, date_val, any_value(start) AS start, any_value("end") AS "end", arg_min(reason, k) AS reason FROM found GROUP BY 1, 2, 3""")
def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one evening's load asks for, and why."""
    return _daily(spark, sf_dir)[0]


@query(f"WITH {DAILY_LOG} SELECT * FROM kept")
def daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that an evening's load starts from: running partitions and stale empties forgotten, retries counted, spent ones given up."""
    return _daily(spark, sf_dir)[1].select("table_name", "date_val", "ok", "retry_count")


@query(f"""WITH {DAILY_LOG}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-05')
           SELECT table_name, strategy, date_val, start, "end", EXISTS (SELECT 1 FROM log l WHERE l.table_name = e.table_name AND l.date_val = e.date_val) AS was_logged
           FROM expected e WHERE strategy = 'once' OR EXISTS (SELECT 1 FROM days WHERE d BETWEEN e.start AND e."end")""")
def refresh_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single days of every table loaded again: their partitions, and whether the log had lost them."""
    open_, every = _calendar(spark, sf_dir)
    codes_ = {"weights": supplier_codes(spark, sf_dir)}
    before = reduce(DataFrame.unionByName, [worklist.expected(s, open_, every, codes_.get(s.name)) for s in ASKED]).select("table_name", "date_val", F.lit(1).alias("ok"))
    days_ = read(spark, sf_dir, "orders").where("o_orderdate BETWEEN TIMESTAMP_NTZ '1998-03-01' AND TIMESTAMP_NTZ '1998-03-05'").select(F.to_date("o_orderdate").alias("d")).distinct()
    names = spark.createDataFrame([(s.name,) for s in ASKED], "table_name string")
    work, left = worklist.refresh(ASKED, open_, every, before, days_.crossJoin(F.broadcast(names)), codes_)  # names of tables
    still = left.select("table_name", "date_val", F.lit(True).alias("still"))
    return work.join(still, ["table_name", "date_val"], "left").select("table_name", "strategy", "date_val", "start", "end", F.col("still").isNull().alias("was_logged"))
