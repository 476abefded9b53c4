"""Tables of the market-data model derived from the driver's tables, in Spark and, as common table expressions, in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The instant that state queries take as now; never the clock.
NOW = "2001-08-01"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL of the same result."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


BARS = """bars AS (SELECT l_suppkey AS inst, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag
          FROM lineitem)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("inst"), F.to_date("l_shipdate").alias("d"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


DATES = """dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders),
           cal AS (SELECT d, CAST(row_number() OVER (ORDER BY d) - 1 AS INTEGER) AS idx FROM dates WHERE isodow(d) < 6)"""


def calendar_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(exchange, cal_date, is_open)``: every date of the data, open on weekdays."""
    d = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("cal_date")).union(read(spark, sf_dir, "orders").select(F.to_date("o_orderdate"))).distinct()
    return d.select(F.lit("SSE").alias("exchange"), "cal_date", F.when(F.weekday("cal_date") < 5, 1).otherwise(0).alias("is_open"))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_table(spark, sf_dir).where("is_open = 1").select(F.col("cal_date").alias("d"))


SLOTTED = f"""{DATES}, {BARS}, slotted AS (SELECT b.*, c.idx AS cal_idx FROM bars b ASOF JOIN cal c ON b.d <= c.d WHERE b.d >= (SELECT min(d) FROM cal))"""

CODES = """codes AS (SELECT s_suppkey, s_acctbal, s_nationkey,
           lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '.' || CASE s_suppkey % 4 WHEN 0 THEN 'SH' WHEN 1 THEN 'SZ' WHEN 2 THEN 'BJ' ELSE 'CSI' END AS code FROM supplier)"""


def supplier_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    return s.select("s_suppkey", "s_acctbal", "s_nationkey", code("s_suppkey").alias("code"))


def code(key: str):
    k = F.col(key)
    suffix = F.when(k % 4 == 0, "SH").when(k % 4 == 1, "SZ").when(k % 4 == 2, "BJ").otherwise("CSI")
    return F.concat(F.lpad(k.cast("string"), 6, "0"), F.lit("."), suffix)


CODE_OF = "lpad(CAST({0} AS VARCHAR), 6, '0') || '.' || CASE {0} % 4 WHEN 0 THEN 'SH' WHEN 1 THEN 'SZ' WHEN 2 THEN 'BJ' ELSE 'CSI' END"

LOG = """log AS (SELECT table_name, date_val, CAST(m % 4 AS INTEGER) AS ok, CAST(m % 7 AS INTEGER) AS retry_count, last_try FROM (
           SELECT o_orderpriority AS table_name, strftime(o_orderdate, '%Y%m') AS date_val, year(o_orderdate) * 12 + month(o_orderdate) AS m, max(o_orderdate) AS last_try
           FROM orders GROUP BY ALL))"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    m = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    g = o.groupBy(F.col("o_orderpriority").alias("table_name"), F.date_format("o_orderdate", "yyyyMM").alias("date_val"), m.alias("m")).agg(F.max("o_orderdate").alias("last_try"))
    return g.select("table_name", "date_val", (F.col("m") % 4).cast("int").alias("ok"), (F.col("m") % 7).cast("int").alias("retry_count"), "last_try")


STATE = f"""{BARS}, state AS (SELECT inst AS instrument, 'bars' AS source_table, CASE WHEN inst % 11 = 0 THEN NULL ELSE DATE '2000-06-30' END AS last_date, min(d) FILTER (l_linenumber <= 6) AS first_date,
            CASE WHEN inst % 3 = 0 THEN ['price'] ELSE ['price', 'vol'] END AS fields, count(*) FILTER (d <= DATE '2000-06-30' AND (l_linenumber <= 6 OR inst % 2 = 0)) AS row_count,
            CASE WHEN inst % 7 = 0 THEN 'partial' WHEN inst % 13 = 0 THEN 'error' ELSE 'done' END AS status FROM bars WHERE inst % 5 <> 0 GROUP BY inst)"""


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir).where("inst % 5 <> 0")
    mark = F.lit("2000-06-30").cast("date")
    i = F.col("instrument")
    g = b.groupBy(F.col("inst").alias("instrument")).agg(
        F.min(F.when(F.col("l_linenumber") <= 6, F.col("d"))).alias("first_date"),
        F.count_if((F.col("d") <= mark) & ((F.col("l_linenumber") <= 6) | (F.col("inst") % 2 == 0))).alias("row_count"),
    )
    fields = F.when(i % 3 == 0, F.array(F.lit("price"))).otherwise(F.array(F.lit("price"), F.lit("vol")))
    status = F.when(i % 7 == 0, "partial").when(i % 13 == 0, "error").otherwise("done")
    return g.select("instrument", F.lit("bars").alias("source_table"), F.when(i % 11 != 0, mark).alias("last_date"), "first_date", fields.alias("fields"), "row_count", status.alias("status"), mark.cast("timestamp").alias("updated_at"))
