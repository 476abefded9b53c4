"""Queries over features, instruments, quality reports and incremental builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog import EXPORTS, TABLES, ExportSpec, FieldDef, derive_fields
from tapeline.functions import codes
from tapeline.operators import calendar, export, features, incremental, instruments, quality, rollup
from tapeline.plans.inputs import BARS, CODE_OF, CODES, DATES, LOG, NOW, QUERIES, SLOTTED, SQL, STATE, bars, calendar_table, code, days, log, query, read, state, supplier_codes
from tapeline.sources import daybin, paths, text
from tapeline.streaming import ingest

#: Quotients of two-decimal values fall on rounding ties; both sides move off them by the same bit.
TIE = 1.234e-7


def _slotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.to_slots(bars(spark, sf_dir), "d", days(spark, sf_dir))


# --- scalar functions ----------------------------------------------------------------------------------------


@query(f"""WITH {CODES} SELECT code, split_part(code, '.', 2) || split_part(code, '.', 1) AS instrument, upper(code) AS sector,
           substr(split_part(code, '.', 2) || split_part(code, '.', 1), 3) || '.' || substr(split_part(code, '.', 2), 1, 2) AS back,
           CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE DATE '1999-01-01' + CAST(s_suppkey % 28 AS INTEGER) END AS day FROM codes""")
def code_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeline.functions.dates import day

    s = supplier_codes(spark, sf_dir)
    raw = F.when(F.col("s_suppkey") % 3 == 0, "1999").otherwise(F.concat(F.lit("199901"), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0"), F.lit(" 00:00")))
    inst = codes.instrument("code")
    return s.select("code", inst.alias("instrument"), codes.instrument("code", "sw_sector").alias("sector"), codes.source_code(inst).alias("back"), day(raw).alias("day"))


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 10 <> 0 AND contains(upper(p_type), 'S') THEN 1 ELSE 0 END AS INTEGER) AS st FROM part")
def st_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", codes.st_flag(F.when(F.col("p_size") % 10 != 0, F.col("p_type"))).alias("st"))


NAMES = """names AS (SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN 'bd_close' WHEN 1 THEN 'pe_ttm' WHEN 2 THEN 'turnover_rate' WHEN 3 THEN 'mf_buy_sm_vol' WHEN 4 THEN 'md_rzye' WHEN 5 THEN 'cyq_winner_rate'
           WHEN 6 THEN 'sl_up_limit' WHEN 7 THEN 'gz_on' WHEN 8 THEN 'bb_undp' WHEN 9 THEN 'macd_dif' WHEN 10 THEN 'mg_rqyl' ELSE 'vwap' END AS name,
           CASE WHEN p_partkey % 12 = 7 THEN 'gz_index' WHEN p_partkey % 12 = 9 THEN 'stk_factor_pro' WHEN p_partkey % 12 = 11 THEN 'cb_factor_pro' ELSE 'other' END AS source_table,
           CASE p_partkey % 12 WHEN 9 THEN 'stock' WHEN 11 THEN 'cb' WHEN 7 THEN 'market' ELSE 'etf' END AS inst_type FROM part)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 12
    values = ["bd_close", "pe_ttm", "turnover_rate", "mf_buy_sm_vol", "md_rzye", "cyq_winner_rate", "sl_up_limit", "gz_on", "bb_undp", "macd_dif", "mg_rqyl", "vwap"]
    table = F.when(k == 7, "gz_index").when(k == 9, "stk_factor_pro").when(k == 11, "cb_factor_pro").otherwise("other")
    kind = F.when(k == 9, "stock").when(k == 11, "cb").when(k == 7, "market").otherwise("etf")
    return read(spark, sf_dir, "part").select("p_partkey", F.get(F.array(*map(F.lit, values)), k.cast("int")).alias("name"), table.alias("source_table"), kind.alias("inst_type"))


@query(f"""WITH {NAMES} SELECT CASE name WHEN 'bd_close' THEN 'OHLCV' WHEN 'vwap' THEN 'OHLCV' WHEN 'pe_ttm' THEN 'valuation' WHEN 'turnover_rate' THEN 'liquidity' WHEN 'mf_buy_sm_vol' THEN 'moneyflow'
           WHEN 'md_rzye' THEN 'margin' WHEN 'mg_rqyl' THEN 'margin' WHEN 'cyq_winner_rate' THEN 'chip' WHEN 'sl_up_limit' THEN 'event' WHEN 'gz_on' THEN 'macro' WHEN 'bb_undp' THEN 'fundamental' ELSE 'technical' END AS category,
           count(*) AS n_fields FROM names GROUP BY 1""")
def field_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.category_counts(_names(spark, sf_dir))


@query(f"""WITH {NAMES} SELECT name, CASE inst_type WHEN 'cb' THEN 'convertible_bond' WHEN 'market' THEN 'market_virtual' ELSE inst_type END AS applies_to,
           CASE source_table WHEN 'stk_factor_pro' THEN 'hfq' WHEN 'cb_factor_pro' THEN 'bfq' ELSE 'none' END AS adjustment, count(*) AS n FROM names GROUP BY ALL""")
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.manifest(_names(spark, sf_dir)).groupBy("name", "applies_to", "adjustment").agg(F.count("*").alias("n"))


@query(f"WITH {BARS} SELECT l_orderkey, l_linenumber, d, CAST(CAST(l_extendedprice AS REAL) AS DOUBLE) AS price32 FROM bars")
def float_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("l_orderkey", "l_linenumber", "d", F.col("l_extendedprice").cast("float").cast("double").alias("price32"))


@query(f"""WITH {LOG}, p AS (SELECT table_name, count(*) FILTER (ok = 1) AS n, count(*) AS total FROM log GROUP BY 1)
           SELECT table_name, format('{{:.1f}}%', n * 100.0 / total + {TIE}) AS fill FROM p""")
def pct_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = log(spark, sf_dir).groupBy("table_name").agg(F.count_if(F.col("ok") == 1).alias("n"), F.count("*").alias("total"))
    return p.select("table_name", codes.percent_text(codes.percent(F.col("n"), F.col("total")) + TIE).alias("fill"))


# --- aggregation ---------------------------------------------------------------------------------------------


@query(f"""WITH {BARS} SELECT inst, d, CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS type_SH, CAST(max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INTEGER) AS type_SZ, count(*) AS count FROM bars GROUP BY 1, 2""")
def split_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "HK_SH").when(F.col("l_returnflag") == "A", "2").otherwise(F.col("l_returnflag"))
    return features.split_by_type(bars(spark, sf_dir).withColumn("type", kind), ["inst", "d"], "type")


@query(f"WITH {BARS} SELECT inst, d, round(sum(coalesce(nullif(l_quantity, 1), 0)), 4) AS q, round(sum(l_extendedprice), 4) AS p, count(*) AS n FROM bars GROUP BY 1, 2")
def sum_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir).withColumn("q", F.nullif("l_quantity", F.lit(1.0)))
    return features.sum_count(b, ["inst", "d"], {"q": "q", "p": "l_extendedprice"}, count="n").select("inst", "d", F.round("q", 4).alias("q"), F.round("p", 4).alias("p"), "n")


MEAN = """CASE WHEN sum(abs(coalesce(nullif(l_quantity, 1), 0))) > 0 THEN sum(coalesce(l_extendedprice, 0) * abs(coalesce(nullif(l_quantity, 1), 0))) / sum(abs(coalesce(nullif(l_quantity, 1), 0))) END"""


@query(f"WITH {BARS} SELECT inst, d, round({MEAN} + {TIE}, 6) AS mean, count(*) AS n FROM bars GROUP BY 1, 2")
def weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir).withColumn("q", F.nullif("l_quantity", F.lit(1.0)))
    return features.sum_count(b, ["inst", "d"], {}, {"mean": ("l_extendedprice", "q")}, "n").select("inst", "d", F.round(F.col("mean") + TIE, 6).alias("mean"), "n")


@query(f"WITH {BARS} SELECT inst, d, count(*) AS concepts, round(sum(coalesce(nullif(l_quantity, 1), 0)), 4) AS hot FROM bars GROUP BY 1, 2")
def count_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir).withColumn("hot_num", F.nullif("l_quantity", F.lit(1.0)))
    return features.sum_count(b, ["inst", "d"], {"hot": "hot_num"}, count="concepts").withColumn("hot", F.round("hot", 4))


LAST = "row_number() OVER (PARTITION BY inst, cal_idx ORDER BY d DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, {0} DESC)"


@query(f"""WITH {SLOTTED}, q AS (SELECT inst, cal_idx, l_quantity, {LAST.format('l_quantity')} AS rn FROM slotted WHERE l_quantity <> 1),
           p AS (SELECT inst, cal_idx, l_extendedprice, row_number() OVER (PARTITION BY inst, cal_idx ORDER BY d DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, nullif(l_quantity, 1) DESC NULLS LAST, l_extendedprice DESC) AS rn FROM slotted)
           SELECT p.inst, p.cal_idx, q.l_quantity AS q, p.l_extendedprice AS p FROM p LEFT JOIN q ON p.inst = q.inst AND p.cal_idx = q.cal_idx AND q.rn = 1 WHERE p.rn = 1""")
def slot_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _slotted(spark, sf_dir).select("inst", "cal_idx", "d", "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_quantity", F.lit(1.0)).alias("q"), F.col("l_extendedprice").alias("p"))
    return features.last_in_slot(s, ["inst", "cal_idx"], ["q", "p"], ["d", "l_orderkey", "l_linenumber", "l_partkey", "q", "p"])


#: Fields of the wide form; field k lacks a value where the quantity is a multiple of k + 1.
FIELDS = range(1, 65)


@query(f"""WITH {SLOTTED}, {', '.join(f"q{k} AS (SELECT inst, cal_idx, l_quantity * {k} AS f{k}, {LAST.format('l_quantity')} AS rn FROM slotted WHERE l_quantity % {k + 1} <> 0)" for k in FIELDS)}, s AS (SELECT DISTINCT inst, cal_idx FROM slotted)
           SELECT s.inst, s.cal_idx, {', '.join(f'f{k}' for k in FIELDS)} FROM s {' '.join(f'LEFT JOIN q{k} ON s.inst = q{k}.inst AND s.cal_idx = q{k}.cal_idx AND q{k}.rn = 1' for k in FIELDS)}""")
def slot_last_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty-four fields of the quantity, computed after the rows are dealt, so that a row crosses the network with one number of them."""
    s = _slotted(spark, sf_dir).select("inst", "cal_idx", "d", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    fields = {f"f{k}": F.when(F.col("l_quantity") % (k + 1) != 0, F.col("l_quantity") * k) for k in FIELDS}
    return features.last_in_slot(s, ["inst", "cal_idx"], fields, ["d", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])


@query(f"""WITH {BARS} SELECT l_orderkey, l_linenumber, l_partkey, d, CAST(CASE WHEN l_quantity - 1 > 0 THEN CAST(l_extendedprice AS REAL) * CAST(10 AS REAL) / CAST(l_quantity - 1 AS REAL) END AS DOUBLE) AS vwap FROM bars""")
def vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "d", codes.vwap("l_extendedprice", F.col("l_quantity") - 1).cast("double").alias("vwap"))


#: A value a slot for all instruments and lines, with gaps.
TOPS = "tops AS (SELECT inst, cal_idx, max(l_quantity) AS q, max(CASE WHEN l_quantity > 25 THEN l_extendedprice END) AS p FROM slotted GROUP BY 1, 2)"


def _tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slotted(spark, sf_dir).groupBy("inst", "cal_idx").agg(F.max("l_quantity").alias("q"), F.max(F.when(F.col("l_quantity") > 25, F.col("l_extendedprice"))).alias("p"))


@query(f"""WITH {SLOTTED}, {TOPS}, spans AS (SELECT inst, CAST(unnest(range(min(cal_idx), max(cal_idx) + 1)) AS INTEGER) AS cal_idx FROM tops GROUP BY inst)
           SELECT s.inst, s.cal_idx, q, p FROM spans s LEFT JOIN tops f ON s.inst = f.inst AND s.cal_idx = f.cal_idx""")
def dense_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.densify(_tops(spark, sf_dir), ["inst"], ["q", "p"])


@query(f"""WITH {SLOTTED}, {TOPS} SELECT inst, 'q' AS field, min(cal_idx) AS first_idx, max(cal_idx) AS last_idx FROM tops GROUP BY 1 UNION ALL
           SELECT inst, 'p', min(cal_idx), max(cal_idx) FROM tops WHERE p IS NOT NULL GROUP BY 1""")
def trim_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.valid_bounds(_tops(spark, sf_dir), ["inst"], ["q", "p"])


BLOCK = ExportSpec("block_trade", "stock", naming="aggregated", prefix="bt", agg="sum_count", count_name="bt_trade_cnt", weights={"price": "vol"})


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select(code("inst").alias("ts_code"), F.col("d").alias("trade_date"), F.col("l_extendedprice").alias("price"), F.nullif("l_quantity", F.lit(1.0)).alias("vol"), F.col("l_tax").alias("amount"))


TRADES = f"""{DATES}, {BARS}, daily AS (SELECT inst, d, round(sum(l_tax), 4) AS amount, {MEAN} AS price, sum(coalesce(nullif(l_quantity, 1), 0)) AS vol, count(*) AS n FROM bars GROUP BY 1, 2),
             placed AS (SELECT x.*, c.idx AS cal_idx FROM daily x ASOF JOIN cal c ON x.d <= c.d WHERE x.d >= (SELECT min(d) FROM cal)),
             slots AS (SELECT inst, cal_idx, arg_max(amount, d) AS amount, arg_max(price, d) AS price, arg_max(vol, d) AS vol, arg_max(n, d) AS n FROM placed GROUP BY 1, 2)"""
INST_OF = "CASE {0} % 4 WHEN 0 THEN 'SH' WHEN 1 THEN 'SZ' WHEN 2 THEN 'BJ' ELSE 'CSI' END || lpad(CAST({0} AS VARCHAR), 6, '0')"


@query(f"""WITH {TRADES} SELECT {INST_OF.format('inst')} AS instrument, cal_idx, round(amount, 4) AS bt_amount, round(price + {TIE}, 6) AS bt_price, round(vol, 4) AS bt_vol, CAST(n AS DOUBLE) AS bt_trade_cnt FROM slots""")
def feature_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block trades to features: sums, weighted price and count by day, forward to the next open day, one row per slot."""
    trades = _trades(spark, sf_dir)
    out = features.build(trades, BLOCK, derive_fields(BLOCK, trades.schema), days(spark, sf_dir))
    return out.select("instrument", "cal_idx", F.round("bt_amount", 4).alias("bt_amount"), F.round(F.col("bt_price") + TIE, 6).alias("bt_price"), F.round("bt_vol", 4).alias("bt_vol"), "bt_trade_cnt")


PRICED = ExportSpec("stk_factor_pro", "stock", naming="adjusted", computed=(("vwap", "vwap"),))


@query(f"""WITH {SLOTTED}, s AS (SELECT inst, cal_idx, arg_max(l_extendedprice, ROW(d, l_extendedprice, l_quantity)) AS amount, arg_max(l_quantity, ROW(d, l_extendedprice, l_quantity)) AS vol
           FROM (SELECT inst, cal_idx, d, max(l_extendedprice) AS l_extendedprice, arg_max(l_quantity, ROW(l_extendedprice, l_quantity)) AS l_quantity FROM slotted GROUP BY 1, 2, 3) GROUP BY 1, 2)
           SELECT {INST_OF.format('inst')} AS instrument, cal_idx, amount, vol AS volume, CAST(CAST(amount AS REAL) * CAST(10 AS REAL) / CAST(vol AS REAL) AS DOUBLE) AS vwap FROM s""")
def priced_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars to features with the volume-weighted price, on the largest trade of each day."""
    b = bars(spark, sf_dir).select(code("inst").alias("ts_code"), F.col("d").alias("trade_date"), "l_extendedprice", "l_quantity")
    dealt = b.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ts_code")  # once: days and slots of an instrument stay where it is
    top = dealt.groupBy("ts_code", "trade_date").agg(F.max(F.struct("l_extendedprice", "l_quantity")).alias("t"))
    table = top.select("ts_code", "trade_date", F.col("t.l_extendedprice").alias("amount"), F.col("t.l_quantity").alias("vol"))
    return features.build(table, PRICED, derive_fields(PRICED, table.schema), days(spark, sf_dir)).select("instrument", "cal_idx", "amount", "volume", "vwap")


@query("""SELECT column_name AS source_column, CASE column_name WHEN 'l_quantity' THEN 'etf_l_quantity' ELSE 'etf_' || column_name END AS name, (SELECT count(*) FROM lineitem) AS n_rows
          FROM (VALUES ('l_discount'), ('l_extendedprice'), ('l_linenumber'), ('l_orderkey'), ('l_partkey'), ('l_quantity'), ('l_suppkey'), ('l_tax')) t(column_name)""")
def derived_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field names that follow from the bars' schema, with the rows they hold."""
    li = read(spark, sf_dir, "lineitem")
    own = [f for f in derive_fields(EXPORTS["fund_factor_pro"], li.schema) if f.column]
    fields = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{f.column}', '{f.name}')" for f in own) + " t(source_column, name)")
    return fields.crossJoin(li.agg(F.count("*").alias("n_rows")))


# --- instruments ---------------------------------------------------------------------------------------------


@query(f"WITH {BARS} SELECT inst, min(d) AS first_date, max(d) AS last_date FROM bars GROUP BY 1")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruments.date_ranges(bars(spark, sf_dir), ["inst"], "d")


@query(f"WITH {BARS} SELECT min(d) AS first_date, max(d) AS last_date FROM bars")
def table_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruments.date_ranges(bars(spark, sf_dir), [], "d")


LISTED = f"""{CODES}, {BARS}, listed AS (SELECT {INST_OF.format('s_suppkey')} AS instrument, 'stock' AS kind, CASE WHEN s_suppkey % 4 <> 0 THEN DATE '1995-01-01' END AS start, CASE WHEN s_suppkey % 7 = 0 THEN DATE '2000-01-01' END AS "end" FROM codes WHERE s_suppkey % 10 <> 0
             UNION ALL SELECT '_market_orders', 'market', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) FROM orders),
             traded AS (SELECT {INST_OF.format('inst')} AS instrument, 'stock' AS kind, min(d) AS start, max(d) AS "end" FROM bars WHERE inst % 4 <> 3 GROUP BY inst),
             master AS (SELECT instrument, kind, coalesce(start, DATE '1990-01-01') AS start, coalesce("end", DATE '2099-12-31') AS "end" FROM (SELECT * FROM listed UNION ALL SELECT * FROM traded t WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.instrument = t.instrument)))"""


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = supplier_codes(spark, sf_dir).where("s_suppkey % 10 <> 0")
    listed = s.select("code", F.expr("CASE WHEN s_suppkey % 4 <> 0 THEN DATE '1995-01-01' END").alias("start"), F.expr("CASE WHEN s_suppkey % 7 = 0 THEN DATE '2000-01-01' END").alias("end"))
    traded = bars(spark, sf_dir).select(code("inst").alias("code"), F.col("d").alias("date"))
    orders = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return instruments.master({"stock": listed}, traded, {"_market_orders": orders})


@query(f"WITH {LISTED} SELECT * FROM master")
def instrument_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _master(spark, sf_dir)


@query(f"WITH {LISTED} SELECT DISTINCT instrument, 'stock' AS of FROM master WHERE kind = 'stock' UNION ALL SELECT '_market_orders', 'market'")
def instruments_for_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _master(spark, sf_dir)
    return instruments.for_table(m, "stock").withColumn("of", F.lit("stock")).unionByName(instruments.for_table(m, "market", "_market_orders").withColumn("of", F.lit("market")))


MEMBERS = """m AS (SELECT DISTINCT o_orderpriority AS index_code, CAST(o_custkey AS VARCHAR) AS con_code, CAST(o_orderdate AS DATE) AS date FROM orders),
             g AS (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY index_code, con_code ORDER BY date) <= 40 THEN 0 ELSE 1 END AS opens FROM m),
             p AS (SELECT *, sum(opens) OVER (PARTITION BY index_code, con_code ORDER BY date) AS period FROM g),
             periods AS (SELECT index_code, con_code, min(date) AS start, CASE WHEN max(date) = (SELECT max(date) FROM m x WHERE x.index_code = p.index_code) THEN DATE '2099-12-31' ELSE max(date) END AS "end" FROM p GROUP BY index_code, con_code, period)"""


def _constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return instruments.constituents(o.select(F.col("o_orderpriority").alias("index_code"), F.col("o_custkey").cast("string").alias("con_code"), F.to_date("o_orderdate").alias("date")))


@query(f"WITH {MEMBERS} SELECT * FROM periods")
def constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _constituents(spark, sf_dir)


# --- quality -------------------------------------------------------------------------------------------------

ROWS = "rows AS (SELECT o_orderpriority AS table_name, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS VARCHAR) AS code, strftime(o_orderdate, '%Y%m') AS period FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderdate < TIMESTAMP '1997-01-01')"
COVER = f"""{DATES}, {ROWS}, cover AS (SELECT t.table_name, CAST(coalesce(n, 0) AS BIGINT) AS n_days, (SELECT count(*) FROM cal) AS n_open, (SELECT count(*) FROM cal) - coalesce(n, 0) AS n_missing, round(coalesce(n, 0) * 100.0 / (SELECT count(*) FROM cal), 4) AS fill,
            CASE WHEN coalesce(n, 0) * 100.0 / (SELECT count(*) FROM cal) >= 99.9 THEN 'perfect' WHEN coalesce(n, 0) * 100.0 / (SELECT count(*) FROM cal) >= 95 THEN 'small_gap' ELSE 'big_gap' END AS tier
            FROM (SELECT DISTINCT table_name FROM rows) t LEFT JOIN (SELECT table_name, count(DISTINCT d) AS n FROM rows WHERE d IN (SELECT d FROM cal) GROUP BY 1) c USING (table_name))"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW' OR o_orderdate < TIMESTAMP_NTZ '1997-01-01'")
    return o.select(F.col("o_orderpriority").alias("table_name"), F.to_date("o_orderdate").alias("d"), F.col("o_custkey").cast("string").alias("code"), F.date_format("o_orderdate", "yyyyMM").alias("period"))


@query(f"WITH {COVER} SELECT * FROM cover")
def coverage_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dated_coverage(_rows(spark, sf_dir), days(spark, sf_dir))


@query(f"WITH {DATES}, {ROWS} SELECT t.table_name, cal.d FROM cal, (SELECT DISTINCT table_name FROM rows) t WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE r.table_name = t.table_name AND r.d = cal.d)")
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_days(_rows(spark, sf_dir), days(spark, sf_dir))


@query(f"""WITH {ROWS}, e AS (SELECT count(DISTINCT period) * 300 AS n_expected FROM rows), a AS (SELECT table_name, count(DISTINCT code) AS n_codes, count(DISTINCT code || '_' || period) AS n_actual FROM rows GROUP BY 1)
           SELECT table_name, n_codes, n_actual, n_expected, round(n_actual * 100.0 / n_expected, 4) AS fill,
           CASE WHEN n_actual * 100.0 / n_expected >= 99.9 THEN 'perfect' WHEN n_actual * 100.0 / n_expected >= 95 THEN 'small_gap' ELSE 'big_gap' END AS tier, n_actual * 100.0 / n_expected > 100 AS over FROM a, e""")
def coverage_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rows(spark, sf_dir)
    expected = r.select("table_name").distinct().crossJoin(r.agg((F.countDistinct("period") * 300).alias("n_expected")))
    return quality.domain_coverage(r, expected)


@query(f"WITH {ROWS} SELECT table_name, code, count(DISTINCT period) AS n_periods FROM rows GROUP BY 1, 2")
def periods_per_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.periods_per_code(_rows(spark, sf_dir))


@query(f"""WITH {ROWS}, e AS (SELECT table_name, count(DISTINCT period) AS n_periods_expected FROM rows GROUP BY 1)
           SELECT table_name, code, count(DISTINCT period) AS n_periods, n_periods_expected FROM rows JOIN e USING (table_name) GROUP BY ALL HAVING n_periods_expected > 12 AND count(DISTINCT period) < 0.05 * n_periods_expected""")
def thin_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rows(spark, sf_dir)
    return quality.thin_codes(r, r.groupBy("table_name").agg(F.countDistinct("period").alias("n_periods_expected")), share=0.05)


@query(f"WITH {ROWS} SELECT DISTINCT table_name, period FROM rows")
def distinct_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("table_name", "period").distinct()


@query("SELECT 'lineitem' AS table_name, count(*) AS n_rows, NULL::VARCHAR AS state FROM lineitem UNION ALL SELECT 'orders', count(*), NULL FROM orders UNION ALL SELECT 'none_urgent', 0, 'untouched' UNION ALL SELECT '1-URGENT', 0, 'empty'")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    none = o.where("o_orderkey < 0")
    return quality.snapshot_states(quality.row_counts({"lineitem": read(spark, sf_dir, "lineitem"), "orders": o, "none_urgent": none, "1-URGENT": none}), log(spark, sf_dir))


@query(f"""WITH {COVER}, {LOG} SELECT table_name, 'failed' AS issue, count(*) AS n FROM log WHERE ok = 0 GROUP BY 1 UNION ALL SELECT table_name, 'gap', n_missing FROM cover WHERE n_missing > 100""")
def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issues(log(spark, sf_dir), quality.dated_coverage(_rows(spark, sf_dir), days(spark, sf_dir)))


@query(f"WITH {COVER} SELECT tier, count(*) AS n_tables FROM cover GROUP BY 1")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(quality.dated_coverage(_rows(spark, sf_dir), days(spark, sf_dir)))


REPORT = f"""{COVER}, {LOG}, counts AS (SELECT o_orderpriority AS table_name, count(*) AS n_rows FROM orders GROUP BY 1 UNION ALL SELECT 'none_urgent', 0),
              states AS (SELECT table_name, count(*) FILTER (ok = 0) AS ok_0, count(*) FILTER (ok = 1) AS ok_1, count(*) FILTER (ok = 2) AS ok_2, count(*) FILTER (ok = 3) AS ok_3 FROM log GROUP BY 1),
              report AS (SELECT table_name, n_rows, CASE WHEN n_rows > 0 THEN NULL WHEN s.ok_0 IS NULL THEN 'untouched' ELSE 'empty' END AS state, n_missing, fill, tier,
                         coalesce(ok_0, 0) AS ok_0, coalesce(ok_1, 0) AS ok_1, coalesce(ok_2, 0) AS ok_2, coalesce(ok_3, 0) AS ok_3 FROM counts LEFT JOIN cover USING (table_name) LEFT JOIN states s USING (table_name))"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("table_name"))
    counts = o.groupBy("table_name").agg(F.count("*").alias("n_rows")).unionByName(quality.row_counts({"none_urgent": o.where("table_name IS NULL")}))
    return quality.report(quality.dated_coverage(_rows(spark, sf_dir), days(spark, sf_dir)), counts, log(spark, sf_dir))


@query(f"WITH {REPORT} SELECT * FROM report")
def table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query(f"""WITH {REPORT} SELECT count(*) AS n_tables, CAST(sum(n_rows) AS BIGINT) AS total_rows, count(*) FILTER (state = 'empty') AS n_empty, count(*) FILTER (state = 'untouched') AS n_untouched,
           count(*) FILTER (tier = 'perfect') AS n_perfect, count(*) FILTER (tier = 'small_gap') AS n_small_gap, count(*) FILTER (tier = 'big_gap') AS n_big_gap, CAST(coalesce(sum(n_missing), 0) AS BIGINT) AS n_missing,
           CAST(sum(ok_0) AS BIGINT) AS ok_0, CAST(sum(ok_1) AS BIGINT) AS ok_1, CAST(sum(ok_2) AS BIGINT) AS ok_2, CAST(sum(ok_3) AS BIGINT) AS ok_3 FROM report""")
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall(_report(spark, sf_dir))


# --- incremental ---------------------------------------------------------------------------------------------

WANTED = ["price", "vol"]
DECIDED = f"""{STATE}, seen AS (SELECT b.inst AS instrument, min(d) AS first_seen, max(d) AS last_seen, count(*) FILTER (d <= last_date) AS n_history FROM bars b LEFT JOIN state s ON s.instrument = b.inst GROUP BY 1),
              decided AS (SELECT w.instrument, CASE WHEN s.status IS NULL THEN NULL WHEN s.last_date IS NULL THEN 'no mark' WHEN first_seen < s.first_date THEN 'earlier start' WHEN n_history > s.row_count THEN 'grown history' END AS reason,
              CASE WHEN s.status IS NULL THEN 'price,vol' WHEN len(s.fields) = 1 THEN 'vol' ELSE '' END AS added, s.status, coalesce(last_seen > s.last_date, FALSE) AS tail
              FROM (SELECT DISTINCT inst AS instrument FROM bars) w LEFT JOIN (SELECT * FROM state WHERE status = 'done') s USING (instrument) LEFT JOIN seen USING (instrument))"""


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select(F.col("inst").alias("instrument"), F.lit("bars").alias("source_table"), F.col("d").alias("date"), "l_orderkey", "l_linenumber", "l_partkey")


@query(f"""WITH {DECIDED} SELECT instrument, CASE WHEN status IS NULL THEN 'new' WHEN reason IS NOT NULL THEN 'rebuild' WHEN added <> '' THEN 'backfill' WHEN tail THEN 'tail' ELSE 'none' END AS action, reason, added FROM decided""")
def rebuild_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _source(spark, sf_dir)
    return incremental.decide(src, state(spark, sf_dir), src, WANTED).drop("source_table")


@query(f"WITH {STATE} SELECT w.instrument, s.instrument IS NULL AS is_new FROM (SELECT DISTINCT inst AS instrument FROM bars) w LEFT JOIN (SELECT * FROM state WHERE status = 'done') s USING (instrument)")
def sync_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _source(spark, sf_dir)
    d = incremental.decide(src, state(spark, sf_dir), src, WANTED)
    return d.select("instrument", (F.col("action") == "new").alias("is_new"))


@query(f"WITH {STATE} SELECT instrument, status = 'done' AND len(fields) = 2 AS synced FROM state")
def synced_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(spark, sf_dir).select("instrument", incremental.is_synced(F.array(*map(F.lit, WANTED)), F.col("fields"), F.col("status")).alias("synced"))


@query(f"WITH {STATE} SELECT instrument, CASE WHEN len(fields) = 1 THEN 'vol' ELSE '' END AS added FROM state")
def added_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(spark, sf_dir).select("instrument", F.array_join(incremental.missing_fields(F.array(*map(F.lit, WANTED)), F.col("fields")), ",").alias("added"))


@query(f"WITH {DECIDED} SELECT instrument, first_seen, last_seen, n_history FROM seen")
def history_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.history(_source(spark, sf_dir), state(spark, sf_dir)).select("instrument", "first_seen", "last_seen", "n_history")


@query(f"WITH {STATE} SELECT b.inst AS instrument, b.d AS date, l_orderkey, l_linenumber, l_partkey FROM bars b JOIN state s ON s.instrument = b.inst WHERE s.status = 'done' AND b.d > s.last_date")
def tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.tail_rows(_source(spark, sf_dir), state(spark, sf_dir)).drop("source_table")


@query(f"""WITH {STATE}, t AS (SELECT b.inst AS instrument, max(d) AS new_last, count(*) AS n FROM bars b JOIN state s ON s.instrument = b.inst WHERE s.status = 'done' AND b.d > s.last_date GROUP BY 1)
           SELECT instrument, greatest(last_date, new_last) AS last_date, row_count + coalesce(n, 0) AS row_count FROM state LEFT JOIN t USING (instrument)""")
def state_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = state(spark, sf_dir)
    return incremental.advance(s, incremental.tail_rows(_source(spark, sf_dir), s)).select("instrument", "last_date", "row_count")


@query(f"WITH {STATE} SELECT source_table, count(*) AS n_instruments, count(*) FILTER (status = 'done' AND len(fields) = 2) AS n_synced, count(*) FILTER (NOT (status = 'done' AND len(fields) = 2)) AS n_pending FROM state GROUP BY 1")
def conversion_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.totals(state(spark, sf_dir), WANTED)


@query(f"WITH {STATE} SELECT instrument, status FROM state WHERE status IN ('partial', 'error')")
def resume_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.with_status(state(spark, sf_dir), "partial", "error").select("instrument", "status")


@query(f"WITH {STATE} SELECT instrument, CASE WHEN instrument % 2 = 0 THEN 'done' ELSE status END AS status, CASE WHEN instrument % 2 = 0 THEN row_count + 1 ELSE row_count END AS row_count FROM state")
def state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = state(spark, sf_dir)
    new = s.where("instrument % 2 = 0").withColumns({"status": F.lit("done"), "row_count": F.col("row_count") + 1})
    return incremental.merge_state(s, new).select("instrument", "status", "row_count")


MARK = "2000-06-30"
#: The second source table: orders by 200 groups of customers, whose names are partly those of the first table's instruments.
HELD = ExportSpec("holders", "stock", "ann_date", naming="aggregated", prefix="ho", agg="sum_count", count_name="ho_cnt")


def _exports(spark: SparkSession, sf_dir: str, first: bool) -> dict[str, export.Export]:
    """Two tables; in the ``first`` run they end at MARK, some instruments lack their early rows, and fields are still to come."""
    trades, orders = _trades(spark, sf_dir), read(spark, sf_dir, "orders").withColumn("held_by", F.col("o_custkey") % 200)
    holders = orders.select(code("held_by").alias("ts_code"), F.to_date("o_orderdate").alias("ann_date"), (F.col("o_orderkey") % 100).cast("double").alias("val"))
    if first:
        trades = trades.where(f"trade_date <= DATE '{MARK}' AND (ts_code NOT LIKE '%1.SZ' OR trade_date > DATE '1997-01-01') AND ts_code NOT LIKE '%5.SZ'")
        holders = holders.where(f"ann_date <= DATE '{MARK}' AND ts_code NOT LIKE '%3.CSI'")
    fields = {"block_trade": [f for f in derive_fields(BLOCK, trades.schema) if f.name != "bt_price"], "holders": [f for f in derive_fields(HELD, holders.schema) if not first or f.name != "ho_cnt"]}
    return {"block_trade": export.Export(trades, BLOCK, tuple(fields["block_trade"])), "holders": export.Export(holders, HELD, tuple(fields["holders"]))}


def _exported(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    base = paths.fresh_path(spark, "export")
    at, out = f"{base}/state", f"{base}/vectors"
    cal, now = days(spark, sf_dir), F.lit(NOW).cast("timestamp")
    export.run(spark, _exports(spark, sf_dir, True), cal, at, out, now)
    return at, out, export.run(spark, _exports(spark, sf_dir, False), cal, at, out, now)


GROUPS = f"""{DATES}, {BARS}, held AS (SELECT o_custkey % 200 AS inst, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 100 AS DOUBLE) AS val FROM orders),
             pairs AS (SELECT * FROM (SELECT 'block_trade' AS source_table, inst, d FROM bars UNION ALL SELECT 'holders', inst, d FROM held) WHERE d <= (SELECT max(d) FROM cal))"""


@query(f"""WITH {GROUPS}, daily AS (SELECT inst, d, sum(l_tax) AS bt_amount, sum(coalesce(nullif(l_quantity, 1), 0)) AS bt_vol, count(*) AS bt_trade_cnt FROM bars GROUP BY 1, 2),
           hdaily AS (SELECT inst, d, sum(val) AS ho_val, count(*) AS ho_cnt FROM held GROUP BY 1, 2),
           t AS (SELECT x.*, c.idx FROM daily x ASOF JOIN cal c ON x.d <= c.d WHERE x.d >= (SELECT min(d) FROM cal)),
           h AS (SELECT x.*, c.idx FROM hdaily x ASOF JOIN cal c ON x.d <= c.d WHERE x.d >= (SELECT min(d) FROM cal)),
           long AS (SELECT inst, idx, 'bt_amount' AS field, arg_max(bt_amount, d) AS v FROM t GROUP BY 1, 2 UNION ALL SELECT inst, idx, 'bt_vol', arg_max(bt_vol, d) FROM t GROUP BY 1, 2
                    UNION ALL SELECT inst, idx, 'bt_trade_cnt', arg_max(bt_trade_cnt, d) FROM t GROUP BY 1, 2 UNION ALL SELECT inst, idx, 'ho_val', arg_max(ho_val, d) FROM h GROUP BY 1, 2
                    UNION ALL SELECT inst, idx, 'ho_cnt', arg_max(ho_cnt, d) FROM h GROUP BY 1, 2)
           SELECT {INST_OF.format('inst')} AS instrument, field, CAST(idx AS BIGINT) AS cal_idx, round(v, 2) AS value FROM long""")
def incremental_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables exported up to a mark and then brought up to date, in one set of files: the same vectors as from one build."""
    _, out, _ = _exported(spark, sf_dir)
    return daybin.read(spark, out).where("value IS NOT NULL").select("instrument", "field", "cal_idx", F.round(F.col("value").cast("double"), 2).alias("value"))


@query(f"""WITH {GROUPS} SELECT {INST_OF.format('inst')} AS instrument, source_table, max(d) AS last_date, min(d) AS first_date, count(*) AS row_count, 'done' AS status,
           CASE source_table WHEN 'holders' THEN 'ho_val,ho_cnt' ELSE 'bt_amount,bt_vol,bt_trade_cnt' END AS fields FROM pairs GROUP BY ALL""")
def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after both runs: a row for each instrument and table."""
    at, _, _ = _exported(spark, sf_dir)
    return export.read_state(spark, at).select("instrument", "source_table", "last_date", "first_date", "row_count", "status", F.array_join("fields", ",").alias("fields"))


@query(f"""WITH {GROUPS}, seen AS (SELECT source_table, inst, {CODE_OF.format('inst')} AS code, min(d) AS a, max(d) AS z, count(*) AS n FROM pairs GROUP BY ALL),
           early AS (SELECT source_table, inst, min(d) AS a, max(d) AS z FROM pairs WHERE d <= DATE '{MARK}' AND CASE source_table WHEN 'holders' THEN {CODE_OF.format('inst')} NOT LIKE '%3.CSI'
                     ELSE {CODE_OF.format('inst')} NOT LIKE '%5.SZ' AND ({CODE_OF.format('inst')} NOT LIKE '%1.SZ' OR d > DATE '1997-01-01') END GROUP BY ALL)
           SELECT source_table, CASE WHEN e.a IS NULL THEN 'new' WHEN s.a < e.a THEN 'rebuild' WHEN source_table = 'holders' THEN 'backfill' WHEN s.z > e.z THEN 'tail' ELSE 'none' END AS action,
                  count(*) AS n_instruments, CAST(sum(n) AS BIGINT) AS n_rows FROM seen s LEFT JOIN early e USING (source_table, inst) GROUP BY ALL""")
def incremental_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second run wrote and skipped."""
    return export.summary(_exported(spark, sf_dir)[2])


BUILT = f"""daily AS (SELECT inst, d, sum(l_tax) AS bt_amount, sum(coalesce(nullif(l_quantity, 1), 0)) AS bt_vol, count(*) AS bt_trade_cnt FROM bars GROUP BY 1, 2),
            t AS (SELECT x.*, c.idx FROM daily x ASOF JOIN cal c ON x.d <= c.d WHERE x.d >= (SELECT min(d) FROM cal)),
            built AS (SELECT inst, idx, 'bt_amount' AS field, arg_max(bt_amount, d) AS v FROM t GROUP BY 1, 2 UNION ALL SELECT inst, idx, 'bt_vol', arg_max(bt_vol, d) FROM t GROUP BY 1, 2
                      UNION ALL SELECT inst, idx, 'bt_trade_cnt', arg_max(bt_trade_cnt, d) FROM t GROUP BY 1, 2)"""
AS_WRITTEN = f"SELECT {INST_OF.format('inst')} AS instrument, field, CAST(idx AS BIGINT) AS cal_idx, round(v, 2) AS value FROM built"


def _written(spark: SparkSession, path: str) -> DataFrame:
    return daybin.read(spark, path).where("value IS NOT NULL").select("instrument", "field", "cal_idx", F.round(F.col("value").cast("double"), 2).alias("value"))


def _amounts(trades: DataFrame) -> tuple[FieldDef, ...]:
    return tuple(f for f in derive_fields(BLOCK, trades.schema) if f.name != "bt_price")


#: A Saturday, the Sunday after it, and the end: late rows fall into slots that are written.
CUTS = ("1997-06-07", "1997-06-08", "9999-12-31")
LOADED = "ts_code string, trade_date date, price double, vol double, amount double"


def _load(spark: SparkSession, sf_dir: str, base: str, after: str, upto: str) -> export.Export:
    """Trades between two days merged into a table partitioned by month, with its monthly counts."""
    trades = _trades(spark, sf_dir)
    new = trades.where((F.col("trade_date") > F.lit(after).cast("date")) & (F.col("trade_date") <= F.lit(upto).cast("date")))
    ingest.merge_batch(new, TABLES["block_trade"], f"{base}/table", LOADED, (f"{base}/counts", BLOCK))
    table = spark.read.schema(f"{LOADED}, month string").parquet(f"{base}/table")
    return export.Export(table, BLOCK, _amounts(trades), "month", rollup.read(spark, f"{base}/counts"))


@query(f"WITH {DATES}, {BARS}, {BUILT} {AS_WRITTEN}")
def weekend_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded and exported up to a Saturday, a Sunday and its end: the same vectors as from one build. Decisions come from
    monthly counts, late rows from late partitions."""
    base, after = paths.fresh_path(spark, "weekends"), "0001-01-01"
    for cut in CUTS:
        export.run(spark, {"block_trade": _load(spark, sf_dir, base, after, cut)}, days(spark, sf_dir), f"{base}/state", f"{base}/vectors", F.lit(NOW))
        after = cut
    return _written(spark, f"{base}/vectors")


@query(f"""WITH {BARS} SELECT {INST_OF.format('inst')} AS instrument, strftime(d, '%Y%m') AS month, count(*) AS n_rows, min(d) AS first_seen, max(d) AS last_seen FROM bars GROUP BY ALL""")
def month_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly counts as merges leave them: two batches that overlap by some days."""
    base = paths.fresh_path(spark, "rollup")
    _load(spark, sf_dir, base, "0001-01-01", "1996-03-20")
    return _load(spark, sf_dir, base, "1996-03-11", "9999-12-31").counts.select("instrument", "month", "n_rows", "first_seen", "last_seen")


@query(f"WITH {DATES}, {BARS}, {BUILT} {AS_WRITTEN}")
def calendar_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written by a calendar that lacks some open days and has some others, brought to the true one: as from one build."""
    base, true = paths.fresh_path(spark, "remap"), days(spark, sf_dir)
    nth = F.dayofyear("d")
    other = calendar_table(spark, sf_dir).select(F.col("cal_date").alias("d")).where(F.when(F.weekday("d") < 5, nth % 17 != 3).otherwise((F.weekday("d") == 5) & (nth % 13 == 1)))
    trades = _trades(spark, sf_dir)
    early = trades.where(F.col("trade_date") <= F.lit("1997-10-15").cast("date"))
    for table, cal in ((early, other), (trades, true)):
        export.run(spark, {"block_trade": export.Export(table, BLOCK, _amounts(trades))}, cal, f"{base}/state", f"{base}/vectors", F.lit(NOW))
    return _written(spark, f"{base}/vectors")


@query(f"""WITH {DATES}, {BARS}, seen AS (SELECT inst, count(DISTINCT idx) AS n, count(DISTINCT idx) FILTER (x.d <= DATE '{CUTS[0]}') AS n_early, max(x.d) AS z FROM bars x ASOF JOIN cal c ON x.d <= c.d WHERE x.d >= (SELECT min(d) FROM cal) GROUP BY inst)
           SELECT {INST_OF.format('inst')} AS instrument, CASE WHEN inst % 7 = 3 AND z > DATE '{CUTS[0]}' THEN 'error' ELSE 'done' END AS status, CASE WHEN inst % 7 = 3 AND z > DATE '{CUTS[0]}' THEN n_early ELSE n END AS n_days FROM seen""")
def poisoned_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run in which some instruments have an amount that no vector can hold: they are errors and keep their old files, the others are done."""
    base, trades = paths.fresh_path(spark, "poisoned"), _trades(spark, sf_dir)
    late = F.col("trade_date") > F.lit(CUTS[0]).cast("date")
    bad = trades.withColumn("amount", F.when(late & (F.substring("ts_code", 1, 6).cast("int") % 7 == 3), F.lit(1e300)).otherwise(F.col("amount")))
    for table in (trades.where(~late), bad):
        export.run(spark, {"block_trade": export.Export(table, BLOCK, _amounts(trades))}, days(spark, sf_dir), f"{base}/state", f"{base}/vectors", F.lit(NOW))
    held = _written(spark, f"{base}/vectors").where("field = 'bt_trade_cnt'").groupBy("instrument").agg(F.count("*").alias("n_days"))
    return export.read_state(spark, f"{base}/state").select("instrument", "status").join(held, "instrument")


@query(f"WITH {DATES}, {BARS}, {BUILT} {AS_WRITTEN} WHERE inst % 9 <> 0 OR field = 'bt_trade_cnt'")
def field_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field of some instruments, whose first build has wrong values, built anew over their whole history; their other fields, which
    stay wrong, are left out here."""
    base, trades, cal = paths.fresh_path(spark, "rebuild"), _trades(spark, sf_dir), days(spark, sf_dir)
    some = lambda c: F.regexp_extract(c, "[0-9]+", 0).cast("int") % 9 == 0
    wrong = trades.unionByName(trades.where(some("ts_code") & (F.col("vol") > 10)))
    made = lambda table: {"block_trade": export.Export(table, BLOCK, _amounts(trades))}
    export.run(spark, made(wrong), cal, f"{base}/state", f"{base}/vectors", F.lit(NOW))
    only = trades.where(some("ts_code")).select(codes.instrument("ts_code").alias("instrument"))
    export.rebuild_field(spark, made(trades), "bt_trade_cnt", cal, f"{base}/state", f"{base}/vectors", F.lit(NOW), only)
    return _written(spark, f"{base}/vectors").where(~some("instrument") | (F.col("field") == "bt_trade_cnt"))


@query(f"""WITH {BARS} SELECT 'before' AS phase, {INST_OF.format('inst')} AS instrument, count(*) AS row_count FROM bars GROUP BY inst""")
def reset_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state before and after a reset: all rows before it, none after, and no vectors left."""
    base, trades = paths.fresh_path(spark, "reset"), _trades(spark, sf_dir)
    far = days(spark, sf_dir).unionByName(spark.sql("SELECT DATE '2100-01-01' AS d"))  # every row has a slot
    export.run(spark, {"block_trade": export.Export(trades, BLOCK, _amounts(trades)[:1])}, far, f"{base}/state", f"{base}/vectors", F.lit(NOW))
    state = lambda phase: export.read_state(spark, f"{base}/state").select(F.lit(phase).alias("phase"), "instrument", "row_count")
    before = paths.stage(state("before"), "before")
    export.reset(spark, f"{base}/state", f"{base}/vectors")
    left = spark.createDataFrame([("vectors", None, 1)] if daybin.manifest(f"{base}/vectors") else [], before.schema)
    return before.unionByName(state("after")).unionByName(left)


@query(f"""WITH {BARS}, marks AS (SELECT inst, CASE WHEN inst % 2 = 0 THEN DATE '1998-06-30' ELSE DATE '1998-07-19' END AS mark FROM bars GROUP BY inst)
           SELECT {CODE_OF.format('b.inst')} AS ts_code, d AS trade_date, l_extendedprice AS price, l_tax AS amount FROM bars b JOIN marks m ON m.inst = b.inst WHERE d > mark""")
def bounded_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows of a table partitioned by month: the least mark bounds the partitions and row groups that are read."""
    own = _load(spark, sf_dir, paths.fresh_path(spark, "bounded"), "0001-01-01", "9999-12-31")
    mark = F.when(F.substring("ts_code", 1, 6).cast("int") % 2 == 0, F.lit("1998-06-30")).otherwise(F.lit("1998-07-19")).cast("date")
    marks = _trades(spark, sf_dir).select(F.col("ts_code").alias("code"), mark.alias("last_date")).distinct()
    return own.after(marks).select("ts_code", "trade_date", "price", "amount")


@query(f"""WITH {COVER}, e AS (SELECT table_name, count(DISTINCT period) AS n FROM rows GROUP BY 1)
           SELECT 'covered' AS report, table_name, NULL AS code, NULL::DATE AS d, n_days AS n, n_missing AS of FROM cover
           UNION ALL SELECT 'missing', t.table_name, NULL, cal.d, NULL, NULL FROM cal, (SELECT DISTINCT table_name FROM rows) t WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE r.table_name = t.table_name AND r.d = cal.d)
           UNION ALL SELECT 'thin', table_name, code, NULL, count(DISTINCT period), any_value(n) FROM rows JOIN e USING (table_name) GROUP BY table_name, code HAVING any_value(n) > 12 AND count(DISTINCT period) < 0.05 * any_value(n)""")
def calendar_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage, missing days and thin codes of all tables from one set of bitmaps, stored and read back."""
    cal = days(spark, sf_dir)
    marks = paths.stage(quality.bitmaps(_rows(spark, sf_dir), cal), "bitmaps")
    none, day = F.lit(None).cast("string").alias("code"), F.lit(None).cast("date").alias("d")
    covered = quality.covered(marks, cal).select(F.lit("covered").alias("report"), "table_name", none, day, F.col("n_days").alias("n"), F.col("n_missing").alias("of"))
    missing = quality.uncovered(marks, cal).select(F.lit("missing").alias("report"), "table_name", none, "d", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("of"))
    thin = quality.thin_marks(marks, 0.05).select(F.lit("thin").alias("report"), "table_name", "code", day, F.col("n_periods").alias("n"), F.col("n_periods_expected").alias("of"))
    return covered.unionByName(missing).unionByName(thin)


@query("""WITH o AS (SELECT o_orderpriority AS table_name, CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey FROM orders)
          SELECT table_name, year, count(DISTINCT o_custkey) AS n FROM o GROUP BY ALL UNION ALL SELECT table_name, NULL, count(DISTINCT o_custkey) FROM o GROUP BY ALL""")
def distinct_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct codes of each table by year and in all, united from bitmaps that are stored for each month."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("table_name"), F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_custkey")
    marks = paths.stage(quality.distinct_marks(o, ["table_name", "month"], "o_custkey"), "distinct").withColumn("year", F.substring("month", 1, 4).cast("int"))
    by_year = quality.distinct_counts(marks, ["table_name", "year"])
    return by_year.unionByName(quality.distinct_counts(marks, ["table_name"]).withColumn("year", F.lit(None).cast("int")))


# --- files ---------------------------------------------------------------------------------------------------

VECTORS = f"{SLOTTED}, {TOPS}, long AS (SELECT CAST(inst AS VARCHAR) AS instrument, 'q' AS field, CAST(cal_idx AS BIGINT) AS cal_idx, CAST(CAST(q AS REAL) AS DOUBLE) AS value FROM tops UNION ALL SELECT CAST(inst AS VARCHAR), 'p', cal_idx, CAST(CAST(p AS REAL) AS DOUBLE) FROM tops WHERE p IS NOT NULL)"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths.stage(_tops(spark, sf_dir).select(F.col("inst").cast("string").alias("instrument"), "cal_idx", "q", "p"), "slots")


def _read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return daybin.read(spark, path).where("value IS NOT NULL").select("instrument", "field", "cal_idx", F.col("value").cast("double").alias("value"))


@query(f"WITH {VECTORS} SELECT * FROM long")
def daybin_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = paths.fresh_path(spark, "vectors")
    daybin.write(_vectors(spark, sf_dir), ["q", "p"], path)
    return _read_vectors(spark, path)


@query(f"WITH {VECTORS} SELECT * FROM long")
def daybin_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the days first, then all: only what is new is appended."""
    path, slots = paths.fresh_path(spark, "vectors"), _vectors(spark, sf_dir)
    daybin.write(slots.where("cal_idx < 900"), ["q", "p"], path)
    daybin.write(slots, ["q", "p"], path, mode="append")
    return _read_vectors(spark, path)


@query(f"""WITH {DATES}, {BARS}, {MEMBERS} SELECT 'calendar' AS file, NULL AS name, d AS start, d AS "end", count(*) AS n FROM cal GROUP BY ALL UNION ALL
           SELECT 'instruments', CAST(inst AS VARCHAR), min(d), max(d), 1 FROM bars GROUP BY inst UNION ALL SELECT 'index ' || index_code, con_code, start, "end", count(*) FROM periods GROUP BY ALL""")
def text_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar, instrument and constituent lists, written and read back, row by row."""
    base = paths.fresh_path(spark, "lists")
    text.write_calendar(days(spark, sf_dir), f"{base}/calendar")
    ranges = instruments.date_ranges(bars(spark, sf_dir), ["inst"], "d").select(F.col("inst").cast("string").alias("instrument"), F.col("first_date").alias("start"), F.col("last_date").alias("end"))
    text.write_instruments(ranges, f"{base}/instruments")
    text.write_constituents(_constituents(spark, sf_dir).withColumnRenamed("con_code", "instrument"), f"{base}/indices")
    days_ = text.read_calendar(spark, f"{base}/calendar").select(F.lit("calendar").alias("file"), F.lit(None).cast("string").alias("name"), F.col("d").alias("start"), F.col("d").alias("end"))
    lists = text.read_ranges(spark, f"{base}/instruments").select(F.lit("instruments").alias("file"), F.col("instrument").alias("name"), "start", "end")
    index = text.read_ranges(spark, f"{base}/indices", index=True).select(F.concat(F.lit("index "), "index_code").alias("file"), F.col("instrument").alias("name"), "start", "end")
    return days_.unionByName(lists).unionByName(index).groupBy("file", "name", "start", "end").agg(F.count("*").alias("n"))


CATEGORY = """CASE name WHEN 'bd_close' THEN 'OHLCV' WHEN 'vwap' THEN 'OHLCV' WHEN 'pe_ttm' THEN 'valuation' WHEN 'turnover_rate' THEN 'liquidity' WHEN 'mf_buy_sm_vol' THEN 'moneyflow'
              WHEN 'md_rzye' THEN 'margin' WHEN 'mg_rqyl' THEN 'margin' WHEN 'cyq_winner_rate' THEN 'chip' WHEN 'sl_up_limit' THEN 'event' WHEN 'gz_on' THEN 'macro' WHEN 'bb_undp' THEN 'fundamental' ELSE 'technical' END"""


@query(f"""WITH {NAMES} SELECT name, source_table, {CATEGORY} AS category, CASE inst_type WHEN 'cb' THEN 'convertible_bond' WHEN 'market' THEN 'market_virtual' ELSE inst_type END AS applies_to,
           CASE source_table WHEN 'stk_factor_pro' THEN 'hfq' WHEN 'cb_factor_pro' THEN 'bfq' ELSE 'none' END AS adjustment, count(*) AS n FROM names GROUP BY ALL""")
def manifest_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature manifest, a JSON line per field, written and read back whole."""
    path = paths.fresh_path(spark, "manifest")
    text.write_manifest(_names(spark, sf_dir), path)
    back = spark.read.schema("name string, source_table string, category string, applies_to string, adjustment string").json(path)
    return back.groupBy(*back.columns).agg(F.count("*").alias("n"))


@query(f"""WITH {DATES}, {NAMES}, c AS (SELECT CASE name WHEN 'bd_close' THEN 'OHLCV' WHEN 'vwap' THEN 'OHLCV' WHEN 'pe_ttm' THEN 'valuation' WHEN 'turnover_rate' THEN 'liquidity' WHEN 'mf_buy_sm_vol' THEN 'moneyflow'
           WHEN 'md_rzye' THEN 'margin' WHEN 'mg_rqyl' THEN 'margin' WHEN 'cyq_winner_rate' THEN 'chip' WHEN 'sl_up_limit' THEN 'event' WHEN 'gz_on' THEN 'macro' WHEN 'bb_undp' THEN 'fundamental' ELSE 'technical' END AS category,
           count(*) AS n_fields FROM names GROUP BY 1)
           SELECT (SELECT min(d) FROM cal) AS start, (SELECT max(d) FROM cal) AS "end", (SELECT count(*) FROM cal) AS n_days, (SELECT CAST(sum(n_fields) AS BIGINT) FROM c) AS n_total, category, n_fields FROM c""")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's totals, written and read back: a row for each category with the calendar's range."""
    path = paths.fresh_path(spark, "manifest")
    text.write_manifest(_names(spark, sf_dir), path, days(spark, sf_dir))
    back = spark.read.schema("start date, end date, n_days bigint, categories map<string,bigint>, n_fields bigint").json(f"{path}_totals")
    return back.select("start", "end", "n_days", F.col("n_fields").alias("n_total"), F.explode("categories").alias("category", "n_fields"))


@query("""SELECT event_id, upper(substr(sha256('{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}'), 1, 16)) AS batch FROM events""")
def batch_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", codes.batch_id(F.struct("event_type", "user_id")).alias("batch"))


# These four once ran on some instruments only, and on all under these names, which stay.
for _name in ("dense_align", "trim_bounds", "daybin_roundtrip", "daybin_append"):
    QUERIES[f"{_name}_all"], SQL[f"{_name}_all"] = QUERIES[_name], SQL[_name]
