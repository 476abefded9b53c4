"""What is left to load: expected partitions, those that are done, and those due again, as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.catalog import TableSpec
from tapeline.functions import dates
from tapeline.operators.upsert import EMPTY, LOADED, LOG_KEY, forget, retry, stale_empties

FREQUENCIES = ("W", "M")


def expected_by_day(days: DataFrame, table: Column) -> DataFrame:
    """One partition for each day ``d``."""
    return days.select(table.alias("table_name"), dates.partition_key("trade_date", F.col("d")).alias("date_val"), F.col("d").alias("start"), F.col("d").alias("end"))


def expected_by_year(days: DataFrame, table: Column) -> DataFrame:
    """One partition for each year of the days, from its first to its last day."""
    years = days.groupBy(dates.year_key("d").alias("date_val")).agg(F.min(F.trunc("d", "YEAR")).alias("start"))
    return years.select(table.alias("table_name"), "date_val", "start", F.date_sub(F.add_months("start", 12), 1).alias("end"))


def expected_by_frequency(days: DataFrame, table: Column) -> DataFrame:
    """Two partitions, weekly and monthly, for each day."""
    each = days.select("d", F.explode(F.array(*map(F.lit, FREQUENCIES))).alias("freq"))
    return each.select(table.alias("table_name"), dates.partition_key("freq", F.col("d"), freq=F.col("freq")).alias("date_val"), F.col("d").alias("start"), F.col("d").alias("end"))


def periods(days: DataFrame, mode: str) -> DataFrame:
    """``(period, start, end)`` of the days: monthly, yearly, daily, or once."""
    if mode == "once":
        return days.limit(1).select(F.lit(dates.ONCE).alias("period"), F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"))
    key, start, end = {
        "monthly": (dates.month_key("d"), dates.month_start("d"), dates.month_end("d")), "yearly": (dates.year_key("d"), F.trunc("d", "YEAR"), F.date_sub(F.add_months(F.trunc("d", "YEAR"), 12), 1)),
        "daily": (dates.day_key("d"), F.col("d"), F.col("d")),
    }[mode]
    return days.select(key.alias("period"), start.alias("start"), end.alias("end")).distinct()


def expected_by_domain(codes: DataFrame, spans: DataFrame, table: Column) -> DataFrame:
    """Every code of ``codes(code)`` in every period. Periods are those of a calendar, so few; codes needn't be."""
    pairs = codes.select("code").where("code IS NOT NULL AND code <> ''").distinct().crossJoin(F.broadcast(spans))
    return pairs.select(table.alias("table_name"), dates.partition_key("domain", code=F.col("code"), period=F.col("period")).alias("date_val"), "code", "period", "start", "end")


def every_day(start: Column, end: Column, spark: SparkSession) -> DataFrame:
    """``(d)``: all days from start to end, open or not."""
    return spark.range(1).select(F.explode(dates.natural_days(start, end)).alias("d"))


def expected(spec: TableSpec, open_days: DataFrame, all_days: DataFrame, codes: DataFrame | None = None, mode: str = "monthly") -> DataFrame:
    """``(table_name, date_val, start, end)``: the partitions of a table that its strategy in the catalogue asks for.

    ``trade_date`` has one for each open day, or for each day where the table is dated by announcement, as those fall on any
    day; ``date_range`` one for each year, ``freq`` a weekly and a monthly one for each open day, ``domain`` one for each of
    ``codes(code)`` and each period of ``mode``, and ``once`` one in all.
    """
    name = F.lit(spec.name)
    if spec.strategy == "domain":
        if codes is None:
            raise ValueError(f"{spec.name} is loaded by code; give the codes")
        out = expected_by_domain(codes, periods(open_days, mode), name)
    elif spec.strategy == "once":
        out = periods(open_days, "once").select(name.alias("table_name"), F.col("period").alias("date_val"), "start", "end")
    elif spec.strategy == "trade_date":
        out = expected_by_day(all_days if spec.date_col == "ann_date" else open_days, name)
    else:
        out = {"date_range": expected_by_year, "freq": expected_by_frequency}[spec.strategy](open_days, name)
    return out.select("table_name", "date_val", "start", "end")


def work_list(specs: Sequence[TableSpec], open_days: DataFrame, all_days: DataFrame, log: DataFrame, codes: Mapping[str, DataFrame] | None = None, mode: str = "monthly") -> DataFrame:
    """``(table_name, strategy, date_val, start, end)``: all partitions of the catalogue's tables that are still to load.

    Tables by code are asked again for an empty latest period, as it may have been too early. ``codes`` has the codes of each
    table that is loaded by code; the last period of the others follows from their own partitions.
    """
    parts = []
    for spec in specs:
        own = expected(spec, open_days, all_days, (codes or {}).get(spec.name), mode)
        if spec.strategy == "domain":
            own = pending_domain(own.withColumn("period", F.substring_index("date_val", "_", -1)), log)
        else:
            own = pending(own, log)
        parts.append(own.select("table_name", F.lit(spec.strategy).alias("strategy"), "date_val", "start", "end"))
    return reduce(DataFrame.unionByName, parts)


def pending(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Expected partitions that aren't logged as loaded or empty."""
    done = log.where(F.col("ok").isin(LOADED, EMPTY)).select(*LOG_KEY)
    return expected.join(done, LOG_KEY, "left_anti")


def pending_domain(expected: DataFrame, log: DataFrame) -> DataFrame:
    """As :func:`pending`, but in a table's latest period only loaded counts as done, as empty may have been too early."""
    last = F.max("period").over(Window.partitionBy("table_name"))
    marked = expected.withColumn("latest", (F.col("period") == last) & (F.col("period") != dates.ONCE))
    state = log.select(*LOG_KEY, "ok")
    done = (F.col("ok") == LOADED) | ((F.col("ok") == EMPTY) & ~F.col("latest"))
    return marked.join(state, LOG_KEY, "left").where(~F.coalesce(done, F.lit(False))).select(*expected.columns)


def daily_start(tables: DataFrame, rows: DataFrame, since: Column, target: Column) -> DataFrame:
    """Where each table's daily load begins: ``since`` if it is empty, else its last date, again; tables at the target are left out."""
    last = rows.groupBy("table_name").agg(F.max("d").alias("last"))
    return tables.select("table_name").distinct().join(last, "table_name", "left").where(F.col("last").isNull() | (F.col("last") < target)).select("table_name", F.coalesce("last", since).alias("start"))


def always_again(log: DataFrame, year: str) -> DataFrame:
    """Keys that a daily load clears first: the running year, and full snapshots."""
    return log.where(F.col("date_val").isin(year, dates.ONCE)).select(*LOG_KEY)


def daily(
    specs: Sequence[TableSpec], open_days: DataFrame, all_days: DataFrame, log: DataFrame, rows: DataFrame, since: date, target: date, now: Column,
    codes: Mapping[str, DataFrame] | None = None, mode: str = "monthly",
) -> tuple[DataFrame, DataFrame]:
    """A daily load: ``(table_name, strategy, date_val, start, end, reason)``, each partition once, and the log that it starts from.

    ``due``: what isn't loaded from each table's last date in ``rows(table_name, d)`` on, that day again, up to ``target``; tables that are there
    already ask for nothing, and tables without rows start at ``since``. The running year, and full snapshots, are forgotten first.
    Tables by code ask for every period, as their last date says nothing of new codes. ``stale``: days that were empty a week ago or
    before, of tables by day; they are forgotten, as are stale ones of other tables, which are due when those are planned again.
    ``retry``: failed partitions of known tables that aren't given up (:func:`upsert.retry`), with their counts moved on. Of several reasons the
    first counts.
    """
    spark = log.sparkSession
    table = spark.createDataFrame([(s.name, s.strategy) for s in specs], "table_name string, strategy string")  # the catalogue's
    first = daily_start(table, rows, F.lit(since), F.lit(target))
    year = first.join(table.where("strategy = 'date_range'"), "table_name").select("table_name", F.lit(f"{target:%Y}").alias("date_val"))
    whole = table.where("strategy = 'once'").select("table_name", F.lit(dates.ONCE).alias("date_val"))
    stale = stale_empties(log, now).select(*LOG_KEY)
    retried = retry(log, table, now)
    left = forget(forget(retried.drop("again"), year.unionByName(whole)), stale)

    bound = first.select("table_name", F.col("start").alias("__from"))
    parts = {s.name: expected(s, open_days, all_days, (codes or {}).get(s.name), mode).withColumn("strategy", F.lit(s.strategy)) for s in specs}
    asked = reduce(DataFrame.unionByName, parts.values())
    dated = asked.where("strategy NOT IN ('domain', 'once')").join(bound, "table_name").where((F.col("end") >= F.col("__from")) & (F.col("start") <= F.lit(target))).drop("__from")
    by_code = asked.where("strategy = 'domain'").withColumn("period", F.substring_index("date_val", "_", -1))
    due = pending(dated.unionByName(asked.where("strategy = 'once'")), left).unionByName(pending_domain(by_code, left).drop("period"))
    again = asked.where("strategy = 'trade_date'").join(stale, LOG_KEY, "left_semi")
    failed = asked.join(retried.where("again").select(*LOG_KEY), LOG_KEY, "left_semi")
    ranked = reduce(DataFrame.unionByName, [df.withColumn("reason", F.struct(F.lit(k).alias("k"), F.lit(name).alias("name"))) for k, (name, df) in enumerate((("due", due), ("stale", again), ("retry", failed)))])
    work = ranked.groupBy("table_name", "strategy", "date_val", "start", "end").agg(F.min("reason")["name"].alias("reason"))
    return work, left


def refresh(specs: Sequence[TableSpec], open_days: DataFrame, all_days: DataFrame, log: DataFrame, asked: DataFrame, codes: Mapping[str, DataFrame] | None = None, mode: str = "monthly") -> tuple[DataFrame, DataFrame]:
    """Single days ``asked(table_name, d)`` loaded again: the work list of their partitions alone, and the log without them.

    A day asks for its year's partition in tables by year, for the one there is in snapshots, for all codes' partitions of its period in
    tables by code, and else for its own. Days that no partition has ask for nothing.
    """
    found = []
    for s in specs:
        own = expected(s, open_days, all_days, (codes or {}).get(s.name), mode)
        days = asked.where(F.col("table_name") == s.name).select(F.col("d"))
        hit = F.lit(True) if s.strategy == "once" else F.coalesce((F.col("d") >= F.col("start")) & (F.col("d") <= F.col("end")), F.lit(mode == "once"))
        found.append(own.join(F.broadcast(days), hit, "left_semi").select("table_name", F.lit(s.strategy).alias("strategy"), "date_val", "start", "end"))  # days that somebody names
    work = reduce(DataFrame.unionByName, found)
    return work, forget(log, work.select(*LOG_KEY))


def stale_ranges(stale: DataFrame) -> DataFrame:
    """First, last and number of stale days for each table."""
    return stale.groupBy("table_name").agg(F.min("date_val").alias("first_val"), F.max("date_val").alias("last_val"), F.count("*").alias("n"))


def preview(parts: dict[str, DataFrame], log: DataFrame) -> DataFrame:
    """What a load would do: partitions, and those still to load, for each table and strategy; ``parts`` has expected partitions by strategy."""
    out = None
    for strategy, expected in parts.items():
        own = expected.select(*LOG_KEY).withColumn("strategy", F.lit(strategy))
        out = own if out is None else out.unionByName(own)
    done = log.where(F.col("ok").isin(LOADED, EMPTY)).select(*LOG_KEY, F.lit(1).alias("done"))
    return out.join(done, LOG_KEY, "left").groupBy("table_name", "strategy").agg(F.count("*").alias("n_expected"), F.count_if(F.col("done").isNull()).alias("n_pending"))
