"""Instrument lists and index membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import codes

#: Days between two membership dates up to which a period goes on.
GAP = 40


def date_ranges(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """First and last date of each key; of the whole table without keys."""
    return df.groupBy(*keys).agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def master(lists: dict[str, DataFrame], bars: DataFrame, virtual: dict[str, DataFrame]) -> DataFrame:
    """``(instrument, kind, start, end)``: all listed codes by kind, virtual instruments, and stocks known by their bars alone.

    ``lists`` has ``(code, start, end)`` by kind, ``bars`` ``(code, date)``, ``virtual`` ``(date)`` by instrument. Blank
    codes are left out, missing bounds get defaults.
    """
    parts = [df.where(codes.present("code")).select(codes.instrument("code", kind).alias("instrument"), F.lit(kind).alias("kind"), "start", "end") for kind, df in lists.items()]
    parts += [date_ranges(df, [], "date").select(F.lit(name).alias("instrument"), F.lit("market").alias("kind"), F.col("first_date").alias("start"), F.col("last_date").alias("end")) for name, df in virtual.items()]
    known = reduce(DataFrame.unionByName, parts)
    traded = date_ranges(bars.where(codes.present("code") & codes.listed_suffix("code")), ["code"], "date")
    seen = traded.select(codes.instrument("code").alias("instrument"), F.lit("stock").alias("kind"), F.col("first_date").alias("start"), F.col("last_date").alias("end"))
    start, end = codes.listed_range(F.col("start"), F.col("end"))
    return known.unionByName(seen.join(known, "instrument", "left_anti")).select("instrument", "kind", start.alias("start"), end.alias("end"))


def for_table(all_instruments: DataFrame, kind: str, virtual: str | None = None) -> DataFrame:
    """The instruments of a table: the virtual one of a market table, else all of its kind."""
    own = F.col("instrument") == virtual if virtual else F.col("kind") == kind
    return all_instruments.where(own).select("instrument").distinct()


def constituents(members: DataFrame, gap: int = GAP) -> DataFrame:
    """Membership periods ``(index_code, con_code, start, end)`` from dated lists.

    Dates of a member more than ``gap`` days apart belong to different periods; repeated dates change nothing. A period that ends on its index's last
    date is open, so its end is the default.
    """
    rows = members.select("index_code", "con_code", "date").where("date IS NOT NULL")
    by_member = Window.partitionBy("index_code", "con_code").orderBy("date")
    opens: Column = F.coalesce(F.datediff("date", F.lag("date").over(by_member)) > gap, F.lit(True))
    numbered = rows.withColumn("opens", opens.cast("int")).withColumn("period", F.sum("opens").over(by_member.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = numbered.groupBy("index_code", "con_code", "period").agg(F.min("date").alias("start"), F.max("date").alias("last"))
    # a row for each index: few
    latest = rows.groupBy("index_code").agg(F.max("date").alias("latest"))
    end = F.when(F.col("last") == F.col("latest"), F.lit(codes.RANGE_END).cast("date")).otherwise(F.col("last"))
    return spans.join(F.broadcast(latest), "index_code").select("index_code", "con_code", "start", end.alias("end"))
