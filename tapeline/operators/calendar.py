"""The trading calendar: open days, their positions, and the next open day of any date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def open_days(cal: DataFrame, exchange: str | None = None, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Distinct open days ``d`` of ``cal(exchange, cal_date, is_open)`` within bounds, newest first."""
    days = cal.where("is_open = 1").where(F.col("exchange") == exchange if exchange else F.lit(True))
    days = days.where(F.col("cal_date") >= since) if since is not None else days
    days = days.where(F.col("cal_date") <= until) if until is not None else days
    return days.select(F.col("cal_date").alias("d")).distinct().orderBy(F.desc("d"))


def calendar_index(days: DataFrame) -> DataFrame:
    """``(d, idx)``: position of each open day from 0. The days of a calendar are few, so one task numbers them."""
    return days.select("d", (F.row_number().over(Window.orderBy("d")) - 1).cast("int").alias("idx"))


def previous_open(days: DataFrame) -> DataFrame:
    """``(d, prev)``: the open day before each; null for the first."""
    return days.select("d", F.lag("d").over(Window.orderBy("d")).alias("prev"))


def slot_map(days: DataFrame) -> DataFrame:
    """``(nat_date, cal_idx, slot_from)``: for every natural day the position of the next open day, itself included, and the first day
    that has this position.

    The first open day maps only itself, so earlier days, like those after the last, have no row. A join on nat_date
    replaces a search for the next day.
    """
    first = F.coalesce(F.date_add(F.lag("d").over(Window.orderBy("d")), 1), F.col("d"))
    starts = calendar_index(days).select("d", "idx", first.alias("slot_from"))
    return starts.select(F.explode(F.sequence("slot_from", "d")).alias("nat_date"), F.col("idx").alias("cal_idx"), "slot_from")


def day_map(days: DataFrame) -> DataFrame:
    """``(nat_date, cal_idx)`` of :func:`slot_map`."""
    return slot_map(days).select("nat_date", "cal_idx")


def to_slots(df: DataFrame, date_col: str, days: DataFrame) -> DataFrame:
    """``df`` with ``cal_idx``; rows without a date or a next open day are left out.

    The map has a row for each natural day of the calendar, some ten thousand for decades, so it is broadcast.
    """
    m = F.broadcast(day_map(days))
    return df.join(m, df[date_col] == m["nat_date"]).drop("nat_date")


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Positions ``(idx, old_d, new_d)`` at which an old calendar isn't a prefix of the new one; none if all is well."""
    a, b = calendar_index(old).withColumnRenamed("d", "old_d"), calendar_index(new).withColumnRenamed("d", "new_d")
    return a.join(b, "idx", "left").where(~F.col("old_d").eqNullSafe(F.col("new_d"))).select("idx", "old_d", "new_d")


def digest(days: DataFrame) -> str:
    """A hash of the open days."""
    row = days.select("d").distinct().agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.col("d").cast("string"))), ","), 256).alias("h"))
    return row.first()["h"]


def moves(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What becomes of the slots of a changed calendar: ``(old_idx, new_idx, merged)`` and ``(nat_date, new_idx, merged)``.

    The first has the old slots whose days all have one new slot; several of them may be ``merged`` in it, and then the last value
    of them counts. The second has the days of those new slots that no old slots make up: they take a part of one, or days that had none
    before. What lies after the old calendar's end isn't among them, as nothing is written there yet. With them go the days
    of merged slots. All tables have a row for each natural day of the calendar at most.
    """
    a, b = day_map(old).withColumnRenamed("cal_idx", "old_idx"), day_map(new).withColumnRenamed("cal_idx", "new_idx")
    end = old.agg(F.max("d").alias("end"))
    both = a.join(b, "nat_date", "full").crossJoin(F.broadcast(end)).where(F.col("nat_date") <= F.col("end"))
    of_old = both.where("old_idx IS NOT NULL").groupBy("old_idx").agg(F.count_distinct("new_idx").alias("n"), F.count_if(F.col("new_idx").isNull()).alias("gone"), F.max("new_idx").alias("new_idx"))
    whole = of_old.where("n = 1 AND gone = 0").select("old_idx", F.lit(True).alias("whole"))
    mapped = both.where("new_idx IS NOT NULL").join(whole, "old_idx", "left")
    of_new = mapped.groupBy("new_idx").agg(F.count_if(F.col("whole").isNull()).alias("cut"), (F.count_distinct("old_idx") > 1).alias("merged"))
    kept = of_old.join(whole, "old_idx").join(of_new.where("cut = 0"), "new_idx").select("old_idx", "new_idx", "merged")
    dates = both.where("new_idx IS NOT NULL").join(of_new.where("cut > 0 OR merged"), "new_idx").select("nat_date", "new_idx", (F.col("cut") == 0).alias("merged"))
    return kept, dates
