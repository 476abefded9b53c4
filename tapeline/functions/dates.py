"""Date and partition-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c: Column | str) -> Column:
    """The date of a ``yyyyMMdd`` key, of which more characters may follow; null if it isn't one."""
    return F.try_to_timestamp(F.when(F.char_length(_col(c)) >= 8, F.substring(_col(c), 1, 8)), F.lit("yyyyMMdd")).cast("date")


def day_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMdd")


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMM")


def year_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def month_end(c: Column | str) -> Column:
    return F.last_day(_col(c))


def natural_days(start: Column, end: Column) -> Column:
    """All days from start to end, both included, newest first."""
    return F.reverse(F.sequence(start, end))


def load_cutoff(ts: Column | str, cut: str = "20:30", zone: str = "Asia/Shanghai") -> Column:
    """The last date whose data is complete at a UTC instant: the local date from ``cut`` on, the day before until then.

    A ``cut`` that isn't HH:MM counts as 20:30.
    """
    parts = cut.split(":")
    good = len(parts) == 2 and all(p.isdigit() for p in parts) and int(parts[0]) < 24 and int(parts[1]) < 60
    minute = int(parts[0]) * 60 + int(parts[1]) if good else 20 * 60 + 30
    local = F.from_utc_timestamp(_col(ts), zone)
    return F.when(F.hour(local) * 60 + F.minute(local) >= minute, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))


#: Load strategies: how a table is cut into partitions.
STRATEGIES = ("trade_date", "date_range", "freq", "domain", "once")
ONCE = "__once__"


def partition_key(strategy: str, date: Column | None = None, *, freq: Column | None = None, code: Column | None = None, period: Column | None = None) -> Column:
    """The text that names a load partition."""
    if strategy == "trade_date":
        return day_key(date)
    if strategy == "date_range":
        return year_key(date)
    if strategy == "freq":
        return F.concat_ws("_", day_key(date), freq)
    if strategy == "domain":
        period = F.lit(ONCE) if period is None else period
        return F.when(period == ONCE, F.concat(code, period)).otherwise(F.concat_ws("_", code, period))
    return F.lit(ONCE)


def partition_bounds(strategy: Column, key: Column, cutoff: Column) -> tuple[Column, Column]:
    """First and last day to load for a partition that is loaded again; null where there is no bound."""
    head = day(F.substring_index(key, "_", 1))
    year = F.substring(key, 1, 4)
    start = F.when(strategy == "trade_date", day(key)).when(strategy == "date_range", day(F.concat(year, F.lit("0101")))).when(strategy == "freq", head)
    end = F.when(strategy == "trade_date", day(key)).when(strategy == "date_range", day(F.concat(year, F.lit("1231")))).when(strategy == "freq", head).when(strategy == "domain", cutoff)
    return start, end


def refresh_key(strategy: Column, date: Column) -> Column:
    """The log key that a refresh for a day clears."""
    return F.when(strategy == "date_range", year_key(date)).when(strategy == "once", F.lit(ONCE)).otherwise(day_key(date))
