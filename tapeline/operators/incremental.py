"""Incremental builds: what each instrument needs, and the state that says so."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.operators.upsert import upsert

STATE_KEY = ["instrument", "source_table"]


def missing_fields(desired: Column, synced: Column) -> Column:
    """Fields that are wanted and not there yet."""
    return F.array_except(desired, F.coalesce(synced, F.array().cast("array<string>")))


def is_synced(desired: Column, synced: Column, status: Column) -> Column:
    """Whether a state row is done and has all wanted fields."""
    return F.coalesce((status == "done") & (F.size(missing_fields(desired, synced)) == 0), F.lit(False))


def with_status(state: DataFrame, *status: str) -> DataFrame:
    return state.where(F.col("status").isin(*status))


def history(source: DataFrame, state: DataFrame) -> DataFrame:
    """For each instrument of each table of ``source(instrument, source_table, date)``: first and last date, all rows, and rows up
    to its own mark in that table."""
    marks = state.select(*STATE_KEY, "last_date")
    return source.join(marks, STATE_KEY, "left").groupBy(*STATE_KEY).agg(
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.count("*").alias("n_rows"), F.count_if(F.col("date") <= F.col("last_date")).alias("n_history"))


def counted_history(counts: DataFrame, state: DataFrame, end: date | None = None) -> DataFrame:
    """:func:`history` from monthly counts (:mod:`rollup`), of days up to ``end``; instruments without such days have no rows."""
    days = F.transform(F.map_entries("per_day"), lambda x: F.struct(F.make_date(F.substring("month", 1, 4).cast("int"), F.substring("month", 5, 2).cast("int"), x["key"]).alias("date"), x["value"].alias("n")))
    own = F.filter(days, lambda x: x["date"] <= F.lit(end)) if end else days
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    marks = state.select(*STATE_KEY, "last_date")
    rows = counts.select(*STATE_KEY, own.alias("days")).where(F.size("days") > 0).join(marks, STATE_KEY, "left")
    until = total(F.filter("days", lambda x: x["date"] <= F.col("last_date")))
    return rows.groupBy(*STATE_KEY).agg(
        F.min(F.array_min("days")["date"]).alias("first_seen"), F.max(F.array_max("days")["date"]).alias("last_seen"), F.sum(total("days")).alias("n_rows"), F.sum(until).alias("n_history"))


def decide(instruments: DataFrame, state: DataFrame, source: DataFrame, desired: Sequence[str]) -> DataFrame:
    """``(instrument, source_table, action, reason, added)`` with one action for each wanted ``(instrument, source_table)``.

    ``new``: never done. ``rebuild``: no mark, an earlier first date than before, or more rows up to the mark than were
    written, whether the table aggregates or not, as rows are counted before aggregation. ``backfill``: fields were added.
    ``tail``: rows after the mark. ``none``: nothing to do. A rebuild covers added fields and the tail; a backfill comes
    with the tail. An instrument's state in one table says nothing about another.
    """
    return decide_seen(instruments, state, history(source, state), desired)


def decide_seen(instruments: DataFrame, state: DataFrame, seen: DataFrame, desired: Sequence[str]) -> DataFrame:
    """:func:`decide` from a history that is counted already."""
    return _decided(instruments.select(*STATE_KEY).distinct(), state, seen, desired).select(*STATE_KEY, "action", "reason", F.array_join("added", ",").alias("added"))


def _decided(wanted: DataFrame, state: DataFrame, seen: DataFrame, desired: Sequence[str]) -> DataFrame:
    """``wanted`` with the state's and the history's columns, ``action``, ``reason`` and ``added``."""
    rows = wanted.join(state.where("status = 'done'"), STATE_KEY, "left").join(seen, STATE_KEY, "left")
    added = missing_fields(F.array(*map(F.lit, desired)), F.col("fields"))
    reason = (
        F.when(F.col("status").isNull(), F.lit(None).cast("string")).when(F.col("last_date").isNull(), "no mark")
        .when(F.col("first_seen") < F.col("first_date"), "earlier start").when(F.col("n_history") > F.col("row_count"), "grown history")
    )
    tail = F.coalesce(F.col("last_seen") > F.col("last_date"), F.lit(False))
    action = F.when(F.col("status").isNull(), "new").when(F.col("reason").isNotNull(), "rebuild").when(F.size("added") > 0, "backfill").when(tail, "tail").otherwise("none")
    return rows.withColumns({"reason": reason, "added": added}).withColumn("action", action)


def tail_rows(source: DataFrame, state: DataFrame) -> DataFrame:
    """Rows after their instrument's mark in their table."""
    marks = state.where("status = 'done'").select(*STATE_KEY, "last_date")
    return source.join(marks, STATE_KEY).where(F.col("date") > F.col("last_date")).select(*source.columns)


def merge_state(state: DataFrame, new: DataFrame) -> DataFrame:
    """State rows replaced by instrument and table; the latest of several new rows counts."""
    return upsert(state, new, STATE_KEY, [F.desc("updated_at")])


def advance(state: DataFrame, tail: DataFrame) -> DataFrame:
    """State after tails were written: marks moved on, row counts added."""
    more = tail.groupBy(*STATE_KEY).agg(F.max("date").alias("new_last"), F.count("*").alias("n_new"))
    out = state.join(more, STATE_KEY, "left")
    return out.withColumn("last_date", F.greatest("last_date", "new_last")).withColumn("row_count", F.col("row_count") + F.coalesce("n_new", F.lit(0))).select(*state.columns)


def totals(state: DataFrame, desired: Sequence[str]) -> DataFrame:
    """For each source table: instruments, those that are synced, and those pending."""
    ok = is_synced(F.array(*map(F.lit, desired)), F.col("fields"), F.col("status"))
    return state.groupBy("source_table").agg(F.count("*").alias("n_instruments"), F.count_if(ok).alias("n_synced"), F.count_if(~ok).alias("n_pending"))
