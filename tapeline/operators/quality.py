"""Coverage of the calendar, gaps, thin codes and the summary of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions import codes
from tapeline.operators.calendar import calendar_index

#: Missing days from which on a table is an issue, exclusive.
GAP_DAYS = 100


def dated_coverage(rows: DataFrame, days: DataFrame) -> DataFrame:
    """``(table_name, n_days, n_open, n_missing, fill, tier)`` of ``rows(table_name, d)`` against open days.

    Days that aren't open don't count, so event tables dated by announcement are low by nature. The calendar is small.
    """
    have = rows.select("table_name", "d").distinct().join(F.broadcast(days.select("d").distinct()), "d", "left_semi").groupBy("table_name").agg(F.count("*").alias("n_days"))
    total = days.select("d").distinct().agg(F.count("*").alias("n_open"))
    names = rows.select("table_name").distinct().join(have, "table_name", "left").crossJoin(F.broadcast(total))  # one row
    n = F.coalesce("n_days", F.lit(0))
    fill = codes.percent(n, F.col("n_open"))
    return names.select("table_name", n.alias("n_days"), "n_open", (F.col("n_open") - n).alias("n_missing"), F.round(fill, 4).alias("fill"), codes.tier(fill).alias("tier"))


def missing_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """``(table_name, d)``: open days of which a table has no row. The names are those of tables, so few."""
    wanted = days.select("d").distinct().crossJoin(F.broadcast(rows.select("table_name").distinct()))
    return wanted.join(rows.select("table_name", "d").distinct(), ["table_name", "d"], "left_anti").select("table_name", "d")


#: Open days or periods in a word of a bitmap.
BITS = 64


def bitmaps(rows: DataFrame, days: DataFrame) -> DataFrame:
    """``(table_name, kind, code, word, bits)``: the open days that a table has (kind ``day``, no code) and the months that each of its codes
    has (kind ``month``), as bits of words, of ``rows(table_name, d, code, period)``, periods as ``yyyyMM``.

    One scan and one shuffle for all reports below: a task ors its bits first, so a row is left for each word. Bitmaps of two
    parts of a table are united by :func:`unite`. Days that aren't open, and rows without a day or period, set no bit.
    """
    at = F.broadcast(calendar_index(days))  # a calendar's days
    month = F.expr("CAST(substr(period, 1, 4) AS INT) * 12 + CAST(substr(period, 5, 2) AS INT) - 1")
    bit = lambda kind, code, n: F.when(n.isNotNull(), F.struct(F.lit(kind).alias("kind"), code.alias("code"), F.floor(n / BITS).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (n % BITS).cast("int")).alias("bits")))
    marks = F.array_compact(F.array(bit("day", F.lit(None).cast("string"), F.col("idx")), bit("month", F.col("code"), F.when(F.col("code").isNotNull(), month))))
    return unite(rows.join(at, "d", "left").select("table_name", F.explode(marks).alias("m")).select("table_name", "m.*"))


def unite(marks: DataFrame) -> DataFrame:
    return marks.groupBy("table_name", "kind", "code", "word").agg(F.bit_or("bits").alias("bits"))


def covered(marks: DataFrame, days: DataFrame) -> DataFrame:
    """:func:`dated_coverage` from bitmaps, of tables that have a bit."""
    n_open = F.broadcast(days.select("d").distinct().agg(F.count("*").alias("n_open")))  # one row
    n = marks.groupBy("table_name").agg(F.coalesce(F.sum(F.when(F.col("kind") == "day", F.bit_count("bits"))), F.lit(0)).alias("n_days")).crossJoin(n_open)
    fill = codes.percent(F.col("n_days"), F.col("n_open"))
    return n.select("table_name", "n_days", "n_open", (F.col("n_open") - F.col("n_days")).alias("n_missing"), F.round(fill, 4).alias("fill"), codes.tier(fill).alias("tier"))


def uncovered(marks: DataFrame, days: DataFrame) -> DataFrame:
    """:func:`missing_days` from bitmaps: the calendar's bits without the table's."""
    index = calendar_index(days)
    word, bit = F.floor(F.col("idx") / BITS), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("idx") % BITS).cast("int"))
    whole = index.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("open"))
    wanted = marks.select("table_name").distinct().crossJoin(F.broadcast(whole))  # names of tables and words of a calendar: few
    have = marks.where("kind = 'day'").select("table_name", "word", "bits")
    gaps = wanted.join(have, ["table_name", "word"], "left").withColumn("gap", F.col("open").bitwiseAND(F.bitwise_not(F.coalesce("bits", F.lit(0).cast("long")))))
    found = gaps.where("gap <> 0").select("table_name", F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.getbit("gap", k) == 1), lambda k: F.col("word") * BITS + k)).alias("idx"))
    return found.join(F.broadcast(index), "idx").select("table_name", "d")


def months_per_code(marks: DataFrame) -> DataFrame:
    """:func:`periods_per_code` from bitmaps."""
    return marks.where("kind = 'month'").groupBy("table_name", "code").agg(F.sum(F.bit_count("bits")).alias("n_periods"))


def thin_marks(marks: DataFrame, share: float = 0.3, least: int = 12) -> DataFrame:
    """:func:`thin_codes` from bitmaps, held against the months that any code of the table has."""
    words = marks.where("kind = 'month'").groupBy("table_name", "word").agg(F.bit_or("bits").alias("bits"))
    expected = words.groupBy("table_name").agg(F.sum(F.bit_count("bits")).alias("n_periods_expected"))
    return months_per_code(marks).join(expected, "table_name").where((F.col("n_periods_expected") > least) & (F.col("n_periods") < share * F.col("n_periods_expected")))


def distinct_marks(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``(keys, bucket, bitmap)``: which values of the whole number ``number`` each part has, exactly. Parts are stored and united later."""
    of = F.col(number).cast("long")
    return rows.where(of.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(of).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(of)).alias("bitmap"))


def distinct_counts(marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n)``: distinct values over all parts with the same ``keys``, from stored bitmaps alone."""
    return marks.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def distinct_sketches(rows: DataFrame, keys: Sequence[str], value: str, precision: int = 12) -> DataFrame:
    """``(keys, sketch)`` for values that are no numbers: a few kilobytes a part, whatever it has. The counts' standard error is
    1.04 / sqrt(2^precision), 1.6 % at 12."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(precision)).alias("sketch"))


def sketched_counts(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def domain_coverage(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """``(table_name, n_codes, n_actual, n_expected, fill, tier, over)``: periods of codes that are there against those expected.

    Actual periods aren't held against the expected ones, so ``fill`` can pass 100; ``over`` says so.
    """
    actual = rows.select("table_name", "code", "period").distinct().groupBy("table_name").agg(F.countDistinct("code").alias("n_codes"), F.count("*").alias("n_actual"))
    fill = codes.percent(F.col("n_actual"), F.col("n_expected"))
    return actual.join(expected, "table_name").select("table_name", "n_codes", "n_actual", "n_expected", F.round(fill, 4).alias("fill"), codes.tier(fill).alias("tier"), (fill > 100).alias("over"))


def periods_per_code(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_name", "code").agg(F.countDistinct("period").alias("n_periods"))


def thin_codes(rows: DataFrame, n_expected: DataFrame, share: float = 0.3, least: int = 12) -> DataFrame:
    """Codes with under ``share`` of the periods, in tables that expect more than ``least``; ``n_expected(table_name, n_periods_expected)``."""
    return periods_per_code(rows).join(n_expected, "table_name").where((F.col("n_periods_expected") > least) & (F.col("n_periods") < share * F.col("n_periods_expected")))


def state_counts(log: DataFrame) -> DataFrame:
    """Partitions of each state for each table."""
    return log.groupBy("table_name").agg(*[F.count_if(F.col("ok") == k).alias(f"ok_{k}") for k in range(4)])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def snapshot_states(counts: DataFrame, log: DataFrame) -> DataFrame:
    """Tables of which only rows are counted: how many, and why there is none."""
    logged = log.groupBy("table_name").agg(F.count("*").alias("n_log"))
    return counts.join(logged, "table_name", "left").select("table_name", "n_rows", codes.emptiness(F.col("n_rows"), F.coalesce("n_log", F.lit(0))).alias("state"))


def issues(log: DataFrame, coverage: DataFrame) -> DataFrame:
    """``(table_name, issue, n)``: failed partitions, and tables with more than GAP_DAYS missing days."""
    failed = log.where("ok = 0").groupBy("table_name").agg(F.count("*").alias("n")).select("table_name", F.lit("failed").alias("issue"), "n")
    return failed.unionByName(coverage.where(F.col("n_missing") > GAP_DAYS).select("table_name", F.lit("gap").alias("issue"), F.col("n_missing").alias("n")))


def summary(coverage: DataFrame) -> DataFrame:
    """Tables of each tier."""
    return coverage.groupBy("tier").agg(F.count("*").alias("n_tables"))


def report(coverage: DataFrame, counts: DataFrame, log: DataFrame) -> DataFrame:
    """A row for each table: what is there, what the calendar misses, and the states of its loads, side by side.

    ``coverage`` is that of :func:`dated_coverage`, of the dated tables; ``counts(table_name, n_rows)`` of all tables.
    """
    states = state_counts(log)
    named = snapshot_states(counts, log).select("table_name", "n_rows", "state")
    out = named.join(coverage.select("table_name", "n_missing", "fill", "tier"), "table_name", "left").join(states, "table_name", "left")
    return out.withColumns({f"ok_{k}": F.coalesce(f"ok_{k}", F.lit(0)) for k in range(4)})


def overall(tables: DataFrame) -> DataFrame:
    """One row over all tables of a :func:`report`: tables, rows, empty and untouched tables, those of each tier, and loads by state."""
    return tables.agg(
        F.count("*").alias("n_tables"), F.sum("n_rows").alias("total_rows"), F.count_if(F.col("state") == "empty").alias("n_empty"), F.count_if(F.col("state") == "untouched").alias("n_untouched"),
        *[F.count_if(F.col("tier") == t).alias(f"n_{t}") for t in ("perfect", "small_gap", "big_gap")], F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"), *[F.sum(f"ok_{k}").alias(f"ok_{k}") for k in range(4)],
    )
