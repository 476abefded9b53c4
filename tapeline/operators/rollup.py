"""Monthly counts of a table by instrument, kept beside it, so that decisions about exports don't read its history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions import dates
from tapeline.operators import upsert

KEY = ["source_table", "instrument", "code"]
SCHEMA = "instrument string, code string, n_rows bigint, first_seen date, last_seen date, per_day map<int,bigint>, source_table string, month string"


def month_counts(rows: DataFrame) -> DataFrame:
    """``(instrument, code, n_rows, first_seen, last_seen, per_day, source_table, month)`` of ``rows(instrument, source_table, code, date)``.

    ``per_day`` counts by day of the month, so that counts up to any date are exact. Counts of different months add up; rows
    without a date have none. Rows are dealt once, by instrument and month; days and months are counted where they lie.
    """
    dealt = rows.where("date IS NOT NULL").withColumn("month", dates.month_key("date")).repartition("instrument", "code", "month")
    daily = dealt.groupBy(*KEY, "month", "date").agg(F.count("*").alias("n"))
    per_day = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.dayofmonth("date").alias("day"), "n"))))  # 31 days at most
    out = daily.groupBy(*KEY, "month").agg(F.sum("n").alias("n_rows"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), per_day.alias("per_day"))
    return out.select(*[c.split()[0] for c in SCHEMA.split(", ")])


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def refresh(rows: DataFrame, months: Sequence[str], path: str, source_table: str) -> None:
    """Count ``rows`` of the given months of a table anew, in place of what is stored for those months; other months stay.

    ``rows`` need have those months only. Months that have no row any more have no counts either.
    """
    upsert.write_partitions(month_counts(rows), path, ["source_table", "month"])
    found = {r["month"] for r in read(rows.sparkSession, path).where((F.col("source_table") == source_table) & F.col("month").isin(*months)).select("month").distinct().collect()}
    have = {r["month"] for r in rows.select(dates.month_key("date").alias("month")).distinct().collect()}  # months: few
    upsert.drop_partitions(rows.sparkSession, f"{path}/source_table={source_table}", "month", sorted(found - have))
