"""Text files: calendars, instrument lists, constituent lists and the feature manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions import codes


def write_calendar(days: DataFrame, path: str) -> None:
    """One ``yyyy-MM-dd`` per line, in order. A calendar is small, so it is one file."""
    days.select("d").distinct().coalesce(1).sortWithinPartitions("d").select(F.date_format("d", "yyyy-MM-dd").alias("value")).write.mode("overwrite").text(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.try_to_date("value", "yyyy-MM-dd").alias("d")).where("d IS NOT NULL")


def _listed(df: DataFrame) -> DataFrame:
    start, end = codes.listed_range(F.col("start"), F.col("end"))
    return df.withColumns({"start": start, "end": end})


def write_instruments(df: DataFrame, path: str) -> None:
    """Tab-separated instrument, start and end, with the defaults for what is missing; files follow each other in order."""
    _listed(df).select("instrument", "start", "end").orderBy("instrument", "start").write.mode("overwrite").option("sep", "\t").csv(path)


def write_constituents(df: DataFrame, path: str) -> None:
    """A folder per index with tab-separated constituent, start and end, sorted; a large index has several files in order."""
    _listed(df).select("index_code", "instrument", "start", "end").orderBy("index_code", "instrument", "start").write.mode("overwrite").partitionBy("index_code").option("sep", "\t").csv(path)


def read_ranges(spark: SparkSession, path: str, index: bool = False) -> DataFrame:
    """What :func:`write_instruments` wrote, or with ``index`` what :func:`write_constituents` wrote."""
    schema = "instrument string, start date, end date" + (", index_code string" if index else "")
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def manifest(fields: DataFrame) -> DataFrame:
    """Exported fields ``(name, source_table, inst_type)`` with category, instrument type in words and adjustment."""
    return fields.select("name", "source_table", codes.applies_to("inst_type").alias("applies_to"), codes.category("name", "source_table").alias("category"), codes.adjustment("inst_type", "source_table").alias("adjustment"))


def manifest_totals(fields: DataFrame, days: DataFrame) -> DataFrame:
    """One row: first and last day of the calendar, its length, the number of fields and their counts by category."""
    by = category_counts(fields).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n_fields")))).alias("categories"), F.sum("n_fields").alias("n_fields"))  # some ten categories
    return days.agg(F.min("d").alias("start"), F.max("d").alias("end"), F.count("*").alias("n_days")).crossJoin(by)


def write_manifest(fields: DataFrame, path: str, days: DataFrame | None = None) -> None:
    """A JSON line per field in ``path``, and with ``days`` the totals as one more file beside them, ``<path>_totals``."""
    m = manifest(fields)
    m.select(F.to_json(F.struct(*m.columns)).alias("value")).write.mode("overwrite").text(path)
    if days is not None:
        t = manifest_totals(fields, days)
        t.select(F.to_json(F.struct(*t.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}_totals")


def category_counts(fields: DataFrame) -> DataFrame:
    return manifest(fields).groupBy("category").agg(F.count("*").alias("n_fields"))
