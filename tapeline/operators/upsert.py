"""Merging batches into tables: keyed upsert, replacement of partitions and snapshots, and the load log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def known_columns(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The batch's columns that the table has, in the table's order."""
    return batch.select(*[c for c in columns if c in batch.columns])


def drop_empty(batch: DataFrame, key: Sequence[str] = (), keep_null_key: bool = False) -> DataFrame:
    """Without rows that are null throughout and, unless ``keep_null_key``, without rows that lack a part of the key."""
    out = batch.na.drop(how="all")
    return out if keep_null_key or not key else out.na.drop(subset=list(key))


def _keyed(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in key])


def latest(batch: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key the row that comes first in ``order``; all columns stay. Rows that lack a part of the key are out."""
    ranked = batch.where(_keyed(key)).withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("__n = 1").drop("__n")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column], null_keys: bool = False) -> DataFrame:
    """Rows of ``new`` replace those of the same key, whole: columns that ``new`` lacks become null.

    Of several new rows of a key the first in ``order`` wins. Rows of ``new`` that lack a part of the key are left out. With
    ``null_keys`` they come in, all of them, as no two of them have a key in common; but one that equals an old row in all
    columns that both tables have is there already, so a repeated batch changes nothing. Both sides are dealt by the key once.
    """
    fresh = latest(new, key, order)
    out = old.join(fresh.select(*key), list(key), "left_anti").unionByName(fresh, allowMissingColumns=True)
    if not null_keys:
        return out
    common = [c for c in old.columns if c in new.columns]
    have = old.where(~_keyed(key)).select(*[F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(common)])
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"__o{i}")) for i, c in enumerate(common)])
    return out.unionByName(new.where(~_keyed(key)).join(have, same, "left_anti"), allowMissingColumns=True)


def replace_partitions(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of ``new``, and those of ``old`` whose key ``new`` doesn't have."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def write_partitions(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Overwrite the partitions that ``df`` has rows of, and no other. Stage ``df`` first if it reads from ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Delete partitions of the table at ``path``; those that aren't there are no error."""
    for v in values:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={v}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def replace_snapshot(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Put ``df``, which may read from ``path``, in the place of the table there. It is written whole beside the old one, which goes
    last, so that a failed write leaves the old table; a failed swap puts it back."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    place = spark._jvm.org.apache.hadoop.fs.Path
    new, now, old = place(f"{path}_new-{mark}"), place(path), place(f"{path}_old-{mark}")
    (df.write.partitionBy(*partition) if partition else df.write).parquet(new.toString())
    disk = now.getFileSystem(spark._jsc.hadoopConfiguration())
    there = disk.exists(now)
    if there and not disk.rename(now, old):
        raise OSError(f"{path} can't be moved aside")
    if not disk.rename(new, now):
        if there:
            disk.rename(old, now)
        raise OSError(f"{path} can't be put in place")
    disk.delete(old, True)


#: States of a load: failed, has rows, has none, given up.
FAILED, LOADED, EMPTY, ABANDONED = 0, 1, 2, 3
MAX_RETRIES = 5
LOG_KEY = ["table_name", "date_val"]


def merge_log(log: DataFrame, results: DataFrame) -> DataFrame:
    """The log with results ``(table_name, date_val, ok, last_try)`` merged in; retry counts stay. Another state than 0 to 3 is an error.

    Of several results of a partition the latest counts, and of those of one instant the highest state.
    """
    new = results.groupBy(*LOG_KEY).agg(F.max(F.struct("last_try", "ok")).alias("r")).select(*LOG_KEY, F.col("r.ok").alias("new_ok"), F.col("r.last_try").alias("new_try"))
    ok = F.coalesce("new_ok", "ok")
    checked = F.when(ok.isin(FAILED, LOADED, EMPTY, ABANDONED), ok).otherwise(F.raise_error(F.concat(F.lit("no such state: "), F.coalesce(ok.cast("string"), F.lit("null")))).cast("int"))
    return log.join(new, LOG_KEY, "full").select(*LOG_KEY, checked.alias("ok"), F.coalesce("retry_count", F.lit(0)).alias("retry_count"), F.coalesce("new_try", "last_try").alias("last_try"))


def result_states(asked: DataFrame, landed: DataFrame, rejected: DataFrame, now: Column) -> DataFrame:
    """States of the partitions ``asked(table_name, date_val)``: rejected is failed, rows are loaded, no row is empty."""
    rows = landed.groupBy(*LOG_KEY).agg(F.count("*").alias("n"))
    bad = rejected.select(*LOG_KEY).distinct().withColumn("bad", F.lit(True))
    state = F.when(F.coalesce("bad", F.lit(False)), FAILED).when(F.coalesce("n", F.lit(0)) > 0, LOADED).otherwise(EMPTY)
    return asked.join(rows, LOG_KEY, "left").join(bad, LOG_KEY, "left").select(*LOG_KEY, state.alias("ok"), now.alias("last_try"))


def retry(log: DataFrame, tables: DataFrame, now: Column) -> DataFrame:
    """Failed partitions of known tables: given up after MAX_RETRIES, else counted and due again (``again``)."""
    due = (F.col("ok") == FAILED) & F.col("known")
    spent = due & (F.col("retry_count") >= MAX_RETRIES)
    again = due & ~spent
    known = tables.select("table_name").distinct().withColumn("known", F.lit(True))
    rows = log.join(known, "table_name", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return rows.select(*LOG_KEY, F.when(spent, ABANDONED).otherwise(F.col("ok")).alias("ok"), F.when(again, F.col("retry_count") + 1).otherwise(F.col("retry_count")).alias("retry_count"),
                       F.when(again, now).otherwise(F.col("last_try")).alias("last_try"), again.alias("again"))


def stale_empties(log: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Partitions that were empty and haven't been asked for in ``days`` days: they are asked for again."""
    return log.where((F.col("ok") == EMPTY) & (F.col("last_try") < now - F.expr(f"INTERVAL {days} DAYS")))


def forget(log: DataFrame, keys: DataFrame) -> DataFrame:
    """The log without the given ``(table_name, date_val)``."""
    return log.join(keys, LOG_KEY, "left_anti")


def purge_unknown(log: DataFrame, tables: DataFrame) -> DataFrame:
    return log.join(tables.select("table_name").distinct(), "table_name", "left_semi")
