"""Landed payload files as a stream that merges itself into a table: each file is read once, and a repeated batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tapeline.catalog import ExportSpec, TableSpec
from tapeline.functions import dates
from tapeline.operators import export, rollup, upsert
from tapeline.sources import landing, paths

MONTH = "month"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {MONTH} string").parquet(path) if _exists(spark, path) else spark.createDataFrame([], f"{schema}, {MONTH} string")


def merge_batch(batch: DataFrame, spec: TableSpec, path: str, schema: str, counts: tuple[str, ExportSpec] | None = None) -> None:
    """Merge rows into the table at ``path``, partitioned by the month of its date; only months that the batch touches are rewritten.

    Keyed tables take the last row of a key by ``seq``; where the specification keeps rows without a whole key, all of them are
    kept that aren't there yet. Tables with a replace key, by which a batch brings whole days or
    codes, lose what the batch brings anew. Where the key has no date, a row may stand in any month: ``<path>_keys`` says in which, and
    months that lose their last row go. A batch that failed midway is merged again with the same result. ``counts`` has a
    path and an export whose monthly counts (:mod:`rollup`) are kept there.
    """
    spark = batch.sparkSession
    rows = upsert.drop_empty(batch, spec.key, spec.keep_null_key)
    month = F.coalesce(dates.month_key(spec.date_col) if spec.date_col else F.lit(None), F.lit("none"))
    new = paths.stage(rows.withColumn(MONTH, month), "batch")
    key = list(spec.key or ((spec.replace_key,) if spec.replace_key else ()))
    roams = bool(key) and bool(spec.date_col) and spec.date_col not in key
    keys = f"{path}_keys"
    touched = new.select(MONTH)
    if roams:
        stands = _table(spark, keys, ", ".join(c for c in schema.split(", ") if c.split()[0] in key))
        touched = touched.unionByName(stands.join(new.select(*key).distinct(), key, "left_semi").select(MONTH))
    months = sorted(r[MONTH] for r in touched.distinct().collect())  # months: few
    if not months:
        return paths.drop_staged(new)
    # a month that isn't stored has no rows to merge with, so it is written as it comes; a key that roams may have left any month
    stored = months if roams else [m for m in months if _exists(spark, f"{path}/{MONTH}={m}")]
    old = _table(spark, path, schema).where(F.col(MONTH).isin(*stored))

    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        if spec.key:
            return upsert.upsert(old, new, key, [F.desc("seq")], spec.keep_null_key).drop("seq")
        return (upsert.replace_partitions(old, new, key) if spec.replace_key else new).drop("seq")

    out = paths.stage(merged(old, new.where(F.col(MONTH).isin(*stored))), "merged")  # the table isn't overwritten while it is read
    upsert.write_partitions(out, path, [MONTH])
    if len(stored) < len(months):
        upsert.write_partitions(merged(old.limit(0), new.where(~F.col(MONTH).isin(*stored))), path, [MONTH])
    gone = sorted(set(stored) - {r[MONTH] for r in out.select(MONTH).distinct().collect()})
    upsert.drop_partitions(spark, path, MONTH, gone)
    if counts:
        own = export.Export(_table(spark, path, schema).where(F.col(MONTH).isin(*months)), counts[1], ())
        rollup.refresh(own.rows(spec.name), months, counts[0], spec.name)
    if roams:  # last, so that a batch that failed finds where its keys stood
        upsert.write_partitions(out.select(*key, MONTH).distinct(), keys, [MONTH])
        upsert.drop_partitions(spark, keys, MONTH, gone)
    for done in (new, out):
        paths.drop_staged(done)


def ingest(spark: SparkSession, landed: str, table: str, rejects: str, spec: TableSpec, columns: dict[str, str], checkpoint: str, counts: tuple[str, ExportSpec] | None = None) -> StreamingQuery:
    """Start a stream over payload files, a JSON payload per line, that runs until all files there are merged.

    ``columns`` are the table's, with types; dates come as ``yyyyMMdd``. Payloads that can't be used go to ``rejects``,
    with the reason. ``counts`` are kept as in :func:`merge_batch`.
    """
    schema = ", ".join(f"{c} {t}" for c, t in columns.items())
    read = {c: "string" if t == "date" else t for c, t in columns.items()}

    def merge(batch: DataFrame, number: int) -> None:
        parsed = landing.parse_payloads(batch, "value")
        bad = parsed.where("reject IS NOT NULL").select("value", "reject", F.lit(number).alias("batch"))
        upsert.write_partitions(bad, rejects, ["batch"])
        rows = landing.payload_rows(parsed, read, ("file_time", "value"))
        typed = rows.withColumns({c: dates.day(c) for c, t in columns.items() if t == "date"}).withColumn("seq", F.struct("file_time", "value", "row_no"))
        merge_batch(typed.select(*columns, "seq"), spec, table, schema, counts)

    files = spark.readStream.text(landed).select("value", F.col("_metadata.file_modification_time").alias("file_time"))
    return files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
