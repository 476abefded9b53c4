"""Exports of tables as day vectors that build what is new, rebuild what changed and append the rest."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog import ExportSpec, FieldDef
from tapeline.functions import codes
from tapeline.operators import calendar, features, incremental, upsert
from tapeline.operators.incremental import STATE_KEY
from tapeline.sources import daybin, paths

STATE = (
    "instrument string, source_table string, last_date date, first_date date, fields array<string>, row_count bigint, status string, updated_at timestamp, "
    "slot_from date, slot_values map<string,double>"
)


@dataclass(frozen=True)
class Export:
    """A table's rows, and what is exported of them.

    ``month``: a partition column that has the date's month as ``yyyyMM``, so that late rows are read from late partitions
    only. ``counts``: the table's monthly counts (:mod:`rollup`), so that decisions don't read the table.
    """

    table: DataFrame
    spec: ExportSpec
    fields: tuple[FieldDef, ...]
    month: str | None = None
    counts: DataFrame | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def priced(self) -> set[str]:
        return {f.name for f in self.fields if f.computed == "vwap"}

    def rows(self, source_table: str) -> DataFrame:
        """``(instrument, source_table, code, date)`` of the rows that the export reads."""
        own = features.source_rows(self.table, self.spec, [])
        return own.select(codes.instrument("code", self.spec.inst_type).alias("instrument"), F.lit(source_table).alias("source_table"), "code", "date")

    def between(self, first: object, last: object = None) -> DataFrame:
        """Rows of the table from ``first`` to ``last``. Bounds are values, so that they reach partitions and row groups of the scan."""
        rows = self.table
        for bound, above in ((first, True), (last, False)):
            if bound is not None:
                day = F.lit(bound).cast("date")
                rows = rows.where(F.col(self.spec.date_col) >= day if above else F.col(self.spec.date_col) <= day)
                if self.month:
                    key = F.lit(f"{bound:%Y%m}")
                    rows = rows.where(F.col(self.month) >= key if above else F.col(self.month) <= key)
        return rows

    def after(self, marks: DataFrame) -> DataFrame:
        """Rows of the table after the mark of their code in ``marks(code, last_date)``. Nothing before the least mark is read."""
        least = marks.agg(F.min("last_date")).first()[0]
        code = F.lit(self.spec.virtual) if self.spec.virtual else F.col(self.spec.inst_col)
        held = marks.select(F.col("code").alias("__code"), F.col("last_date").alias("__mark"))
        rows = self.between(least).withColumn("__own", code).join(held, F.col("__own") == F.col("__code"))
        return rows.where(F.col(self.spec.date_col) > F.col("__mark")).drop("__own", "__code", "__mark")


def _exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state at ``path``; no rows where there is none yet."""
    return spark.read.schema(STATE).parquet(path) if _exists(spark, path) else spark.createDataFrame([], STATE)


def _save(state: DataFrame, path: str) -> None:
    """A row for each instrument and table, swapped in whole: a failed write leaves the old state."""
    columns = state.sparkSession.createDataFrame([], STATE).columns
    upsert.replace_snapshot(state.select(*columns).coalesce(1), path)


def plan(exports: Mapping[str, Export], state: DataFrame, days: DataFrame) -> DataFrame:
    """``(instrument, source_table, code, action, reason, added, first_seen, last_seen, n_rows, last_date, slot_idx, slot_values, slot_from)`` of all exports, written.

    Rows after the calendar's last open day have no slot yet, so they don't count: they are late rows of a run that knows their slot.
    Late rows go on from the mark's slot; where the calendar has another first day for that slot than when it was written, its
    values don't stand for it any more, and the instrument is rebuilt. ``slot_from`` is that of the last row seen.
    """
    end = days.agg(F.max("d")).first()[0]
    of_day = F.broadcast(calendar.slot_map(days))
    parts = []
    for name, export in exports.items():
        if export.counts is None:
            rows = export.rows(name).where(F.col("date") <= F.lit(end))
            seen = incremental.history(rows, state)
            named = rows.groupBy(*STATE_KEY).agg(F.min("code").alias("code"))
        else:
            own = export.counts.where(F.col("source_table") == name)
            seen = incremental.counted_history(own, state, end)
            named = own.groupBy(*STATE_KEY).agg(F.min("code").alias("code"))
        parts.append(incremental._decided(named, state, seen.where("n_rows > 0"), export.names).where("n_rows > 0"))
    decided = reduce(DataFrame.unionByName, parts)
    at_mark = of_day.select(F.col("nat_date").alias("last_date"), F.col("cal_idx").alias("slot_idx"), F.col("slot_from").alias("mark_from"))
    at_end = of_day.select(F.col("nat_date").alias("last_seen"), F.col("slot_from").alias("now_from"))
    placed = decided.join(at_mark, "last_date", "left").join(at_end, "last_seen", "left")
    lost = (F.col("action") == "tail") | ((F.col("action") == "backfill") & (F.col("last_seen") > F.col("last_date")))
    lost &= ~F.col("slot_from").eqNullSafe(F.col("mark_from"))
    out = placed.withColumns({"reason": F.when(lost, "slot changed").otherwise(F.col("reason")), "action": F.when(lost, "rebuild").otherwise(F.col("action"))})
    return paths.stage(out.select(*STATE_KEY, "code", "action", "reason", "added", "first_seen", "last_seen", "n_rows", "last_date", "slot_idx", "slot_values", F.col("now_from").alias("slot_from")), "plan")


def _remap(spark: SparkSession, exports: Mapping[str, Export], state: DataFrame, old: DataFrame, days: DataFrame, out: str, notes: dict) -> None:
    """Move all vectors to the positions of a changed calendar.

    Old values are gathered at their new positions. Tables are read only for the days of slots that no old slots make up, and
    for prices where slots were merged, as those don't follow from the slots' prices. One write has both and the new calendar.
    """
    kept, dated = calendar.moves(old, days)
    found = kept.collect()  # days of a calendar
    changed = dated.collect()
    merged, cut = {r["new_idx"] for r in changed if r["merged"]}, {r["new_idx"] for r in changed if not r["merged"]}
    priced = set().union(*[e.priced for e in exports.values()])
    parts = [daybin.remapped(spark, out, {r["old_idx"]: r["new_idx"] for r in found}, dict.fromkeys(priced, merged))]
    for name, export in exports.items():
        anew = [r["nat_date"] for r in changed if not r["merged"] or export.priced]
        if not anew:
            continue
        rows = export.between(min(anew), max(anew)).join(F.broadcast(dated.select("nat_date")), F.col(export.spec.date_col) == F.col("nat_date"), "left_semi")
        have = state.where((F.col("source_table") == name) & (F.col("status") == "done")).select("instrument", F.explode("fields").alias("field"))
        built = features.build(rows, export.spec, export.fields, days)
        long = built.select("instrument", "cal_idx", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in export.names])).alias("x")).select("instrument", "x.field", "cal_idx", "x.value")
        wanted = F.col("cal_idx").isin(*cut) if cut else F.lit(False)
        wanted |= F.col("cal_idx").isin(*merged) & F.col("field").isin(*export.priced) if merged and export.priced else F.lit(False)
        parts.append(long.where(wanted & F.col("value").isNotNull()).join(have, ["instrument", "field"], "left_semi"))
    moved = paths.stage(reduce(DataFrame.unionByName, [p.select("instrument", "field", F.col("cal_idx").cast("long").alias("cal_idx"), F.col("value").cast("double").alias("value")) for p in parts]), "moved")
    daybin.write_long(moved, out, "overwrite", notes=notes)
    paths.drop_staged(moved)


def _same_calendar(spark: SparkSession, exports: Mapping[str, Export], days: DataFrame, state_path: str, out: str) -> dict:
    """Bring the vectors at ``out`` to the calendar, and keep that for the next run. Returns the notes of writes to come."""
    notes, base = {"calendar": calendar.digest(days)}, daybin.manifest(out)
    at = lambda h: f"{state_path}_calendars/{h}"
    if not _exists(spark, at(notes["calendar"])):
        upsert.replace_snapshot(days.select("d").distinct().coalesce(1), at(notes["calendar"]))
    known = base["notes"].get("calendar") if base else None
    if known and known != notes["calendar"]:
        old = spark.read.schema("d date").parquet(at(known))
        if not calendar.changed_days(old, days).isEmpty():  # more days at the end change nothing
            _remap(spark, exports, read_state(spark, state_path), old, days, out, notes)
    return notes


def run(spark: SparkSession, exports: Mapping[str, Export], days: DataFrame, state_path: str, out: str, now: Column) -> DataFrame:
    """Bring the vectors at ``out`` and the state at ``state_path`` up to the tables and the calendar; returns what was decided.

    Vectors of another calendar are moved to this one's positions first. New and changed instruments are built over their whole
    history and their files replaced, added fields likewise; rows after an instrument's mark are built alone and merged in. The state
    carries what the last written slot has, so late rows that fall into that slot complete it and don't replace it. All
    instruments of a table with the same need are built by one job. Before a table's files are touched its instruments are marked
    ``partial``, after it ``done``, or ``error`` where a vector can't be written, and the others go on; all but ``done`` count as new in the
    next run. Each table has its own state and its own fields.
    """
    out = paths.located(spark, out)
    notes = _same_calendar(spark, exports, days, state_path, out)
    decided = plan(exports, read_state(spark, state_path), days)
    for name, export in exports.items():
        own = decided.where((F.col("source_table") == name) & (F.col("action") != "none"))
        if own.isEmpty():
            continue
        names, spec, staged = F.array(*map(F.lit, export.names)), export.spec, []
        columns = [*STATE_KEY, F.col("last_seen").alias("last_date"), F.col("first_seen").alias("first_date"), names.alias("fields"), F.col("n_rows").alias("row_count"), now.cast("timestamp").alias("updated_at"), "slot_from"]
        _save(incremental.merge_state(read_state(spark, state_path), own.select(*columns, F.lit("partial").alias("status"))), state_path)
        values, rejects = [], []

        def put(found: DataFrame, fields: list[FieldDef], mode: str) -> None:
            held = paths.stage(found, "slots")
            staged.append(held)  # noqa: B023
            daybin.write(features.finish(held, spec, fields), [f.name for f in fields], out, mode=mode, notes=notes)  # noqa: B023
            values.append(features.last_slot(held))  # noqa: B023
            bad = paths.stage(daybin.rejects(spark, out), "rejects")  # a later write may drop the version that has them
            staged.append(bad)  # noqa: B023
            rejects.append(bad.select("instrument"))  # noqa: B023

        whole = own.where("action IN ('new', 'rebuild')")
        if not whole.isEmpty():
            put(features.slots(export.table, spec, export.fields, days, whole), list(export.fields), "replace")
        late = own.where("action IN ('tail', 'backfill') AND last_seen > last_date")
        if not late.isEmpty():
            put(features.fold(features.slots(export.after(late), spec, export.fields, days), late), list(export.fields), "merge")
        kinds = own.where("action = 'backfill'").select("added").distinct().collect()  # sets of added fields: as many as versions of the table
        for kind in kinds:
            fields = [f for f in export.fields if f.name in kind["added"]]
            some = own.where((F.col("action") == "backfill") & (F.col("added") == F.array(*map(F.lit, kind["added"]))))
            put(features.slots(export.table, spec, fields, days, some), fields, "replace")

        # what was carried, then what later steps know better, name by name
        known = own.where("action = 'backfill'").select("code", F.lit(0).alias("step"), F.explode("slot_values").alias("name", "value")) if kinds else None
        steps = [v.select("code", F.lit(k).alias("step"), F.explode("slot_values").alias("name", "value")) for k, v in enumerate(values, 1)]
        carried = reduce(DataFrame.unionByName, steps if known is None else [known, *steps]).groupBy("code", "name").agg(F.max_by("value", "step").alias("value"))
        maps = carried.groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("slot_values"))  # a table's fields at most
        bad = reduce(DataFrame.unionByName, rejects).distinct().withColumn("bad", F.lit(True))
        ended = own.drop("slot_values").join(maps, "code", "left").join(bad, "instrument", "left")
        _save(incremental.merge_state(read_state(spark, state_path), ended.select(*columns, F.when(F.col("bad"), "error").otherwise("done").alias("status"), "slot_values")), state_path)
        for done in staged:
            paths.drop_staged(done)
    return decided


def rebuild_field(spark: SparkSession, exports: Mapping[str, Export], field: str, days: DataFrame, state_path: str, out: str, now: Column, only: DataFrame | None = None) -> DataFrame:
    """Build one field anew in all tables that have it, of all instruments or of those in ``only(instrument)``.

    The field is taken out of the state first, so that it counts as added: its files are replaced over the whole history, and go
    where nothing is left. A failure leaves it to be built by the next run. What else is due is done too. Returns what was decided.
    """
    with_it = {name: e for name, e in exports.items() if field in e.names}
    if not with_it:
        raise ValueError(f"no table has the field {field}")
    state = read_state(spark, state_path)
    hit = F.col("source_table").isin(*with_it)
    if only is not None:
        state = state.join(only.select("instrument").distinct().withColumn("__hit", F.lit(True)), "instrument", "left")
        hit &= F.coalesce("__hit", F.lit(False))
    _save(state.withColumn("fields", F.when(hit, F.array_remove("fields", field)).otherwise(F.col("fields"))), state_path)
    return run(spark, with_it, days, state_path, out, now)


def reset(spark: SparkSession, state_path: str, out: str) -> None:
    """Forget all state and delete all vectors, so that the next run builds everything."""
    for path in (state_path, f"{state_path}_calendars", out):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def summary(decided: DataFrame) -> DataFrame:
    """``(source_table, action, n_instruments, n_rows)``: what a run would write, or wrote, and what it skips (``none``)."""
    return decided.groupBy("source_table", "action").agg(F.count("*").alias("n_instruments"), F.sum("n_rows").alias("n_rows"))
