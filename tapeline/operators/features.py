"""From tables to features: aggregation by instrument and day, alignment to calendar slots, and the full build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.catalog import TABLES, ExportSpec, FieldDef, depends_on
from tapeline.functions import codes
from tapeline.operators.calendar import to_slots

#: Fields that one aggregation takes; more are aggregated in groups. From so many on, rows ordered by several columns share a sorted window.
WIDE = 12
GROUP = 16


def since(df: DataFrame, date_col: str, bound: Column | str | None, default: Column | None = None) -> DataFrame:
    """Rows from ``bound`` on. None takes the default; an empty text takes no bound."""
    if isinstance(bound, str) and bound == "":
        return df
    bound = default if bound is None else F.lit(bound) if isinstance(bound, str) else bound
    return df if bound is None else df.where(F.col(date_col) >= bound.cast("date"))


def source_rows(df: DataFrame, spec: ExportSpec, fields: Sequence[FieldDef]) -> DataFrame:
    """``(code, date, ...)`` of all instruments at once: predicate, virtual instrument and the columns the fields read."""
    rows = df.where(F.expr(spec.predicate)) if spec.predicate else df
    code = F.lit(spec.virtual) if spec.virtual else F.col(spec.inst_col)
    return rows.select(code.alias("code"), F.col(spec.date_col).alias("date"), *depends_on(spec, list(fields))).where(F.col("date").isNotNull() & codes.present("code"))


def split_by_type(df: DataFrame, keys: Sequence[str], type_col: str) -> DataFrame:
    """Flags ``type_SH`` and ``type_SZ``, and ``count`` of all rows, for each key."""
    kind = codes.link_type(type_col)
    flag = lambda v: F.max(F.when(kind == v, 1).otherwise(0))
    return df.groupBy(*keys).agg(flag("SH").alias("type_SH"), flag("SZ").alias("type_SZ"), F.count("*").alias("count"))


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Mean weighted by absolute weights, nulls as 0; null unless the weights sum to more than 0."""
    zero = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0))
    w = F.abs(zero(weight))
    return F.when(F.sum(w) > 0, F.sum(zero(value) * w) / F.sum(w))


def sum_count(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], weighted: Mapping[str, tuple[str, str]] | None = None, count: str = "count") -> DataFrame:
    """Sums (nulls as 0, so 0 if all are null), weighted means and the number of rows for each key."""
    aggs = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(out) for out, c in sums.items()]
    aggs += [weighted_mean(v, w).alias(out) for out, (v, w) in (weighted or {}).items()]
    return df.groupBy(*keys).agg(*aggs, F.count("*").alias(count))


def last_in_slot(df: DataFrame, keys: Sequence[str], fields: Sequence[str] | Mapping[str, Column], order: Sequence[str]) -> DataFrame:
    """For each key, none of which is null, and field the last value that isn't null, in the order of the ``order`` columns.

    Ordered by one plain column, values are aggregated in hash tables, before the shuffle first; many fields in groups, each of
    which reads its own columns only, and whose results lie by the same keys, so that they join where they are. Ordered by several
    columns, few fields are aggregated and many take one window whose sort they share. Rows equal in ``order`` have no defined last.

    ``fields`` may be expressions by new names. Where a window takes them they are computed after the rows are dealt and sorted, so
    what is shuffled and sorted are the columns that they read, and a task streams the rest.
    """
    made = fields if isinstance(fields, Mapping) else {}
    fields = list(fields)
    if len(order) == 1 or len(fields) < WIDE:
        df = df.withColumns(dict(made)) if made else df
        place = F.struct(*order) if len(order) > 1 else F.col(order[0])
        size = GROUP if len(order) == 1 else max(1, len(fields))
        groups = [fields[k : k + size] for k in range(0, max(1, len(fields)), size)]
        parts = [df.groupBy(*keys).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), place)).alias(f) for f in own]) if own else df.select(*keys).distinct() for own in groups]
        return reduce(lambda a, b: a.join(b, list(keys)), parts)
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, *order)
    dealt = dealt.withColumns(dict(made)) if made else dealt
    marked = dealt.select(*keys, *[F.last(f, ignorenulls=True).over(whole).alias(f) for f in fields], F.row_number().over(w).alias("__n"))
    return marked.where("__n = 1").drop("__n")


def densify(slots: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """A row for every slot between a key's first and last, null where there was none.

    Each slot makes the rows up to the key's next one, so the slots are dealt once and joined with nothing.
    """
    after = F.lead("cal_idx").over(Window.partitionBy(*keys).orderBy("cal_idx")) - 1
    own = slots.select(*keys, F.col("cal_idx").alias("__at"), F.coalesce(after, F.col("cal_idx")).alias("__to"), *fields)
    return own.withColumn("cal_idx", F.explode(F.sequence("__at", "__to"))).select(*keys, "cal_idx", *[F.when(F.col("cal_idx") == F.col("__at"), F.col(f)).alias(f) for f in fields])


def valid_bounds(slots: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``(keys, field, first_idx, last_idx)``: where each field has its first and last value; fields without any have no row."""
    long = slots.select(*keys, "cal_idx", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("v")) for f in fields])).alias("x"))
    return long.where("x.v IS NOT NULL").groupBy(*keys, F.col("x.field").alias("field")).agg(F.min("cal_idx").alias("first_idx"), F.max("cal_idx").alias("last_idx"))


def _daily(rows: DataFrame, spec: ExportSpec, fields: Sequence[FieldDef]) -> DataFrame:
    """One row per instrument and day where the spec aggregates or encodes, named by field; else the rows as they are."""
    keys = ["code", "date"]
    counts = {f.name for f in fields if f.computed == "count"}
    if spec.agg == "split_by_type":
        out = split_by_type(rows, keys, spec.type_col)
        return out.select(*keys, *[F.col(f.computed).cast("double").alias(f.name) for f in fields])
    if spec.agg:
        sums = {f.name: f.column for f in fields if f.column and not f.weight}
        out = sum_count(rows, keys, sums, {f.name: (f.column, f.weight) for f in fields if f.weight}, "__count")
        return out.select(*keys, *[F.col("__count" if f.name in counts else f.name).cast("double").alias(f.name) for f in fields])
    if spec.naming == "encoded":
        return rows.select(*keys, *[codes.st_flag(spec.type_col).cast("double").alias(f.name) for f in fields])
    inputs = {"__amount": "amount", "__vol": "vol"} if any(f.computed == "vwap" for f in fields) else {}
    return rows.select(*keys, *[codes.number(f.column).alias(f.name) for f in fields if not f.computed], *[codes.number(c).alias(n) for n, c in inputs.items()])


def slots(table: DataFrame, spec: ExportSpec, fields: Sequence[FieldDef], days: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(code, cal_idx, ...)``: the last value of each field and slot, of all instruments of a table or of those in ``only(code)``.

    One scan with the columns the fields need; an aggregation where the spec has one; dates forward to the next open day by
    a broadcast map; then the last values. Instruments without a row, and slots without one, have none. Inputs of the
    volume-weighted price come as ``__amount`` and ``__vol``.
    """
    rows = source_rows(table, spec, fields)
    if only is not None:
        rows = rows.join(only.select("code").distinct(), "code", "left_semi")
    daily = _daily(rows, spec, fields)
    names = [c for c in daily.columns if c not in ("code", "date")]
    # after an aggregation, or by the table's key, a day has one row; else rows of a day are told apart by their values, so that the last is the same in every run
    key = TABLES[spec.table].key if spec.table in TABLES else ()
    alone = bool(key) and set(key) <= {spec.date_col, spec.inst_col}
    order = ["date"] if spec.agg or alone else ["date", *names]
    return last_in_slot(to_slots(daily, "date", days), ["code", "cal_idx"], names, order)


def finish(found: DataFrame, spec: ExportSpec, fields: Sequence[FieldDef]) -> DataFrame:
    """Features ``(instrument, code, cal_idx, <fields>)`` of :func:`slots`: the price is computed from its slot's amount and volume."""
    priced = [codes.vwap("__amount", "__vol").cast("double").alias(f.name) for f in fields if f.computed == "vwap"]
    kept = [c for c in found.columns if c not in ("code", "cal_idx") and not c.startswith("__")]
    return found.select(codes.instrument("code", spec.inst_type).alias("instrument"), "code", "cal_idx", *kept, *priced)


def build(table: DataFrame, spec: ExportSpec, fields: Sequence[FieldDef], days: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Features ``(instrument, code, cal_idx, <fields>)`` of all instruments of a table, or of those in ``only(code)``."""
    return finish(slots(table, spec, fields, days, only), spec, fields)


def fold(late: DataFrame, carried: DataFrame) -> DataFrame:
    """Slots of late rows, completed by what was last known of the slot they begin in.

    ``carried(code, slot_idx, slot_values)`` has each instrument's last written slot and the values in it. Rows that fall into that
    slot again are later than those behind the values, so a value that isn't null replaces the carried one, and a null leaves it.
    """
    names = [c for c in late.columns if c not in ("code", "cal_idx")]
    own = late.join(carried.select("code", "slot_idx", "slot_values"), "code", "left")
    same = F.col("cal_idx") == F.col("slot_idx")
    return own.select("code", "cal_idx", *[F.when(same, F.coalesce(F.col(n), F.col("slot_values")[n])).otherwise(F.col(n)).alias(n) for n in names])


def last_slot(found: DataFrame) -> DataFrame:
    """``(code, slot_values)``: what each instrument's last slot has, by name."""
    names = [c for c in found.columns if c not in ("code", "cal_idx")]
    values = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(n).cast("double") for n in names]))
    return found.groupBy("code").agg(F.max_by(values, "cal_idx").alias("slot_values"))
