"""Landed vendor payloads: parsing, page stitching and shard union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD = "code int, msg string, data struct<fields: array<string>, items: array<array<string>>>"


def parse_payloads(df: DataFrame, text: str = "payload") -> DataFrame:
    """``df`` with ``code``, ``msg``, ``data`` of the JSON in ``text``, and ``reject``, the reason a payload can't be used, or null.

    A code other than 0, a body without data, a field name that is null or occurs twice, and an item that doesn't fit the
    fields are errors. No items is a valid, empty result. A payload is parsed once: what follows is computed inside one
    function of the parsed value, which the optimiser can't take apart.
    """

    def judged(p: Column) -> Column:
        code, fields, items = p["code"], p["data"]["fields"], p["data"]["items"]
        misfit = F.exists(F.coalesce(items, F.array().cast("array<array<string>>")), lambda i: i.isNull() | (F.size(i) != F.size(fields)))
        reject = (
            F.when(p.isNull() | code.isNull(), "malformed").when(code != 0, F.concat(F.lit("code "), code.cast("string")))
            .when(fields.isNull() | items.isNull(), "no data").when(F.exists(fields, lambda f: f.isNull()) | (F.size(F.array_distinct(fields)) < F.size(fields)), "field names").when(misfit, "item length")
        )
        return F.struct(code.alias("code"), p["msg"].alias("msg"), p["data"].alias("data"), reject.alias("reject"))

    one = F.transform(F.array(F.from_json(text, PAYLOAD)), judged)
    return df.select(*df.columns, F.inline(one))


def payload_rows(parsed: DataFrame, columns: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per item of good payloads, with the given columns and types; a value of another type is null, an unknown field dropped.

    Where a field stands is looked up once a payload.
    """
    rows = parsed.where("reject IS NULL").select(*keep, F.array(*[F.array_position("data.fields", F.lit(c)).cast("int") for c in columns]).alias("__at"), F.posexplode("data.items").alias("row_no", "__i"))
    value = lambda k: F.get("__i", F.nullif(F.get("__at", F.lit(k)), F.lit(0)) - 1)
    return rows.select(*keep, "row_no", *[value(k).try_cast(t).alias(c) for k, (c, t) in enumerate(columns.items())])


def stitch_pages(pages: DataFrame, keys: list[str], max_rows: int, first: Column) -> DataFrame:
    """Pages ``(keys, page_no, n_rows)`` to keep, with ``failed`` on a request whose first page is an error.

    Pages count up to the first that is short, that included, and before the first that is an error (``status``), is empty
    or begins with the same row as page 0 (``first``), as servers that ignore the offset repeat it.
    """
    zero = pages.where("page_no = 0").select(*keys, first.alias("__first0"))
    marked = pages.withColumn("__first", first).join(zero, keys, "left")
    again = (F.col("page_no") > 0) & F.col("__first").eqNullSafe(F.col("__first0"))
    stop = F.min(F.when((F.col("status") != "ok") | (F.col("n_rows") == 0) | again, F.col("page_no")))
    short = F.min(F.when(F.col("n_rows") < max_rows, F.col("page_no")))
    ends = marked.groupBy(*keys).agg(stop.alias("__stop"), short.alias("__short"), F.max((F.col("page_no") == 0) & (F.col("status") != "ok")).alias("failed"))
    far = F.lit(2**31 - 1)
    kept = marked.join(ends, keys).where((F.col("page_no") < F.coalesce("__stop", far)) & (F.col("page_no") <= F.coalesce("__short", far)) | ((F.col("page_no") == 0) & F.col("failed")))
    return kept.drop("__first", "__first0", "__stop", "__short")


def union_shards(parts: list[DataFrame]) -> DataFrame:
    """Shards of one table as one; columns that a shard lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
