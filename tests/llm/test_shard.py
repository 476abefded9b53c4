from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import replace
from math import log

import pytest
import xxhash
from pyspark.sql import functions as F

from tapeline.llm import shard


def placed(spark, leaves, n=20_000):
    return {r["id"]: r["s"] for r in spark.range(n).select("id", shard.place(F.col("id"), leaves).alias("s")).collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    out = shard.shard(spark.range(5000).withColumnRenamed("id", "doc_id"), 24).collect()
    assert {r["grown_shard"] for r in out if r["shard"] != r["grown_shard"]} == {24}
    moved = sum(r["shard"] != r["grown_shard"] for r in out)
    assert 100 < moved < 300


def test_shares_follow_weights(spark):
    leaves = [shard.Leaf(0, "a", "a1", 1), shard.Leaf(1, "a", "a2", 2), shard.Leaf(2, "b", "b1", 3)]
    n = Counter(placed(spark, leaves).values())
    assert all(abs(n[i] / 20_000 - w / 6) < 0.02 for i, w in enumerate((1, 2, 3)))


def test_movement_stays_in_changed_subtrees(spark):
    leaves = shard.topology(24)
    heavier = [replace(x, weight=2.0) if x.shard == 7 else x for x in leaves]
    before, after = placed(spark, leaves), placed(spark, heavier)
    rack = {x.shard: x.rack for x in leaves}
    region = {x.shard: x.region for x in leaves}
    moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
    assert moved and all(region[b] == region[7] for _, b in moved)
    # within the rack only the heavier shard gains
    assert all(b == 7 for a, b in moved if rack[a] == rack[7] == rack[b])


def test_slots_have_no_gap(spark):
    docs = spark.range(3000).selectExpr("id % 700 as doc_id", "id as slot", "id as shard")
    by = defaultdict(list)
    for r in shard.shard(docs, 5, cells=7, grow=False).collect():
        by[r["shard"]].append(r["slot"])
    assert sum(map(len, by.values())) == 3000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_null_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (1, None)], "doc_id bigint, text string")
    out = shard.shard(docs, 3, grow=False).collect()
    assert len(out) == 3 and len({r["shard"] for r in out if r["doc_id"] is None}) == 1
    assert shard.shard(docs.limit(0), 3, grow=False).count() == 0
    assert {r["shard"] for r in shard.shard(docs, 1, grow=False).collect()} == {0}


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(i % 9, i, 2 * i, 3 * i, 4 * i, 5 * i, 6 * i, "x") for i in range(200)], "doc_id bigint, __row int, __cell int, __Base int, __number int, __of int, __at int, SLOT string")
    out = shard.shard(docs, 6, cells=4)
    assert out.columns == [*docs.columns[:-1], "shard", "grown_shard", "slot"]
    rows, by = out.collect(), defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert sorted(tuple(r)[:7] for r in rows) == sorted(tuple(r)[:7] for r in docs.collect())
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def slow_place(key, leaves, seed=0):
    """The tree without Spark: at each level the child of the smallest exponential draw."""

    def draw(name, weight):
        h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), xxhash.xxh64_intdigest(name.encode(), h))
        return -log(((h >> 11) + 0.5) * 2.0**-53) / weight

    for level in ("region", "rack", "shard"):
        nodes = defaultdict(float)
        for x in leaves:
            nodes[getattr(x, level)] += x.weight
        best = min(nodes, key=lambda k: draw(k if level != "shard" else f"shard{k}", nodes[k]))
        leaves = [x for x in leaves if getattr(x, level) == best]
    return leaves[0].shard


def test_against_a_plain_tree(spark):
    leaves = [replace(x, weight=1.0 + x.shard % 3) for x in shard.topology(14)]
    assert placed(spark, leaves, 2_000) == {k: slow_place(k, leaves) for k in range(2_000)}


def test_growth_that_would_move_others_is_an_error(spark):
    docs = spark.range(3000).withColumnRenamed("id", "doc_id")
    for n in (6, 12):
        out = shard.shard(docs, n).collect()
        assert all(r["grown_shard"] in (r["shard"], n) for r in out)
    for n in (1, 7, 23):
        with pytest.raises(ValueError, match="region"):
            shard.shard(docs, n)


def test_rows_of_one_key_are_split(spark):
    docs = spark.range(4000).select(F.lit(None).cast("bigint").alias("doc_id"), F.col("id").cast("string").alias("text"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    out = shard.shard(docs, 24)
    assert sorted(r["slot"] for r in out.collect()) == list(range(4000))
    cell = F.pmod(F.xxhash64(shard._row_hash(docs.select("doc_id", "text")), F.lit("cell")), F.lit(64))
    assert docs.groupBy(cell).count().agg(F.max("count")).first()[0] < 150
