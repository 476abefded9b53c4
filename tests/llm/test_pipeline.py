"""The pipeline's stages on documents with every odd case, and on the smallest tables against the operators' own rules."""

from __future__ import annotations

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from pyspark.sql import functions as F  # noqa: E402

from tapeline.llm import minhash, mixing  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_000, None, "en", None, 0), (10_001, "", None, "s", 0), (10_002, "12 34", "en", "s", 5), (10_003, "ab " * 50_000, None, None, None)], docs.schema)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id = 0").first()["text"]
    leak = spark.createDataFrame([(10_004, "Then she said: " + item, "en", "s", 1)], docs.schema)
    now, out = docs.unionByName(odd).unionByName(leak).cache(), []
    for name, f in corpus_pipeline.STAGES:
        after = f(spark, now, SF).cache()
        out.append((name, now, after))
        now = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order_and_columns(steps):
    assert list(steps) == ["language", "near_dedup", "decontamination", "mixing", "sharding"]
    for before, after in list(steps.values())[:-1]:
        assert before.columns == after.columns


def test_language_rejects_only_what_has_none(steps):
    before, after = steps["language"]
    gone = set(ids(before)) - set(ids(after))
    assert {10_000, 10_001, 10_002} <= gone and len(gone) <= 4


def test_one_of_each_group_stays(steps):
    """Groups are those of five-word shingles at a similarity of 0.8, as for every stage on word shingles."""
    before, after = steps["near_dedup"]
    sets = {r["doc_id"]: minhash.shingles((r["text"] or "").encode()) for r in before.collect()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and minhash.jaccard(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert ids(after) == sorted({find(d) for d in sets}) and len(ids(after)) < len(sets)


def test_leaks_go(steps):
    before, after = steps["decontamination"]
    assert 10_004 in ids(before) and 10_004 not in ids(after)


def test_mixing_repeats_and_thins_whole_rows(steps):
    before, after = steps["mixing"]
    assert set(ids(after)) <= set(ids(before))
    assert after.subtract(before).count() == 0


def test_sharding_places_every_row(steps):
    before, after = steps["sharding"]
    assert ids(before) == ids(after)
    rows = after.select("shard", "slot").collect()
    assert len({tuple(r) for r in rows}) == len(rows) and {r["shard"] for r in rows} <= set(range(24))


def test_empty_documents(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        now = f(spark, now, SF)
    assert now.count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "shard", "slot"} <= set(out.columns) and out.count() > 100


def test_mixing_null_and_repeated_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    rows = [(i // 3 if i < 90 else None, f"{'the house' if i % 2 else 'das haus'} number {i}", "en" if i % 2 else "de", "s", 1) for i in range(100)]
    before = spark.createDataFrame(rows, docs.schema)
    rates = before.select("doc_id", F.lit(1.0).alias("rate"))
    assert sorted(map(str, mixing.draw(before, rates).collect())) == sorted(map(str, before.collect()))
    twice = mixing.draw(before, rates.withColumn("rate", F.lit(2.0)))
    assert sorted(map(str, twice.collect())) == sorted(2 * [str(r) for r in before.collect()])
    out = corpus_pipeline.mixed(spark, before, SF)
    assert out.subtract(before).count() == 0 and 50 < out.count() < 200


def test_repeated_rows_and_ids_through_all_stages(spark):
    """Equal rows are one document and stay as often as they came; rows of one id with different texts are told apart."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.where("text IS NOT NULL AND n_chars > 400").orderBy("doc_id").limit(6).collect()
    new = [(50_000, some[0]["text"] + " and more", "en", "s", 1)] * 3 + [(50_001, r["text"][::-1], r["lang"], "s", 1) for r in some[1:3]] + [(None, some[3]["text"][:300], "en", "s", 1)] * 2
    now = spark.createDataFrame(new, docs.schema)
    n = {}
    for name, f in corpus_pipeline.STAGES[:3]:
        now = f(spark, now, SF)
        n[name] = now.count()
    assert n["near_dedup"] == n["language"]  # nothing is a near-duplicate of another document here
    kept = now.collect()
    rates = now.select("doc_id", F.lit(1.0).alias("rate"))
    assert sorted(map(str, mixing.draw(now, rates).collect())) == sorted(map(str, kept))
    placed = corpus_pipeline.sharded(spark, now, SF).collect()
    assert len(placed) == len(kept)
