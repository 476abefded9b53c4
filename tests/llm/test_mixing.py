from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeline.llm import mixing

DOCS = "doc_id bigint, text string, lang string, rate string"


def corpus(spark):
    rows = [(i, "the house and the water " * (1 + i % 7), "en", "x") for i in range(60)] + [(100 + i, "das haus und der fluss " * (1 + i % 5), "de", "x") for i in range(30)]
    return spark.createDataFrame([*rows, (200, None, None, None), (201, "", "en", None), (202, "the house das haus", None, None), (0, "the house and", "en", "y")], DOCS)


def totals(out):
    n = out.select("n_tokens", "rate", F.posexplode("p").alias("k", "p")).groupBy("k").agg(F.sum(F.col("rate") * F.col("n_tokens") * F.col("p"))).collect()
    return [x[1] for x in sorted(n)]


def test_totals_match_targets(spark):
    docs = corpus(spark)
    out = mixing.mix(docs, docs, "lang", {"de": 0.5, "en": 0.5}, budget=1000.0)
    assert out.count() == docs.count()
    assert out.where("rate < 0").count() == 0
    assert all(abs(t - 500) < 1 for t in totals(out))


def test_against_plain_least_squares(spark):
    """The same steps over all documents in numpy, and totals that no other nonnegative rates could bring closer."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    n = rng.integers(0, 200, 300)
    members = spark.createDataFrame([(i, int(t), [float(x) for x in own]) for i, (t, own) in enumerate(zip(n, p, strict=True))], "doc_id bigint, n_tokens bigint, p array<double>")
    for weights in ({"a": 0.6, "b": 0.3, "c": 0.1}, {"a": 1.0}):
        out, fit = mixing.fit_rates(members, ["a", "b", "c"], weights)
        target = n.sum() * np.array([weights.get(d, 0.0) for d in "abc"])
        rate, own = np.ones(300), n @ p
        for _ in range(fit.steps):
            rate = np.maximum(0.0, rate - p @ (((rate * n) @ p - target) / own))
        got = np.array([r["rate"] for r in out.orderBy("doc_id").collect()])
        assert np.allclose(got, rate) and np.allclose(list(fit.reached.values()), (rate * n) @ p)
        assert np.allclose(list(fit.target.values()), target) and abs(fit.off - np.abs((rate * n) @ p - target).max() / n.sum()) < 1e-9
        assert fit.off < 1e-3 if len(weights) == 3 else fit.off < 0.2


def test_targets_out_of_reach_are_told(spark):
    members = spark.createDataFrame([(1, 100, [0.5, 0.5]), (2, 50, [0.6, 0.4])], "doc_id bigint, n_tokens bigint, p array<double>")
    with pytest.warns(UserWarning, match="off its targets"):
        out, fit = mixing.fit_rates(members, ["a", "b"], {"b": 1.0})
    assert fit.off > 0.2 and out.where("rate < 0").count() == 0
    with pytest.warns(UserWarning, match="no documents"):
        assert mixing.fit_rates(members, ["a", "b"], {"a": 0.5, "b": 0.5, "z": 1.0})[1].target["b"] == 75.0


def test_too_many_domains(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="lang"):
        mixing.posteriors(docs, docs, "lang")


def test_domain_without_weight_gets_none(spark):
    docs = corpus(spark)
    de, en = totals(mixing.mix(docs, docs, "lang", {"de": 1.0}, budget=300.0))
    assert abs(de - 300) < 15 and en < 15


def test_posteriors_are_soft_and_sum_to_one(spark):
    docs = corpus(spark)
    p, domains = mixing.posteriors(docs, docs, "lang")
    rows = {r["doc_id"]: r["p"] for r in p.collect()}
    assert domains == ["de", "en"] and all(abs(sum(v) - 1) < 1e-9 for v in rows.values())
    assert rows[10][1] > 0.9 and rows[110][0] > 0.9 and 0.05 < rows[202][0] < 0.95


def test_no_labels_and_empty(spark):
    docs = corpus(spark)
    out = mixing.mix(docs, docs.where("false"), "lang", {"": 1.0})
    assert {r["domain"] for r in out.collect()} == {""}
    assert mixing.mix(docs.limit(0), docs, "lang", {"en": 1.0}).count() == 0


def test_draws_follow_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(9).alias("rate"))
    rates = docs.select("doc_id", F.when(F.col("doc_id") < 1000, 0.0).when(F.col("doc_id") < 2000, 2.0).when(F.col("doc_id") < 3000, 0.25).otherwise(1.5).alias("rate"))
    out = mixing.draw(docs, rates)
    assert out.columns == docs.columns
    n = [out.where(f"doc_id >= {k * 1000} AND doc_id < {k * 1000 + 1000}").count() for k in range(4)]
    assert n[0] == 0 and n[1] == 2000 and 180 < n[2] < 320 and 1400 < n[3] < 1600


def test_rare_label_is_in_the_sample(spark):
    rows = [(i, "das haus und der fluss", "de", "x") for i in range(3000)] + [(10_000 + i, "la maison et la riviere", "es", "x") for i in range(3)] + [(20_000 + i, "the house and the water", "zz", "x") for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    p, domains = mixing.posteriors(docs, docs, "lang", train_rows=90)
    got = {r["doc_id"]: r["p"] for r in p.collect()}
    assert domains == ["de", "es", "zz"] and all(len(v) == 3 and abs(sum(v) - 1) < 1e-9 for v in got.values())
    assert got[0][0] > 0.9 and got[10_000][1] > 0.9 and got[20_000][2] > 0.9
    out = mixing.mix(docs, docs, "lang", {"de": 0.5, "zz": 0.5})
    assert out.where("rate > 0").count() > 5900


def test_label_that_the_hash_leaves_out(spark):
    # all rows of the middle label are one row, so a hash draws all or none; posteriors keep their places
    for k in range(12):
        rows = [(i, "das haus und der fluss", "de", "x") for i in range(400)] + [(1000 + k, "la maison et la riviere", "es", "x")] * 2000 + [(20_000 + i, "the house and the water", "zz", "x") for i in range(400)]
        docs = spark.createDataFrame(rows, DOCS)
        p, _ = mixing.posteriors(docs.dropDuplicates(), docs, "lang", train_rows=150)
        got = {r["doc_id"]: r["p"] for r in p.where("doc_id IN (0, 20000)").collect()}
        assert got[0][0] > 0.9 and got[20_000][2] > 0.9
        if got[0][1] == 0.0:
            return
    raise AssertionError("the label was always drawn")
