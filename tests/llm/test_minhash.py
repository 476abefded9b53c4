from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from tapeline.llm import minhash

DOCS = "doc_id bigint, text string, lang string"


def corpus():
    rng = random.Random(4)
    docs = []
    for i in range(60):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 400]))]
        docs.append((i, " ".join(w), "en"))
        for k in range(rng.randrange(0, 4)):
            for _ in range(rng.randrange(1, 8)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(5000)}"
            docs.append((100 * (k + 1) + i, "\n".join(w).upper(), None))
    base = [f"b{rng.randrange(5000)}" for _ in range(300)]
    for i in range(30):
        docs.append((1000 + i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :]), None))
    return docs + [(2000, None, None), (2001, "", "en"), (2002, "one two", None), (2003, "one TWO", None), (2004, "z " * 20_000, None), (None, "a text without an id", None)]


def brute(docs):
    sets = {d: minhash.shingles((t or "").encode()) for d, t, _ in docs if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for a in sets:
        for b in sets:
            if a < b and minhash.jaccard(sets[a], sets[b]) >= 0.8:
                pairs += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}, pairs


def test_stage_against_brute_force(spark):
    docs = corpus()
    want, pairs = brute(docs)
    assert pairs > 100
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, DOCS), "")
    assert out.columns == ["doc_id", "text", "lang"]
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted(set(want.values()))
    assert out.where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize(("side", "side_bytes"), [(1000, 8_000_000), (5, 8_000_000), (1000, 4_000)])
def test_components(spark, side, side_bytes):
    docs = corpus()
    got = minhash.near_duplicates(spark.createDataFrame(docs, DOCS), side=side, side_bytes=side_bytes).where("doc_id IS NOT NULL").collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(docs)[0]


def test_rows_of_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    docs = spark.createDataFrame([(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b + " c", "x"), (None, a, "x"), (1, a, "x")], DOCS)
    out = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert out == [(0, a), (1, a), (1, a), (2, b)]


def test_pairs_by_counting():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in rng.integers(1, 60, 50)]
    at, to = minhash._near(sets[:20], sets, 0.7)
    want = {(i, j) for i in range(20) for j in range(50) if len(np.intersect1d(sets[i], sets[j])) >= 0.7 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(at.tolist(), to.tolist(), strict=True)) == want
