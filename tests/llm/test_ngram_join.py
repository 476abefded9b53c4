from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeline.llm import minhash, ngram_join

DOCS = "doc_id bigint, text string, node string, n_shingles int"


def corpus(seed=5):
    rng = random.Random(seed)
    word = lambda k: f"w{rng.randrange(k)}"
    common = [f"c{i}" for i in range(40)]
    docs = []
    for i in range(120):
        w = [word(3000) for _ in range(rng.choice([1, 3, 8, 12, 30, 120, 400]))]
        if i % 3 == 0:
            w[len(w) // 2 : len(w) // 2] = common  # a passage that a third of all documents share
        docs.append((i, " ".join(w)))
        for k in range(rng.randrange(0, 4)):
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = word(3000)
            docs.append((1000 * (k + 1) + i, "\n".join(w).upper()))
    base = [word(3000) for _ in range(130)]
    for i in range(150):  # a large group, around the threshold
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = word(3000)
        docs.append((5000 + i, " ".join(w)))
    for i in range(60):  # short texts of a few frequent words
        docs.append((6000 + i, " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(1, 16)))))
    return docs + [(7000, None), (7001, ""), (7002, " \t"), (7003, "one two"), (7004, "ONE two"), (7005, "z y " * 30_000), (7006, "z y " * 30_000 + "x")]


def brute(docs):
    sets = {d: minhash.shingles((t or "").encode(), 3) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 10 * min(len(x), len(y)) >= 9 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 90 * (len(x) + len(y) - both):
                    i, j = sorted((find(a), find(b)))
                    root[j] = i
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.fixture(scope="module")
def docs():
    return corpus()


@pytest.mark.parametrize(("hot", "side"), [(ngram_join.HOT, ngram_join.SIDE), (6, 20), (1, 9), (10_000, 1_000)])
def test_against_brute_force(spark, docs, hot, side):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(df, hot=hot, side=side).collect()}
    assert got == brute(docs)


def test_hashes_are_those_of_the_words(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abC \n\té😀") for _ in range(rng.choice([0, 1, 5, 40, 300]))).encode() for _ in range(200)] + [None, b"x" * 200_000, b"Word " * 3000]
    of = {}
    for step in (ngram_join.STEP, 50, 7):
        monkeypatch.setattr(ngram_join, "STEP", step)
        for t, h in zip(texts, ngram_join.shingle_sets(texts), strict=True):
            own = minhash.shingles(t, 3)
            assert len(h) == len(own) and (h[1:] > h[:-1]).all()
            assert of.setdefault(frozenset(own), h.tobytes()) == h.tobytes()
    assert len(set(of.values())) == len(of)


def test_prefixes_lose_no_pair_and_ask_for_more(spark, docs):
    """Every pair of the similarity is met by the rule of the prefixes alone, though documents ask for several matches."""
    sets = {h.tobytes(): h for h in ngram_join.shingle_sets([t and t.encode() for _, t in docs]) if len(h)}
    nodes = list(sets.values())
    pools = [ngram_join._pool(h, 90).view(np.int64).tolist() for h in nodes]
    df = {}
    for p in pools:
        for t in p:
            df[t] = df.get(t, 0) + 1
    hot = 10
    rows = [(i, len(nodes[i]), [(k, df[t], t) for k, t in enumerate(p) if df[t] > 1]) for i, p in enumerate(pools)]
    chosen = ngram_join.choose(spark.createDataFrame(rows, "node bigint, n bigint, own array<struct<pos: int, df: bigint, token: bigint>>"), hot=hot)
    of = {r["node"]: r for r in chosen.collect()}
    assert max(r["asked"] or 0 for r in of.values()) > 1 and any(r["asked"] is None for r in of.values())
    cold = {i: set(r["cold"]) for i, r in of.items()}
    met = 0
    for a in range(len(nodes)):
        for b in range(a + 1, len(nodes)):
            x, y = nodes[a], nodes[b]
            both = len(np.intersect1d(x, y, True)) if 10 * min(len(x), len(y)) >= 9 * max(len(x), len(y)) else 0
            if both and 10 * both >= 9 * (len(x) + len(y) - both):
                asked = [of[i]["asked"] for i in (a, b) if of[i]["asked"]]
                if asked:
                    met += 1
                    assert len(cold[a] & cold[b]) >= min(asked)
    assert met > 30


def test_odd_rows(spark, docs):
    df = spark.createDataFrame([(None, "one two three four"), (None, "one two three four"), (4, "One Two three FOUR"), (5, "five"), (5, "five"), (5, "other words"), (None, None), (6, None)], "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.linked(df).collect()), key=str)
    assert got == sorted([(None, 2, 4), (None, 2, 4), (4, 2, 4), (5, 1, 5), (5, 1, 5), (5, 1, 5), (None, 0, None), (6, 0, 6)], key=str)
    assert ngram_join.linked(df.limit(0)).count() == 0
    none = ngram_join.linked(df.where("doc_id IS NULL")).select("component_id").distinct().collect()
    assert [r[0] for r in none] == [None]


def test_copies_are_one_node(spark):
    """Thousands of copies meet nobody: the pairs staged are those of different sets."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same words in every one of them").alias("text"))
    assert ngram_join.linked(df).groupBy("component_id").count().collect() == [(0, 3000)]
