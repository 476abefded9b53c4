from __future__ import annotations

import hashlib
import random

import pytest

from tapeline.llm import substring

DOCS = "doc_id bigint, text string"


def brute_rows(docs, window=13):
    """A row for each row, in order; rows of one id are one document, rows without an id nobody's."""
    first: dict[tuple, int] = {}
    for d, text in docs:
        w = substring_words(text)
        for i in range(len(w) - window + 1):
            if d is not None:
                first[tuple(w[i : i + window])] = min(d, first.get(tuple(w[i : i + window]), d))
    out = []
    for d, text in docs:
        w = substring_words(text)
        hit = {j for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in hit)
        out.append((d, len(w), len(hit), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def brute(docs, window=13):
    return {r[0]: r[1:] for r in brute_rows(docs, window)}


def substring_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def run(spark, docs, **more):
    return {r["doc_id"]: tuple(r)[1:] for r in substring.deduplicate(spark.createDataFrame(docs, DOCS), **more).collect()}


def corpus():
    rng = random.Random(5)
    base = [" ".join(rng.choice(["a", "b", "é"]) + str(rng.randrange(4)) for _ in range(rng.choice([5, 13, 14, 40, 80]))) for _ in range(30)]
    docs = []
    for i in range(120):
        parts = [rng.choice(base) for _ in range(rng.choice([1, 1, 2, 3]))]
        w = rng.choice([" ", "\n", "\t "]).join(parts).split(" ")
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = f"new{i}"
        docs.append((i * 3, " ".join(w)))
    return docs + [(1, None), (2, ""), (4, " \n"), (5, "x " * 20_000), (7, "x " * 15_000), (8, docs[0][1]), (1000, docs[1][1]), (1001, " ".join("abcdefghijklmnop"))]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_against_brute_force(spark, batches):
    docs = corpus()
    assert run(spark, docs, batches=batches) == brute(docs)


def test_short_windows_and_small_tasks(spark, monkeypatch):
    docs = corpus()
    assert run(spark, docs, window=4, part=2) == brute(docs, 4)


def test_windows_settled_within_a_task():
    import numpy as np

    held = [(np.array([7, 7, 7, 9, 7], np.uint64), np.array([1, 1, 1, 1, 1], np.uint64), np.array([3, 2, 2, 5, 2]), np.array([0, 0, 0, 0, 8]), np.array([0, 4, 1, 6, 2]))]
    rows = [r for b in substring._settled(held) for r in b.to_pylist()]
    assert [(r["doc_id"], r["rid"], r["pos"], r["late"]) for r in rows] == [(2, 0, [1, 4], False), (2, 8, [2], False), (5, 0, [6], False), (3, 0, [0], True)]


def test_index_compacts_and_cleans_up(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS)
    index = substring.FingerprintIndex(spark)
    tables = len(spark.catalog.listTables())
    out, seen = {}, df.where("false")
    for k in range(5):  # batch by batch, each judged before the next one comes
        batch = df.where(f"doc_id >= {k * 100} AND doc_id < {(k + 1) * 100}" if k < 4 else "doc_id >= 400")
        seen = seen.unionByName(batch)
        found = index.add(batch)
        out |= {r["doc_id"]: tuple(r)[1:] for r in index.without([found], seen, batch).collect()}
        runs = [r.count() for r in index.runs]
        plan = index._merged(index.runs[0], index.runs[0])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert out == brute(docs)
    assert index.compactions == 3 and len(index.runs) == 2  # 2, 4 runs full, 4 as 2 of level 1; then the fifth
    distinct = {tuple(r) for p in index.postings for r in p.select("h", "whole").collect()}
    assert sum(runs) >= len(distinct) and max(runs) <= len(distinct)
    index.drop()
    assert len(spark.catalog.listTables()) == tables


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 20, 1, "x"), (2, "a " * 20, 2, "y")], "doc_id bigint, text string, starts int, is_copy string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in substring.deduplicate(docs).collect()) == [(1, 0), (2, 20)]
    assert substring.deduplicate(docs.limit(0)).count() == 0


def test_rows_of_one_id(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(1000)}" for _ in range(n))
    t, u, v = text(20), text(20), text(30)
    docs = [(1, t), (2, t), (2, u), (2, u), (2, "z"), (3, f"{u} {v}"), (3, v), (3, t), (None, t), (None, t), (4, None), (4, f"q {t} q"), (5, f"{v} {v}")]
    got = sorted(map(tuple, substring.deduplicate(spark.createDataFrame(docs, DOCS)).collect()), key=repr)
    assert got == sorted(brute_rows(docs), key=repr)
    assert {r[2] for r in got if r[0] == 2} == {20, 0}
