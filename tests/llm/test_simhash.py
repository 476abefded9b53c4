from __future__ import annotations

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tapeline.llm import simhash

DOCS = "doc_id bigint, text string"


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def components(ids, fps, threshold):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def clusters(seed, n=40, size=6):
    rng = random.Random(seed)
    out = [0, 2**64 - 1]
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, size)):
            out.append(x)
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
    return sorted(set(out))


@pytest.mark.parametrize(("blocks", "square"), [(3, 20_000), (3, 4), (2, 20_000), (4, 10)])
def test_links_have_all_components(spark, blocks, square):
    fps = clusters(blocks * 100 + square)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    edges = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(df, 4, blocks, square).collect()]
    assert all((a ^ b).bit_count() >= 1 for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {f: find(f) for f in fps} == components(fps, {f: f for f in fps}, 4)


@settings(max_examples=30)
@given(st.integers(2, 22), st.integers(0, 2**22 - 1))
def test_every_word_has_a_home_anchor(bits, word):
    if bits < 3:
        return
    word &= (1 << bits) - 1
    r, masks = simhash.covering_masks(bits, 2)
    syndrome = 0
    for i in range(2**r - 1):
        if word >> i & 1:
            syndrome ^= i + 1
    assert masks[syndrome][0].bit_count() <= simhash.RADIUS


def slow_fingerprint(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x.decode()) for x in (text or "").encode().split()]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def corpus():
    rng = random.Random(9)
    docs = []
    for i in range(40):
        w = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.choice([1, 3, 4, 5, 60, 200]))]
        docs.append((i, " ".join(w)))
        if len(w) > 50:
            w[rng.randrange(len(w))] = "CHANGED"
            docs.append((100 + i, "\n".join(w)))
    return docs + [(500, None), (501, ""), (502, " \t"), (503, docs[0][1].upper()), (504, "z" * 100_000 + " É")]


def test_against_brute_force(spark):
    docs = corpus()
    fps = {d: slow_fingerprint(t) for d, t in docs}
    comp = components([d for d, _ in docs], fps, 4)
    got = simhash.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {d: (f"{fps[d]:016x}", comp[d]) for d, _ in docs}


def test_keep_one_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "x"), (2, "a b c d e", "y"), (3, "other words are in this text", "z"), (3, "other words are in this text", "z")], "doc_id bigint, text string, fp string")
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 3]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_long_chains_and_stars_settle(spark):
    from tapeline.llm._shared import connected_components

    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)}


def test_keep_one_by_similarity_goes_through_fingerprints(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:299], "x"]), " ".join(f"v{i}" for i in range(50)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    seen, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps, *of: (seen.append(fps.count()), links(fps, *of))[1])
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs, size=5, similarity=0.8).collect()) == [0, 2, 3]
    assert seen and seen[0] >= 2
    nodes = spark.createDataFrame([(1, 0b0), (2, 0b1111), (3, 0b11111111), (4, -1), (1, 0b1)], "node bigint, fp bigint")
    keys = {}
    for r in simhash.component_keys(nodes).collect():
        keys.setdefault(r["node"], set()).add(r["key"])
    assert keys[1] == keys[2] == keys[3] != keys[4] and all(len(k) == 1 for k in keys.values())
