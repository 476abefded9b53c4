from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tapeline.llm import divergence

DOCS = "doc_id bigint, text string, lang string, source string, term string, rank int"


def corpus():
    rng = random.Random(8)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["été", "Straße", "x"]
    docs = []
    for i in range(400):
        lang, source = rng.choice(["en", "de", None]), f"s{min(rng.randrange(12), rng.randrange(12))}"
        docs.append((i, " ".join(rng.choice(words[: 20 + 10 * int(source[1:])]).title() for _ in range(rng.randrange(0, 80))) + " 12,a-b", lang, source, "y", 1))
    docs += [(i, None, "en", "empty", None, None) for i in range(3)] + [(None, "x " * 50_000, "en", None, None, None), (None, "x", "en", "", None, None)]
    docs += [(9, "rare words alone", "fr", f"f{i}", None, None) for i in range(4)] + [(9, "lone", "es", "only", None, None)]
    return docs


def plain(docs, least, ranks):
    count, have, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in docs:
        ws = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        count[lang or "", source or ""].update(ws)
        total[lang or ""].update(ws)
        have[lang or ""].update(set(ws))
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in have.items()}
    out = set()
    for lang, source in count:
        terms = kept.get(lang, [])

        def p(c, terms=terms):
            n = sum(c[t] for t in terms)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(terms)) for t in terms}

        own, whole = p(count[lang, source]), p(total[lang])
        pairs = [(sum(abs(own[t] - q[t]) for t in terms), b) for (a, b), c in count.items() if a == lang and b != source for q in [p(c)]]
        more = [(own[t] - whole[t], t) for t in terms if count[lang, source][t] and own[t] > whole[t]]
        order = lambda x: (-x[0], x[1].encode())
        out |= {(lang, source, "pair", b, v, k) for k, (v, b) in enumerate(sorted(pairs, key=order), 1)}
        out |= {(lang, source, "term", t, v, k) for k, (v, t) in enumerate(sorted(more, key=order)[:ranks], 1)}
    return out


@pytest.mark.parametrize(("least", "block", "tile"), [(30, divergence.BLOCK, divergence.TILE), (1, 7, 3), (5, 64, 1), (10_000, 8, 2)])
def test_against_plain_sums(spark, least, block, tile, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 300)
    docs = corpus()
    rows = divergence.audit(spark.createDataFrame(docs, DOCS), least, block=block, tile=tile, ranks=9).collect()
    assert len(rows) == len(set(rows))
    assert {tuple(r) for r in rows} == plain(docs, least, 9)


def test_runs_are_fewer_than_words(spark):
    """The order of the vocabulary makes neighbours of equal counts."""
    rng = random.Random(2)
    rows = [("l", f"s{s}", f"t{t}", n, 40) for s in range(4) for t in range(600) if (n := rng.choice([0, 0, 1, 1, 2]) if s else t % 5)]
    counts = spark.createDataFrame(rows, "lang string, source string, term string, n bigint, docs bigint")
    groups = counts.groupBy("lang", "source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "tokens")
    order = {r["term"]: k for k, r in enumerate(divergence._ordered(counts.coalesce(1), groups, 1).orderBy("pos").collect())}
    turns = lambda key: sum(a != b for a, b in zip(key, key[1:], strict=False))
    for s in range(3):
        n = {r[2]: r[3] for r in rows if r[1] == f"s{s}"}
        assert turns([n.get(t, 0) for t in sorted(order, key=order.get)]) < turns([n.get(t, 0) for t in sorted(order)])


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0
    one = divergence.audit(spark.createDataFrame([(None, None, None, None, None, None), (None, None, None, "b", None, None)], DOCS)).collect()
    assert sorted(tuple(r) for r in one) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_tasks_hand_on_few_rows(spark):
    """A row for each word of a source, not one for each task that met it."""
    rng = random.Random(4)
    docs = [(i, " ".join("w" + "abcdefghij"[k // 10] + "abcdefghij"[k % 10] for k in rng.choices(range(100), k=40)), "en", f"s{i % 20}", None, None) for i in range(1600)]
    found = divergence._scanned(spark.createDataFrame(docs, DOCS).repartition(8)).where("term IS NOT NULL")
    once = found.select("lang", "source", "term").distinct().count()
    assert once == 2000
    assert found.count() <= 1.5 * once


def test_rare_words_go_no_further(spark):
    docs = [(i, f"both word{'abcdefghij'[i % 10]} r{chr(97 + i // 10)}{chr(97 + i % 10)}", "en", f"s{i % 3}", None, None) for i in range(60)]
    rows = divergence._counted(spark.createDataFrame(docs, DOCS), 6).collect()
    assert {r["term"] for r in rows} == {None, "both", *(f"word{c}" for c in "abcdefghij")}
    assert {(r["source"], r["n"]) for r in rows if r["term"] is None} == {("s0", 0), ("s1", 0), ("s2", 0)}


@pytest.mark.parametrize(("held", "size"), [(5, 7), (40, 20), (10**6, 10**6)])
def test_counts_of_a_task(held, size, monkeypatch):
    """Whatever is held and cut, sums are the same; bytes that part words, empty texts and slices of a batch."""
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "CHUNK", size)
    rng = random.Random(6)
    texts = ["".join(rng.choice("aBZé ß日\0@[`{\x7f0") for _ in range(rng.randrange(0, 14))) for _ in range(200)]
    rows = [(rng.choice(["", "en"]), f"s{rng.randrange(3)}", t) for t in texts] + [("en", "none", "")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["lang", "source", "text"])
    n, have = Counter(), Counter()
    for out in divergence._counts(iter([batch.slice(0, 0), batch.slice(0, 90), batch.slice(90)])):
        for r in out.to_pylist():
            n[r["lang"], r["source"], r["term"]] += r["n"]
            have[r["lang"], r["source"], r["term"]] += r["docs"]
    want, docs = Counter(), Counter()
    for lang, source, t in rows:
        ws = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        want.update([(lang, source, w) for w in ws])
        docs.update({(lang, source, w) for w in ws} | {(lang, source, None)})
    assert {k: v for k, v in n.items() if k[2] is not None} == want
    assert set(have) == set(docs)
    assert all(have[k] == (docs[k] if k[2] is not None else 0) for k in have)


def test_shares_of_large_counts(spark):
    """Exact on both sides of the count whose product is no long."""
    cases = [(n, total, size) for n in (0, 7, divergence.LONG - 1, divergence.LONG, 10**15) for total, size in ((n, 1), (10**16 + 7, 300_000))]
    rows = spark.createDataFrame(cases, "n bigint, total bigint, size bigint").select("*", divergence._share("n", "total", "size").alias("p")).collect()
    assert all(r["p"] == 1 + 1_000_000_000 * (r["n"] + 5) // (r["total"] + 5 * r["size"]) for r in rows)
