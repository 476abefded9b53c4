from __future__ import annotations

import random
import re
from collections import Counter
from math import ceil, comb

import pytest
from pyspark.sql import functions as F

from tapeline.llm import quality

DOCS = "doc_id bigint, text string, lang string, kept string"


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def corpus():
    rng = random.Random(1)
    docs = [(i, "".join(rng.choice(["a", "bé", "c#", "|"]) + rng.choice([" ", "\n", "\t", "\r\n"]) for _ in range(rng.choice([0, 3, 12, 40]))), rng.choice(["en", "de", None]), "x") for i in range(80)]
    return docs + [(100, None, "en", "x"), (101, "", None, None), (102, "one two three four five " * 4_000, "en", "x"), (102, "same id", "de", "x"), (103, "a\n\na\n \n \n a", "de", "")]


def test_counts(spark):
    docs = corpus()
    out = quality.base_stats(spark.createDataFrame(docs, DOCS), "lang").collect()
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out)
    assert got == sorted((d[0], *slow(d[1])) for d in docs)


@pytest.mark.parametrize(("k", "n", "alpha"), [(0, 10, 0.05), (3, 50, 0.01), (7, 400, 0.001)])
def test_bound_is_exact(k, n, alpha):
    p = quality.binomial_upper(k, n, alpha)
    assert abs(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) - alpha) < 1e-6
    assert quality.binomial_upper(5, 5, alpha) == quality.binomial_upper(0, 0, alpha) == 1.0


def slow_fit(rows, max_rejection, alpha):
    """Fit again without Spark, from rows ``(doc_id, stratum, quality, judging, values by rule)``."""
    strata = sorted({r[1] for r in rows if not r[3]})
    out = {}
    for stratum in strata:
        good = [r[4] for r in rows if r[1] == stratum and not r[3] and r[2] == 1]
        bad = [r[4] for r in rows if r[1] == stratum and not r[3] and r[2] == 0]
        steps = []
        for rule, side in quality.RULES.items():
            values, held = sorted(v[rule] * side for v in good), (0, 0)
            for level in quality.LEVELS if values else ():
                cut = values[max(0, ceil(level * len(values)) - 1)]
                now = sum(v[rule] * side > cut for v in good), sum(v[rule] * side > cut for v in bad)
                more = now[0] - held[0], now[1] - held[1]
                if more[1] and more[1] / len(bad) >= quality.LIFT * more[0] / max(1, len(good)):
                    steps.append((more[0] / more[1], -more[1], rule, -len(steps), cut))
                    held = now
        path, loosest = [], {}
        for _, _, rule, _, cut in sorted(steps):
            if cut < loosest.get(rule, float("inf")):
                path.append((rule, cut))
                loosest[rule] = cut
        judges = [r[4] for r in rows if r[1] == stratum and r[3] and r[2] == 1]
        ok = True
        for i, (rule, cut) in enumerate(path):
            k = sum(any(v[a] * quality.RULES[a] > c for a, c in path[: i + 1]) for v in judges)
            ok = ok and quality.binomial_upper(k, len(judges), alpha / len(strata)) <= max_rejection
            out[stratum, i] = (rule, cut * quality.RULES[rule], k, len(judges), ok)
    return out


def labelled(n=6000):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        docs.append((i, " ".join(f"w{rng.randrange(500)}" + ("#" if bad or rng.random() < 0.002 else "") for _ in range(40)), "en" if i % 2 else "de", ""))
        labels.append((i, 0 if bad else 1))
    return docs, labels


def test_fit_against_plain_python(spark):
    docs, labels = labelled(2000)
    stats = quality.base_stats(spark.createDataFrame([*docs, (9_000, "#", "en", ""), (9_001, None, "en", "")], DOCS), "lang").cache()
    given = [*labels, labels[0], (3, 1 - labels[3][1]), (9_000, 1), (9_001, 1), (None, 1), (77_777, 1), (5, None)]
    got = quality.fit(stats, spark.createDataFrame(given, "doc_id bigint, quality int"), max_rejection=0.1).collect()
    known = {d: q for d, q in labels if d != 3}
    half = quality.rates(stats).where(~quality.base_failed()).withColumn("j", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)) == 1).collect()
    rows = [(r["doc_id"], r["stratum"], known[r["doc_id"]], r["j"], r.asDict()) for r in half if r["doc_id"] in known]
    want = slow_fit(rows, 0.1, 0.05)
    assert {(r["stratum"], r["step"]): (r["rule"], r["cutoff"], r["rejected"], r["holdout"], r["is_used"]) for r in got} == want
    assert any(v[-1] for v in want.values())


def test_cutoffs_reject_junk_and_keep_promises(spark):
    docs, labels = labelled()
    docs.append((9999, " ".join(f"v{i}" for i in range(40)), "xx", ""))
    stats = quality.base_stats(spark.createDataFrame(docs, DOCS), "lang").cache()
    cuts = quality.fit(stats, spark.createDataFrame([*labels, labels[0]], "doc_id bigint, quality int"), max_rejection=0.05)
    used = [r for r in cuts.collect() if r["is_used"]]
    assert {(r["stratum"], r["rule"]) for r in used} >= {("en", "symbol_rate"), ("de", "symbol_rate")}
    assert all(r["bound"] <= 0.05 for r in used)
    out = {r["doc_id"]: r["kept"] for r in quality.judge(stats, cuts).collect()}
    good = [i for i, q in labels if q]
    assert sum(not out[i] for i in good) < 0.05 * len(good) and not any(out[i] for i, q in labels if not q) and out[9999]


def test_too_few_labels_use_no_cutoff(spark):
    docs, labels = labelled(60)
    stats = quality.base_stats(spark.createDataFrame(docs, DOCS), "lang").cache()
    assert not [r for r in quality.fit(stats, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect() if r["is_used"]]


def test_cutoffs_act_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    stats = quality.base_stats(spark.read.parquet(f"{sf}/documents.parquet"), "lang").cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.judge(stats, quality.fit(stats, labels)).join(labels, "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept"), F.count_if("base_failed").alias("failed")).collect()
    n = {r["quality"]: r for r in out}
    assert n[1]["kept"] >= 0.95 * (n[1]["n"] - n[1]["failed"]) and n[0]["kept"] < 0.5 * (n[0]["n"] - n[0]["failed"])


def test_without_labels_the_base_decides(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    stats = quality.base_stats(docs, "lang")
    cuts = quality.fit(stats, spark.createDataFrame([], "doc_id bigint, quality int"))
    out = quality.judge(stats, cuts).collect()
    assert len(out) == docs.count() and all(r["kept"] != r["base_failed"] for r in out)
    assert quality.judge(stats.limit(0), cuts).count() == 0
