from __future__ import annotations

from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from tapeline.llm import langid

SF = "/root/testdata/sf0.01"
ENGLISH = "the house is on the hill and the water runs from the mountain to the river where the children play in the sun"
GERMAN = "das haus steht auf dem berg und das wasser fließt vom gipfel in den fluss wo die kinder in der sonne spielen"


def small_model(spark):
    rows = [(i, ENGLISH, "en") for i in range(5)] + [(10 + i, GERMAN, "de") for i in range(5)] + [(20, None, "fr"), (21, "text ohne", None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    out = langid.predict(docs.where(unseen), langid.fit(docs.where(~unseen)))
    joined = out.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert joined[0] > 0.97 and 0 <= joined[1] <= joined[2] <= 1


def test_cases(spark):
    model = small_model(spark)
    assert model.languages == ("de", "en")
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, ENGLISH), (5, GERMAN.upper()), (6, ENGLISH + " " + GERMAN), (7, "the " * 200_000), (7, "the " * 5)]
    docs = spark.createDataFrame([(*r, "zz") for r in rows], "doc_id bigint, text string, lang_pred string")
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0.0 for i in (1, 2, 3))
    assert (by[4]["lang_pred"], by[5]["lang_pred"]) == ("en", "de")
    assert set(by[6]["mixture"]) == {"en", "de"} and 0.3 < by[6]["mixture"]["en"] < 0.7
    assert langid.predict(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    model = langid.fit(spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string"))
    assert langid.predict(spark.createDataFrame([(1, "text")], "doc_id bigint, text string"), model).first()["lang_pred"] == "und"


def test_unknown_texts_go(spark):
    model = small_model(spark)
    docs = spark.createDataFrame([(1, ENGLISH, "a"), (2, "qqzzx xjqwz zzqxw " * 20, "b"), (3, None, "c"), (None, GERMAN, "d")], "doc_id bigint, text string, unknown string")
    out = langid.known_language(docs, model)
    assert out.columns == docs.columns and sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1]


def plain_em(p, n, steps=25):
    """Shares of the columns by expectation-maximisation, one n-gram at a time."""
    k = len(p[0])
    share = [1.0 / k] * k
    for _ in range(steps):
        new = [0.0] * k
        for row, c in zip(p, n, strict=True):
            joint = [x * s for x, s in zip(row, share, strict=True)]
            for j in range(k):
                new[j] += c * joint[j] / sum(joint) / sum(n)
        done = max(abs(a - b) for a, b in zip(new, share, strict=True)) < 1e-3
        share = new
        if done:
            break
    return share, sum(c * log(sum(x * s for x, s in zip(row, share, strict=True))) for row, c in zip(p, n, strict=True))


def test_inference_against_plain_em(spark):
    model = small_model(spark)
    for text in (ENGLISH, GERMAN, f"{ENGLISH} {GERMAN}", f"{ENGLISH} {ENGLISH} wasser haus", "qqzzx xjqwz " * 9, "x"):
        count = Counter(langid.cells(text).tolist())
        n = [float(c) for c in count.values()]
        p = model.p[list(count)].tolist()
        share, _ = plain_em(p, n)
        order = sorted(range(len(share) - 1), key=lambda i: -share[i])
        best, held = None, float("-inf")
        for size in range(1, len(order) + 1):
            chosen = order[:size] + [len(share) - 1]
            own, fit = plain_em([[row[i] for i in chosen] for row in p], n)
            fit -= langid.PENALTY * log(sum(n)) * size
            if fit <= held:
                break
            best, held = dict(zip([model.languages[i] for i in chosen[:-1]], own, strict=False)), fit
        got = langid.infer(model, text)
        assert got.mixture.keys() == best.keys() and all(abs(got.mixture[k] - v) < 1e-6 for k, v in best.items())
        assert got.language == max(best, key=lambda k: (best[k], k))


def test_too_many_languages(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.col("id").alias("lang"))
    with pytest.raises(ValueError, match="lang"):
        langid.fit(docs)
