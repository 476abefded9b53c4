from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tapeline.llm import decontaminate

DOCS, BENCH = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows: dict[tuple, set] = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9)):
            if w:
                windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (win := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[win]
        out[d] = (len(w), sorted(hit), sorted(found))
    return out


def run(spark, docs, items, **more):
    out = decontaminate.scan(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH), **more)
    return {r["doc_id"]: (r["n_words"], list(r["hit_words"]), list(r["item_ids"])) for r in out.collect()}


def cases():
    rng = random.Random(3)
    vocab = ["a", "B", "éa", "c3", "straße"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "  ", ", ", "\n", "\x00-"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 14]))) for i in range(25)] + [(90, None), (91, "!?"), (92, "one two"), (93, "one two")]
    docs = [(i, text(rng.choice([0, 1, 8, 30, 60]))) for i in range(60)]
    docs += [(100 + i, f"x {items[i][1] or ''} y") for i in range(25)] + [(200, None), (201, ""), (202, "ONE, TWO!"), (203, "one twofold"), (204, "q " * 30_000 + "one two")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_give_the_same(spark):
    docs, items = cases()
    assert run(spark, docs, items, block_words=60) == brute(docs, items)


def test_blocks_keep_rows_apart(spark):
    docs = spark.createDataFrame([(1, "one two x"), (1, "one two x"), (1, "y three four"), (None, "one two three four"), (None, None), (None, "one two three four")], DOCS)
    items = spark.createDataFrame([(1, "one two"), (2, "three four"), (3, "two three")], BENCH)
    one, many = (sorted(map(repr, decontaminate.scan(docs, items, block_words=b).collect())) for b in (100, 1))
    assert one == many and len(one) == 6 and one[0] == one[1] and one[4] == one[5]
    assert any("spans=[Row(start=0, end=18)]" in r for r in many)  # runs of neighbouring blocks are one span
    assert decontaminate._blocks(items, 10, 1)[0] > 1
    kept = [decontaminate.clean(docs, items, block_words=b).collect() for b in (100, 1)]
    assert kept[0] == kept[1] and [tuple(r) for r in kept[0]] == [(None, None)]


def test_many_words_and_long_items(spark):
    rng = random.Random(8)
    items = [(1, " ".join(f"w{rng.randrange(70_000)}" for _ in range(90_000))), (2, " ".join(f"w{rng.randrange(300)}" for _ in range(500)))]
    w = items[0][1].split()
    docs = [(i, " ".join(["x"] * 3 + w[k : k + n] + ["y"])) for i, (k, n) in enumerate([(0, 12), (89_990, 10), (44_000, 9), (24_995, 30), (50_000, 60)])] + [(9, items[1][1])]
    assert run(spark, docs, items) == run(spark, docs, items, block_words=4_000) == brute(docs, items)


def test_spans_are_in_the_original(spark):
    docs = spark.createDataFrame([(1, "Ää!! «ONE — two»  end")], DOCS)
    row = decontaminate.scan(docs, spark.createDataFrame([(1, "one two")], BENCH)).first()
    assert row["spans"] == [] and row["hit_words"] == []  # quotation marks and dashes are word characters here
    docs = spark.createDataFrame([(1, "Ää!! ONE, \ttwo. end ONE two")], DOCS)
    row = decontaminate.scan(docs, spark.createDataFrame([(1, "one two")], BENCH)).first()
    assert ["Ää!! ONE, \ttwo. end ONE two"[s["start"] : s["end"]] for s in row["spans"]] == ["ONE, \ttwo", "ONE two"]


def test_clean_keeps_columns_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, "one two", 0), (2, None, 0), (3, "fine", 1), (3, "fine", 1), (None, "fine", 2)], "doc_id bigint, text string, n_words int")
    out = decontaminate.clean(docs, spark.createDataFrame([(1, "one two")], BENCH))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(2, None, 0), (3, "fine", 1), (3, "fine", 1), (None, "fine", 2)], key=str)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "one two")], DOCS), spark.createDataFrame([(1, "one two")], BENCH)
    assert decontaminate.scan(docs.limit(0), items).count() == 0
    assert decontaminate.scan(docs, items.where(F.lit(False))).first()["n_words"] == 2
