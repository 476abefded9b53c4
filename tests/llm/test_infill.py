from __future__ import annotations

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from tapeline.llm import infill


def plain_form(doc_id, text):
    """The output by string slices."""
    h = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return len(text), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@given(st.lists(st.sampled_from(["<", ">", "P", "S", "M", "<P", "S>", "é", "😀", "a\n"]), max_size=12).map("".join), st.integers(-5, 400))
def test_any_text_is_restored(text, doc_id):
    n, form, prefix, middle, out = infill.example(doc_id, text.encode())
    assert (n, form, prefix, middle, out.decode()) == plain_form(doc_id, text)
    assert infill.restore(out, form).decode() == text


@given(st.binary(max_size=20).filter(lambda x: b"<" not in x), st.integers(0, 20), st.integers(0, 20), st.booleans())
def test_every_cut(text, a, b, turned):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    out = infill.rearrange(text, a, b, turned)
    blocks = [b"<S>" + text[b:], b"<P>" + text[:a]] if turned else [b"<P>" + text[:a], b"<S>" + text[b:]]
    assert out == b"".join(blocks) + b"<M>" + text[a:b]
    assert infill.restore(out, "spm" if turned else "psm") == text


def test_rows(spark):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice("ab é😀\n<>PSM") for _ in range(rng.randrange(200)))) for i in range(300)]
    docs += [(7, docs[7][1]), (7, "another text of the same id"), (None, "no id"), (None, None), (900, None), (901, ""), (902, "a<M>b"), (903, "long é " * 200_000)]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id bigint, text string, form string, output string")
    got = infill.with_restored(infill.transform(df)).collect()
    want = [(d, *plain_form(d, t or ""), t or "") for d, t in docs]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert {"psm", "spm", "plain"} == {r["form"] for r in got}
    assert infill.with_restored(infill.transform(df.limit(0))).count() == 0


def test_rates(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'some words' AS text")
    n = {r["form"]: r["count"] for r in infill.transform(df).groupBy("form").count().collect()}
    assert abs(n["plain"] - 200) < 60 and abs(n["spm"] - 360) < 80
    assert {r["form"] for r in infill.transform(df, rate=100, suffix_first=100).select("form").distinct().collect()} == {"spm"}
