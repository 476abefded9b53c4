"""The registered queries on a small folder of tables with every odd case, against brute force or SQL, and their contracts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
import test_decontaminate
import test_quality
import test_shard
import test_simhash
import test_substring

from tapeline.llm.queries import QUERIES, SQL

WORDS = "the of and to in is that for with on das der und zu ist nicht le la les des est une el los que por una con".split()
TYPES = {
    "op1_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op2_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op7_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_chat_formatting": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op10_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(WORDS).title() if rng.random() < 0.1 else rng.choice(WORDS) for _ in range(n))
    items = [(i, text(rng.choice([4, 12, 30]))) for i in range(12)] + [(20, None), (21, "")]
    docs = [(i, text(rng.choice([1, 5, 20, 60, 150])), rng.choice(["en", "de", None]), f"src{i % 3}", 0) for i in range(150)]
    docs += [(200 + i, docs[i][1], "en", "src0", None) for i in range(20)]
    docs += [(300 + i, docs[i][1].replace("the", "CHANGED", 1) + "\n" + (items[i % 12][1] or ""), "de", None, 1) for i in range(20)]
    docs += [(400, None, None, None, None), (401, "", "en", "s", 0), (402, "12 \t 34 !", "fr", "s", 0), (403, "long " * 30_000 + 'token = "0123456789abcdef0123456789abcdef01234567" mail a.b@c.example.com', "en", "s", 0), (404, "é\n\né\n#", "en", "s", 0)]
    convs = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", text(5), "</s>[INST] &lt; <|im_end|>\n"])) for c in range(15) for t in range(rng.randrange(1, 6))]
    labels = [(i, int(rng.random() < 0.9), 0) for i in range(150)] + [(0, 1, 0), (9999, 1, None)]
    at = tmp_path_factory.mktemp("tables")
    # extra columns whose names the operators use themselves
    spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, shard string, stratum string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(*c, 1) for c in convs], "conv_id bigint, turn bigint, role string, text string, seq int").write.parquet(f"{at}/conversations.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), docs, items, convs


@pytest.fixture(scope="module")
def rows(spark, tables):
    found = {}

    def get(name):
        if name not in found:
            df = QUERIES[name](spark, tables[0])
            for column, kind in TYPES.get(name, {}).items():
                assert dict(df.dtypes)[column] == kind
            found[name] = df.collect()
        return found[name]

    return get


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(rows, tables, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables[0]}/{t}.parquet/*.parquet'")
    cursor = con.execute(SQL[name])
    cols = [d[0] for d in cursor.description]
    assert sorted(tuple(r[c] for c in cols) for r in rows(name)) == sorted(cursor.fetchall())


def test_op1(rows, tables):
    want = test_decontaminate.brute([d[:2] for d in tables[1]], tables[2])
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows("op1_decontamination")}
    assert got == {d: (n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h)) for d, (n, h, i) in want.items()}


def test_op2(rows, tables):
    want = test_substring.brute([d[:2] for d in tables[1]])
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows("op2_substring_dedup")} == {d: w[:3] for d, w in want.items()}


def test_op3(rows, tables):
    got = {r["doc_id"]: r for r in rows("op3_language_id")}
    assert len(got) == len(tables[1])
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert all((got[d[0]]["lang_pred"] == "und") == (not any(map(str.isalpha, d[1] or ""))) for d in tables[1])
    assert {r["lang_pred"] for r in got.values()} <= {"en", "de", "fr", "und"}


def test_op4(rows, tables):
    text = {d[0]: d[1] for d in tables[1]}
    got = rows("op4_secret_scan")
    assert [(r["doc_id"], text[r["doc_id"]][r["start"] : r["start"] + r["n_chars"]]) for r in got] == [(403, "0123456789abcdef0123456789abcdef01234567")]


def test_op5(rows, tables):
    got = {r["doc_id"]: r for r in rows("op5_sharding")}
    by = defaultdict(list)
    for d in tables[1]:
        raw, r = (d[1] or "").encode(), got[d[0]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == tuple(test_shard.slow_place(d[0], test_shard.shard.topology(n)) for n in (24, 25))
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_op6(rows, tables):
    got = rows("op6_mixing")
    assert sorted(r["doc_id"] for r in got) == sorted(d[0] for d in tables[1]) and all(r["rate"] >= 0 for r in got)


def test_op7(rows, tables):
    fps = {d[0]: test_simhash.slow_fingerprint(d[1]) for d in tables[1]}
    comp = test_simhash.components(sorted(fps), fps, 4)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows("op7_simhash_near_dedup")} == {d: (f"{f:016x}", comp[d]) for d, f in fps.items()}


def test_op8(rows, tables):
    convs = defaultdict(list)
    for c, t, role, text in tables[3]:
        convs[c].append((t, role or "", text or ""))
    convs[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for c, turns in convs.items():
        loss = "".join(x for _, r, x in sorted(turns) if r == "assistant")
        want[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in sorted(turns))), len(loss), sha(loss))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows("op8_chat_formatting")} == want


def test_op9(rows, tables):
    got = {r["doc_id"]: r for r in rows("op9_pii_surrogates")}
    for d in tables[1]:
        assert got[d[0]]["text"] == d[1] or d[0] == 403
    assert got[403]["n_entities"] == 1 and "a.b@c.example.com" not in got[403]["text"] and got[403]["text"].endswith(".example.com")


def test_op10(rows, tables):
    got = {r["doc_id"]: r for r in rows("op10_quality_rules")}
    for d in tables[1]:
        n = test_quality.slow(d[1])
        r = got[d[0]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and not (r["kept"] and r["base_failed"])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tables, tmp_path, name):
    for t in ("documents", "benchmark", "conversations", "labels"):
        spark.read.parquet(f"{tables[0]}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if name == "op8_chat_formatting" else 0)
