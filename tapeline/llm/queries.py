"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import chat, decontaminate, divergence, infill, langid, mixing, ngram_join, pii, quality, secrets, shard, simhash, substring
from tapeline.llm._shared import stage


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, rows of equal or null doc_id apart; null texts have no words."""
    found = decontaminate.scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; rows of equal doc_id are one document that loses nothing to itself, rows without an id lose nothing."""
    return substring.deduplicate(_read(spark, sf_dir, "documents"), texts=False).drop("kept")


def _unseen() -> Column:
    """Documents that no language model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; rows without an id aren't held out; ties go to the later name."""
    docs = _read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs.where(~_unseen())))
    return found.select("doc_id", _unseen().alias("held_out"), "lang_pred", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each finding, whatever the forest says; rows of equal doc_id each have theirs. ``labels`` knows no secrets, so
    the forest learns from findings planted in the documents."""
    docs = _read(spark, sf_dir, "documents")
    words = secrets.dictionary(docs)
    model = secrets.train(stage(secrets.with_features(secrets.planted(docs), words), "planted"))  # the forest reads it once a level
    ready = secrets.with_features(secrets.candidates(docs), words)
    return secrets.score(ready, model).select("doc_id", "path", "start", F.char_length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; rows of equal doc_id, also of null, share a shard, where each has its slot."""
    text = F.coalesce("text", F.lit(""))
    docs = _read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return shard.shard(docs, 24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: Shares of the mixture's tokens by language.
TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null and empty texts have no token and the prior's rate. ``target`` and ``reached`` are its domain's."""
    docs = _read(spark, sf_dir, "documents")
    return mixing.mix(docs, docs, "lang", TARGETS).select("doc_id", "n_tokens", "domain", "rate", "target", "reached")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; texts without a word have fingerprint zero; a component of rows without an id has a null id."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each conversation; rows of equal turn are turns of their own, ordered by role and text. The rows go in as the log
    of events that a streaming client would have left."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') t(conv_id, turn, role, text)")
    back = chat.read_back(chat.format_chats(chat.as_streamed(rows.unionByName(extra))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null texts stay null; one entity has one surrogate in all of them."""
    return pii.pseudonymise(_read(spark, sf_dir, "documents"), b"change me: the key of this query is public").select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, null texts failing the base; languages are the strata, null being one. Contradicting labels of
    one doc_id don't count."""
    docs = _read(spark, sf_dir, "documents")
    stats = stage(quality.base_stats(docs, "lang"), "quality")  # read twice: to fit and to judge
    cutoffs = quality.fit(stats, _read(spark, sf_dir, "labels"))
    return quality.judge(stats, cutoffs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; texts without a word are alone, whatever their ids."""
    return ngram_join.linked(_read(spark, sf_dir, "documents")).drop("rid")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; null texts are empty, null ids draw as empty ones."""
    made = infill.with_restored(infill.transform(_read(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each pair of sources of a language, and for each source's 50 most overrepresented words."""
    return divergence.audit(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_substring_dedup, op3_language_id, op4_secret_scan, op5_sharding,
        op6_mixing, op7_simhash_near_dedup, op8_chat_formatting, op9_pii_surrogates, op10_quality_rules,
        op11_ngram_join, op12_infill, op13_source_divergence,
    )
}

#: DuckDB SQL of the same results, where SQL has the means.
SQL: dict[str, str] = {
    "op1_decontamination": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        bw AS (SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS win
               FROM b, unnest(range(1, greatest(2, len(ws) - 8))) AS t(i) WHERE len(ws) > 0),
        lens AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win FROM w, lens, unnest(range(1, len(ws) - n + 2)) AS t(i)),
        m AS (SELECT dw.doc_id, dw.i, bw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(range(m.i, m.i + m.n)) AS t(p) GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id LEFT JOIN its ON w.doc_id = its.doc_id""",
    "op2_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        win AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
        late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first_doc FROM win) WHERE first_doc < doc_id),
        gone AS (SELECT DISTINCT doc_id, p FROM late, unnest(range(i, i + 13)) AS t(p)),
        kept AS (SELECT doc_id, array_to_string(list_filter(ws, lambda x, k: NOT list_contains(ps, k)), ' ') AS kept, len(ps) AS n
                 FROM (SELECT w.doc_id, ws, coalesce(ps, []) AS ps FROM w LEFT JOIN (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id) g ON w.doc_id = g.doc_id))
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256
        FROM w JOIN kept ON w.doc_id = kept.doc_id""",
    "op8_chat_formatting": r"""
        WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                      UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(24 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&nl;'))
                        + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op11_ngram_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS s FROM w, unnest(range(1, greatest(2, len(ws) - 1))) AS t(i) WHERE len(ws) > 0),
        size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common c JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)),
        reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
        SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id""",
    "op12_infill": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        x AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
              CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                   WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
        c AS (SELECT *, substr(text, 1, least(c1, c2)) AS pre, substr(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS mid, substr(text, greatest(c1, c2) + 1) AS suf FROM x)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(least(c1, c2) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(greatest(c1, c2) - least(c1, c2) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM c""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
        l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
        have AS (SELECT w.lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL),
        total AS (SELECT lang, source, sum(c) AS n FROM have GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(h.c, 0) AS c, 1 + CAST(CAST(1000000000 AS HUGEINT) * (coalesce(h.c, 0) + 5) // (coalesce(t.n, 0) + 5 * l.v) AS BIGINT) AS p,
                     1 + CAST(CAST(1000000000 AS HUGEINT) * (k.c + 5) // (l.n + 5 * l.v) AS BIGINT) AS q
              FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN total t USING (lang, source) LEFT JOIN have h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        out AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
                UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM out)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
