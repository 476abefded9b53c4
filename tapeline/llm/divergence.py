"""How far sources of a language differ in their words: exact smoothed shares, compared on run-length columns.

A language's vocabulary is put in an order in which equal counts are neighbours. A source's counts in that order are a column of
runs, most of them of zeros; the sum of differences of two sources takes a step for each run that their boundaries cut out, not
one for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm._shared import LOWER, drop_staged, runs, stage

#: A byte of a word, A-Z lower-cased, or zero for the bytes \x00-\x40, \x5B-\x60 and \x7B-\x7F, which part words.
FOLD = np.array([LOWER[b] if b > 127 or chr(b).isalpha() else 0 for b in range(256)], np.uint8)
#: A word is kept where so many documents of its language have it.
LEAST_DOCS = 30
#: Ranks of words that are reported for each source.
RANKS = 50
#: Counts that a task holds before it hands them on, rows of a batch that it hands on, and bytes of text that it counts at a time.
HELD, OUT, CHUNK = 800_000, 50_000, 2_000_000
#: Words of a block of columns, and sources on each side of a tile of pairs: what a task holds at once.
BLOCK, TILE = 8_192, 64
#: The largest sources by whose counts a vocabulary is ordered. More of them make runs longer; results don't depend on it.
LEADING = 8
#: Counts below this give a long when multiplied by 10^9.
LONG = 9_000_000_000


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, one after the other, and the text of each."""
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    folded = FOLD[np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]]]
    edges = edges - edges[0]
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = edges[:-1][edges[:-1] < edges[1:]]  # a word ends with its text
    begins[heads] = inside[heads]
    letters = folded[inside]
    cuts = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(letters)]), np.searchsorted(edges, np.flatnonzero(begins), "right") - 1


def _added(texts: pa.Array, groups: np.ndarray) -> pa.Table:
    """``(group, term, n, docs)`` of some texts, each of the group at its place."""
    words, text = _words(texts)
    coded = words.dictionary_encode()
    size = max(len(coded.dictionary), 1)
    once, n = np.unique(text * size + coded.indices.to_numpy(), return_counts=True)
    keys, at = np.unique(groups[once // size] * size + once % size, return_inverse=True)
    return pa.table({"group": keys // size, "term": coded.dictionary.take(pa.array(keys % size)), "n": np.bincount(at, n).astype(np.int64), "docs": np.bincount(at).astype(np.int64)})


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, source, term, n, docs)`` added up within a task, and a row without a term for each source."""
    known: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])

    def handed_on() -> Iterator[pa.RecordBatch]:
        found = pa.concat_tables([pa.table({"group": range(len(known)), "term": pa.nulls(len(known), pa.binary()), "n_sum": [0] * len(known), "docs_sum": [0] * len(known)}), summed().select(["group", "term", "n_sum", "docs_sum"])])
        lang, source = (pa.array(names, pa.string()).take(found["group"]) for names in zip(*known, strict=True))
        yield from pa.table({"lang": lang, "source": source, "term": found["term"].cast(pa.string()), "n": found["n_sum"], "docs": found["docs_sum"]}).to_batches(max_chunksize=OUT)
        known.clear()
        held.clear()

    for batch in filter(len, batches):
        texts = batch.column("text").cast(pa.string())
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts)]
        cuts = [0, *(np.flatnonzero(np.diff(edges // CHUNK)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            names = zip(batch.column("lang")[a:b].to_pylist(), batch.column("source")[a:b].to_pylist(), strict=True)
            held.append(_added(texts[a:b], np.array([known.setdefault(k, len(known)) for k in names], np.int64)))
            if sum(map(len, held)) + len(known) > HELD:
                total = summed()
                held[:] = [total.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])]
                if len(total) + len(known) > HELD // 2:
                    yield from handed_on()
    if known:
        yield from handed_on()


def _share(n: str, total: str, size: str) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 size)), exactly: in longs where the product is one, else in decimals."""
    whole = f"CAST({total} + 5 * {size} AS DECIMAL(20, 0))"
    return F.expr(f"1 + CASE WHEN {n} < {LONG} THEN (1000000000L * ({n} + 5)) div ({total} + 5 * {size}) ELSE (CAST(1000000000 AS DECIMAL(20, 0)) * CAST({n} + 5 AS DECIMAL(18, 0))) div {whole} END")


def _scanned(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` as tasks hand them on, and rows without a term.

    Documents are dealt by language and source first, a large source to several tasks, so that a task adds up the words of few
    sources: it hands on a row for each of their words, not for each word of every source.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(text("lang"), text("source"), text("text"), F.monotonically_increasing_id().alias("at"))
    return rows.repartitionByRange(n, "lang", "source", "at").drop("at").mapInArrow(_counts, "lang string, source string, term string, n bigint, docs bigint")


def _counted(docs: DataFrame, least_docs: int) -> DataFrame:
    """``(lang, source, term, n, docs)`` of words that ``least_docs`` documents of their language have, and a row without a term for each source; rare words go no further."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_lang = F.sum("docs").over(Window.partitionBy("term", "lang"))  # rows are sorted by the key that differs
    common = _scanned(docs).repartition(n, "term", "lang").withColumn("lang_docs", of_lang).where((F.col("lang_docs") >= least_docs) | F.col("term").isNull())
    return common.groupBy("term", "lang", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).select("lang", "source", "term", "n", "docs")


def _ordered(counts: DataFrame, groups: DataFrame, least_docs: int) -> DataFrame:
    """``(lang, term, lang_n, pos)`` of kept words: positions in the order of their counts in the language's largest sources."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("tokens"), "source"))
    leading = groups.select("lang", "source", rank.alias("rank")).where(F.col("rank") <= LEADING)
    keys = [F.coalesce(F.max(F.when(F.col("rank") == k, F.col("n"))), F.lit(0)).alias(f"k{k}") for k in range(1, LEADING + 1)]
    words = counts.join(leading, ["lang", "source"], "left").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), *keys).where(F.col("docs") >= least_docs)
    by = ["lang", *[F.desc(f"k{k}") for k in range(1, LEADING + 1)], "term"]
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.repartitionByRange(n, *by).sortWithinPartitions(*by).select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("pos"))


def _columns(kept: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(lang, block, len, source, zero, runs)``: for each source and block the runs ``(start, len, p)`` of counts that aren't zero, in order, and p of the rest."""
    alone = Window.partitionBy("n", "block", "source", "lang").orderBy("pos")
    islands = kept.withColumn("island", F.col("pos") - F.row_number().over(alone))
    found = islands.groupBy("lang", "block", "source", "n", "island").agg(F.min("pos").alias("pos"), F.count("*").alias("len"))
    every = groups.join(blocks, "lang")
    rows = every.join(found, ["lang", "block", "source"], "left").withColumn("p", F.when(F.col("n").isNotNull(), _share("n", "total", "size")))
    run = F.when(F.col("n").isNotNull(), F.struct((F.col("pos") - F.col("first")).alias("start"), F.col("len").alias("len"), "p"))
    zero = F.when(F.col("size") > 0, _share("0", "total", "size")).otherwise(0)
    return rows.groupBy("lang", "block", "width", "source", zero.alias("zero")).agg(F.sort_array(F.collect_list(run)).alias("runs"))  # a block's words at most


def _filled(start: np.ndarray, length: np.ndarray, p: np.ndarray, zero: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and shares of a whole column, with the runs of zeros between the given ones."""
    ends = start + length
    gaps = np.concatenate([[0], ends])
    gaps = gaps[gaps != np.concatenate([start, [width]])]
    starts = np.concatenate([start, gaps])
    order = np.argsort(starts)
    return starts[order], np.concatenate([p, np.full(len(gaps), zero)])[order]


def _differences(left: tuple[np.ndarray, np.ndarray], rights: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """For each right column the sum over its runs, cut at the left column's, of length times difference."""
    own, p = left
    own_ends = np.append(own[1:], width)
    starts, q = (np.concatenate(x) for x in zip(*rights, strict=True))
    sizes = np.array([len(s) for s, _ in rights])
    lasts = np.cumsum(sizes) - 1
    ends = np.append(starts[1:], width)
    ends[lasts] = width
    first = np.searchsorted(own, starts, "right") - 1
    many = np.searchsorted(own, ends - 1, "right") - first
    run = np.repeat(np.arange(len(starts)), many)
    begun = np.cumsum(many) - many
    at = np.arange(len(run)) - begun[run] + first[run]
    length = np.minimum(own_ends[at], ends[run]) - np.maximum(own[at], starts[run])
    return np.add.reduceat(np.abs(p[at] - q[run]) * length, begun[lasts - sizes + 1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, a, b, value)`` of the pairs of sources of each tile in one block."""
    for part in runs(batches, "lang", "block", "cell"):
        width, names = part.column("width")[0].as_py(), part.column("source").to_pylist()
        lang, side = part.column("lang")[0].as_py(), part.column("side").to_numpy()
        columns = []
        if width:
            lists, zeros = part.column("runs"), part.column("zero").to_numpy()
            edges, flat = lists.offsets.to_numpy(), lists.values
            start, length, p = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "len", "p"))
            columns = [_filled(start[a:b], length[a:b], p[a:b], z, width) for a, b, z in zip(edges[:-1].tolist(), edges[1:].tolist(), zeros.tolist(), strict=True)]
        right = np.flatnonzero(side != 0)  # two stands on both sides
        for i in np.flatnonzero(side != 1).tolist():
            others = [j for j in right.tolist() if side[i] != 2 or j > i]
            if others:
                values = _differences(columns[i], [columns[j] for j in others], width) if width else np.zeros(len(others), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(others)), pa.array([names[i]] * len(others)), pa.array([names[j] for j in others]), pa.array(values, pa.int64())], names=["lang", "a", "b", "value"])


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return (ranked if most is None else ranked.where(F.col("rank") <= most)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for the sources of ``docs(text, lang, source)``.

    A language keeps the words of ``least_docs`` of its documents. A share is 1 + floor(10^9 (n + 5) / (N + 5 V)), N the kept words'
    occurrences and V how many are kept. ``pair``: a row for each other source of the language, the sum of the differences of all
    shares. ``term``: words that a source has more of than its language, to ``ranks``. Ties go by the item's bytes.

    Nulls are read as empty; an empty language or source is one as any other. Rows count as documents whatever their ids.
    A source without a kept word has zeros; a language that keeps none has pairs of value 0 and no words. A language of one
    source has no pairs. Other columns are ignored; an empty table gives no rows.
    """
    counted = stage(_counted(docs, least_docs), "counts")
    sources = counted.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    words = stage(_ordered(counted.where("term IS NOT NULL"), sources, least_docs), "vocabulary")
    placed = words.withColumn("block", F.expr(f"pos div {block}"))
    kept = stage(counted.where("term IS NOT NULL").join(placed, ["term", "lang"]).select("lang", "source", "term", "n", "lang_n", "block", "pos"), "kept")

    sizes = words.groupBy("lang").agg(F.count("*").alias("size"), F.sum("lang_n").alias("lang_total"))
    groups = stage(sources.withColumnRenamed("tokens", "total").join(sizes, "lang", "left").na.fill(0).select("lang", "source", "total", "size", "lang_total"), "sources")

    more = kept.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "total", "size"), "q": _share("lang_n", "lang_total", "size")})
    terms = more.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    spans = placed.groupBy("lang", "block").agg(F.min("pos").alias("first"), F.count("*").alias("width"))
    none = groups.where("size = 0").select("lang", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("width")).distinct()
    cuts = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
    columns = _columns(kept, groups, spans.unionByName(none)).join(cuts, "lang")
    own = F.pmod(F.xxhash64("source"), F.col("cuts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.struct((F.least(own, j) * F.col("cuts") + F.greatest(own, j)).alias("cell"), F.when(own == j, 2).when(own < j, 0).otherwise(1).cast("tinyint").alias("side")))
    tiles = columns.select("lang", "block", "width", "source", "zero", "runs", F.explode(cells).alias("c")).select("lang", "block", "c.cell", "c.side", "width", "source", "zero", "runs")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(n, "lang", "block", "cell").sortWithinPartitions("lang", "block", "cell")
    halves = dealt.mapInArrow(_pairs, "lang string, a string, b string, value bigint").select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value")
    sums = stage(halves.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    out = stage(_ranked(both, "pair").unionByName(_ranked(terms, "term", ranks)), "audit")
    for done in (counted, words, kept, groups, sums):
        drop_staged(done)
    return out
