"""Jaccard similarity join of word shingles by adaptive multi-match prefixes.

A text's shingle hashes are sorted. Two sets that have the similarity share at least l of the first p + l hashes of each, where p is
how many a set may lack; so a document can lengthen its prefix if it asks for more matches. A hash that many sets have is costly. A
document passes over those in its prefix, lengthens it by as many, and by some more where that makes its estimated candidates
cheaper, and a pair is a candidate if the hashes that both kept agree as often as the less demanding of the two asks for.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import LOWER, chunks, connected_components, drop_staged, forest, runs, stage
from tapeline.llm.minhash import _near, _spread

SHINGLE = 3
#: Least similarity in hundredths.
PERCENT = 90
SEED = 42
#: Sets that may share a hash before it counts as hot: pairs are made of colder ones only, so a row makes half as many at most.
HOT = 48
#: Matches beyond the hot ones that a document may ask for.
ASKED = (1, 2, 3, 4, 6, 8, 12, 16)
#: What it costs to compare one hash of a candidate, where meeting one candidate in a list costs 1.
COMPARE = 0.02
#: Sets, and bytes of them, that a task holds on each side of a comparison; a larger group is cut into squares of this side.
SIDE, SIDE_BYTES = 1_000, 8_000_000
#: Bytes of text whose words are hashed in one step.
STEP = 1 << 20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_DRAWN = np.random.default_rng(SEED)
#: A number for each byte, the same for a letter in both cases, and the powers of an odd number: a word's hash is their sum of products.
_BYTE = _DRAWN.integers(1, 2**64 - 1, 256, np.uint64)[np.frombuffer(LOWER, np.uint8)]
_POWER = np.cumprod(np.full(1 << 16, _A, np.uint64))
_IN_WORD = np.array([b not in b" \t\n\v\f\r" for b in range(256)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return (x ^ (x >> np.uint64(29))) * _A ^ (x >> np.uint64(32))


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin, and their hashes, all at once."""
    data, a = np.frombuffer(raw, np.uint8), 0
    starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    while a < len(data):
        b = min(a + STEP, len(data))
        if b < len(data):  # a word is never cut
            gap = np.flatnonzero(~_IN_WORD[data[a:b]])
            b = a + int(gap[-1]) + 1 if len(gap) else len(data)
        x = data[a:b]
        inside = _IN_WORD[x]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        first, many = edges[::2], edges[1::2] - edges[::2]
        if len(first):
            at = np.flatnonzero(inside) - np.repeat(first, many)
            starts.append(first + a)
            hashes.append(np.add.reduceat(_BYTE[x[inside]] * _POWER[at & 0xFFFF], np.cumsum(many) - many))
        a = b
    return np.concatenate(starts), np.concatenate(hashes)


def _shingled(h: np.ndarray, width: int) -> np.ndarray:
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _C + h[k : len(h) - width + 1 + k])
    return out


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of the lower-cased words' shingles; one of the whole text where it has fewer words."""
    out: list[np.ndarray] = []
    k = 0
    while k < len(texts):
        n, long = 0, 0
        while k + n < len(texts) and (not n or long < STEP):
            long += len(texts[k + n] or b"")
            n += 1
        part = [t or b"" for t in texts[k : k + n]]
        starts, h = _words(b" ".join(part))
        edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in part)])).tolist()
        full = _shingled(h, size) if len(h) >= size else None
        for a, b in zip(edges, edges[1:], strict=False):
            out.append(np.unique(full[a : b - size + 1] if b - a >= size else _shingled(h[a:b], b - a) if b > a else h[:0]))
        k += n
    return out


def spare(n: int, percent: int = PERCENT) -> int:
    """How many hashes of a set of ``n`` another may lack that has the similarity: n - ceil(percent n / 100)."""
    return n - -(-percent * n // 100)


def _pool(h: np.ndarray, percent: int) -> np.ndarray:
    """The longest prefix that the document may choose."""
    return h[: 2 * spare(len(h), percent) + 1]


def _described(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for ids, rids, texts in chunks(batches, "doc_id", "rid", "text"):
        sets = shingle_sets(texts, size)
        nodes = [_node(h) for h in sets]
        pools = [_pool(h, percent).view(np.int64) for h in sets]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(rids, pa.int64()), pa.array(nodes, pa.int64()), pa.array([len(h) for h in sets], pa.int64()), pa.array(pools, pa.list_(pa.int64())),
        ], names=["doc_id", "rid", "node", "n", "pool"])


def _node(h: np.ndarray) -> int | None:
    """What names a set; null for an empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(h.tobytes(), SEED)).view(np.int64)) if len(h) else None


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for nodes, texts in chunks(batches, "node", "text"):
        sets = shingle_sets(texts, size)
        true = [k for k, h in enumerate(sets) if _node(h) == nodes[k]]
        yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in true], pa.int64()), pa.array([sets[k].view(np.int64) for k in true], pa.list_(pa.int64()))], names=["node", "set"])


def prefix(n: int, pos: list[int], df: list[int], percent: int = PERCENT, hot: int = HOT) -> tuple[int, int] | None:
    """How many matches of cold hashes a set of ``n`` hashes asks for, and the length of its prefix. ``pos`` and ``df`` are of those hashes of
    its pool that other sets have too, in order.

    A prefix of p + l hashes with at most l - asked hot ones among them has p + asked cold ones. Of the numbers that fit, that
    of the least estimated cost is taken: candidates met in the lists, and a share of them to compare, as each must be met ``asked``
    times. None where even one doesn't fit: the set is mostly made of hot hashes. l is at most what the smallest partner's
    pool has, so that of every pair both pools hold the prefixes of the less demanding one.
    """
    p = spare(n, percent)
    room = 1 + spare(-(-percent * n // 100), percent)
    heat = [at - i for i, at in enumerate(at for at, d in zip(pos, df, strict=True) if d > hot)]
    met = [0, *accumulate(d - 1 if d <= hot else 0 for d in df)]
    best = None
    for asked in ASKED:
        many = p + asked + bisect_left(heat, p + asked)
        if many - p > room:
            break
        cost = met[bisect_left(pos, many)] * (1 + COMPARE * n / asked)
        if best is None or cost < best[0]:
            best = cost, asked, many
    return best and best[1:]


def _chosen(batches: Iterator[pa.RecordBatch], percent: int, hot: int) -> Iterator[pa.RecordBatch]:
    for part in batches:
        nodes, ns, lists = part.column("node"), part.column("n").to_pylist(), part.column("own")
        edges, flat = lists.offsets.to_pylist(), lists.values
        pos, df, token = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("pos", "df", "token"))
        asked, cold, first = [], [], []
        for n, a, b in zip(ns, edges, edges[1:], strict=False):
            own = prefix(n, pos[a:b].tolist(), df[a:b].tolist(), percent, hot)
            mild = df[a:b] <= hot
            asked.append(own and own[0])
            cold.append(token[a:b][mild & (pos[a:b] < own[1])] if own else token[a:b][mild])
            first.append(token[:0] if own else token[a:b][pos[a:b] <= spare(n, percent)])
        long = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([nodes, part.column("n"), pa.array(asked, pa.int64()), pa.array(cold, long), pa.array(first, long)], names=["node", "n", "asked", "cold", "first"])


def choose(shared: DataFrame, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """``(node, n, asked, cold, first)`` for each set of ``shared(node, n, own)``, ``own`` being an array of ``(pos, df, token)``: what :func:`prefix`
    takes, and the cold hashes in it. Where ``asked`` is null ``cold`` has all of the pool and ``first`` the first p + 1 hashes."""
    return shared.mapInArrow(lambda it: _chosen(it, percent, hot), "node bigint, n bigint, asked bigint, cold array<bigint>, first array<bigint>")


def _candidates(chosen: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of sets of which one at least isn't mostly hot, that share as many cold hashes as they ask for."""
    rows = chosen.select("node", "n", F.coalesce("asked", F.lit(2**30)).alias("asked"), F.explode("cold").alias("token"))
    left, right = (rows.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "asked")]) for s in "ab")
    sized = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    met = left.join(right, "token").where((F.col("node_a") < F.col("node_b")) & sized & (F.least("asked_a", "asked_b") < 2**30))
    pairs = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.count("*").alias("matches"), F.first(F.least("asked_a", "asked_b")).alias("asked"))
    return pairs.where("matches >= asked").select("a", "b")


def _hot_cells(chosen: DataFrame) -> DataFrame:
    """``(key, node)``: groups in which every two sets that are mostly hot, and that have the similarity, meet.

    They share one of their first p + 1 hashes. Lists of the same smallest set are one group, so near copies, whose lists nearly
    agree, are in a few groups and not in one for each hash.
    """
    rows = stage(chosen.where("asked IS NULL").select("node", F.explode("first").alias("token")), "hot")
    least = rows.groupBy("token").agg(F.min("node").alias("key"), F.count("*").alias("df")).where("df > 1").select("token", "key")
    cells = stage(rows.join(least, "token").select("key", "node").distinct(), "cells")
    drop_staged(rows)
    return cells


def _links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A forest of the links within each run of equal ``(key, cell)``, between its left and its right rows."""
    for part in runs(batches, "key", "cell"):
        nodes, side, lists = part.column("node").to_numpy(), part.column("side").to_numpy(), part.column("set")
        edges, flat = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
        found = [flat[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # two stands on both sides
        if len(left) and len(right):
            at, to = _near([found[i] for i in left], [found[i] for i in right], percent / 100)
            a, b = nodes[left[at]], nodes[right[to]]
            if (a != b).any():
                a, b = forest(a[a != b], b[a != b])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, hot: int = HOT, side: int = SIDE, side_bytes: int = SIDE_BYTES) -> DataFrame:
    """``(doc_id, rid, n_shingles, component_id)`` for each row of ``docs(doc_id, text)``; ``rid`` is a hash of the text.

    Two rows link where their sets of shingles have a Jaccard similarity of ``percent`` hundredths, and the component's id is its smallest
    doc_id. No link is lost: hashes have 64 bits, and every candidate is compared on its whole set. Equal sets are one node, so
    copies are never paired. Null and wordless texts have no shingle and link with nothing. Rows of equal doc_id each appear and link
    as their texts do; a component of rows without an id has a null id; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("rid"), "text")
    rows = stage(texts.mapInArrow(lambda it: _described(it, size, percent), "doc_id bigint, rid bigint, node bigint, n bigint, pool array<bigint>"), "rows")
    ids = rows.select("doc_id", "rid", "node", "n")
    nodes = stage(ids.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "rid")).alias("one")), "nodes")
    tokens = rows.where("n > 0").dropDuplicates(["node"]).select("node", "n", F.posexplode("pool").alias("pos", "token"))
    lists = stage(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "lists")
    held = tokens.join(lists, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "df", "token"))).alias("own"))  # a pool at most
    chosen = stage(choose(held, percent, hot), "chosen")
    drop_staged(lists)

    pairs = stage(_candidates(chosen, percent), "pairs")
    groups = _hot_cells(chosen)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(groups.select("node")).distinct()
    # one row of each node lends its text; how many do grows with the corpus, so they are never broadcast
    lent = wanted.join(nodes, "node").select("node", F.col("one.doc_id").alias("__id"), F.col("one.rid").alias("__rid"))
    read = texts.join(lent.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("rid") == F.col("__rid"))).select("node", "text").dropDuplicates(["node"])
    sets = stage(read.mapInArrow(lambda it: _sets(it, size), "node bigint, set array<bigint>"), "sets")

    both = F.size(F.array_intersect("set_a", "set_b"))
    one = lambda s: sets.select(F.col("node").alias(s), F.col("set").alias(f"set_{s}"))
    direct = pairs.join(one("a"), "a").join(one("b"), "b").where(both * 100 >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")
    placed = stage(_spread(groups.join(sets.select("node", (F.size("set") * 8).alias("long")), "node"), side, side_bytes), "placed")
    dealt = placed.join(sets, "node").repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")
    whole = connected_components(direct.unionByName(dealt.mapInArrow(lambda it: _links(it, percent), "a bigint, b bigint")))
    for done in (chosen, pairs, groups, sets, placed):
        drop_staged(done)

    of = nodes.join(whole, "node", "left").withColumn("root", F.coalesce("root", "node")).select("node", "root", "first_id")
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stage(of.join(least, "root").select("node", "component_id"), "components")  # a written side lets Spark split the join by node
    drop_staged(nodes)
    alone = ids.where("n = 0").withColumn("component_id", F.col("doc_id"))
    out = ids.where("n > 0").join(named, "node").select(*alone.columns).unionByName(alone)
    return out.select("doc_id", "rid", F.col("n").alias("n_shingles"), "component_id")
