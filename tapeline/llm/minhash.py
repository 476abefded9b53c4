"""Near-duplicates at a Jaccard similarity of word shingles: candidates by MinHash bands, compared exactly on their whole texts.

:mod:`tapeline.llm.simhash` takes its links from here where a similarity is asked for. Texts of similarity 0.8 differ in about
ten of 64 SimHash bits, more than a covering code can reach with a bounded number of anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import LOWER, chunks, connected_components, drop_staged, forest, runs, stage

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: Texts at similarity 0.8 share none of 24 bands of five hashes with probability 7e-5; at 0.9 with 1e-9.
BANDS = 24
ROWS = 5
#: Hashes of a signature computed in one vectorised step.
STEP = 4096
#: Texts, and bytes of them, that a task holds on each side of a comparison; a larger group is cut into squares of this side.
SIDE, SIDE_BYTES = 1_000, 8_000_000

_DRAWN = np.random.default_rng(SEED)
_FACTORS = _DRAWN.integers(1, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _DRAWN.integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingles(raw: bytes | None, size: int = SHINGLE) -> set[bytes]:
    """The lower-cased words' shingles; the whole text where it has fewer words, none without words."""
    words = (raw or b"").translate(LOWER).split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def signature(raw: bytes | None, size: int = SHINGLE) -> tuple[int, list[int]]:
    """A digest of the text's set of shingles, zero without words, and the keys of its bands."""
    own = shingles(raw, size)
    if not own:
        return 0, []
    h = np.sort(np.array([xxhash.xxh64_intdigest(s, SEED) for s in own], np.uint64))
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for k in range(0, len(h), STEP):
        x = h[k : k + STEP, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, (x ^ x >> np.uint64(32)).min(0))
    keys = [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]
    return xxhash.xxh64_intdigest(h.tobytes(), SEED), keys


def _signatures(batches: Iterator[pa.RecordBatch], size: int, fingerprint: Callable[[bytes | None, int], int]) -> Iterator[pa.RecordBatch]:
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    for ids, rids, texts in chunks(batches, "doc_id", "rid", "text"):
        out = [signature(t, size) for t in texts]
        nodes, keys = [signed(n) for n, _ in out], [[signed(k) for k in ks] for _, ks in out]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array([signed(fingerprint(t, size)) for t in texts], pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "rid", "node", "keys", "fp", "text"])


def _hashes(raw: bytes, size: int) -> np.ndarray:
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles(raw, size)), np.uint64))


def _near(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The places of all pairs of a left and a right set that have the similarity, by counting common hashes."""
    n = np.array([len(x) for x in right])
    values = np.concatenate(right)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(right)), n)[order]
    at, to = [], []
    for i, own in enumerate(left):
        first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        many = last - first
        places = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        both = np.bincount(owner[places], minlength=len(right))
        near = np.flatnonzero(both >= similarity * (len(own) + n - both) - 1e-9)
        at.append(np.full(len(near), i))
        to.append(near)
    return np.concatenate(at), np.concatenate(to)


def _links(batches: Iterator[pa.RecordBatch], similarity: float, size: int) -> Iterator[pa.RecordBatch]:
    """A forest of the links within each run of equal ``(key, cell)``, between its left and its right rows."""
    for part in runs(batches, "key", "cell"):
        nodes, side = part.column("node").to_numpy(), part.column("side").to_numpy()
        found = [_hashes(t, size) for t in part.column("text").to_pylist()]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # two stands on both sides
        at, to = _near([found[i] for i in left], [found[i] for i in right], similarity) if len(left) and len(right) else (np.empty(0, int), np.empty(0, int))
        a, b = nodes[left[at]], nodes[right[to]]
        if (a != b).any():
            a, b = forest(a[a != b], b[a != b])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _groups(keys: DataFrame) -> DataFrame:
    """Of ``keys(node, key)`` those keys that several nodes have, one of those that have the same nodes."""
    marks = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("x"))
    once = marks.where("n > 1").groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key")).select("key")
    return keys.join(stage(once, "groups"), "key")


def _spread(members: DataFrame, side: int, side_bytes: int) -> DataFrame:
    """Groups of ``members(key, node, text)`` in cells: a group of over ``side`` texts or ``side_bytes`` is cut into slices, and
    every two slices meet in a cell. Rows have ``side`` 0 or 1, or 2 in the cell of their own slice."""
    cuts = F.ceil(F.greatest(F.count("*") / side, F.sum("long") / side_bytes)).cast("int")
    large = stage(members.groupBy("key").agg(cuts.alias("cuts")).where("cuts > 1"), "large")
    cut = members.join(large, "key", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.struct((F.least(own, j) * F.col("cuts") + F.greatest(own, j)).alias("cell"), F.when(own == j, 2).when(own < j, 0).otherwise(1).cast("tinyint").alias("side")))
    return cut.select("key", "node", F.explode(cells).alias("c")).select("key", "c.cell", "c.side", "node")


def _none(raw: bytes | None, size: int) -> int:
    return 0


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, side: int = SIDE, side_bytes: int = SIDE_BYTES,
    fingerprint: Callable[[bytes | None, int], int] = _none, linked: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(doc_id, rid, component_id)`` for each row of ``docs(doc_id, text)``; ``rid`` is a hash of the text.

    Links join texts whose sets of shingles have the similarity and share a band, and the component's id is its smallest
    doc_id. Equal sets are one node, so copies are never compared; texts without a word are one node. The texts that share
    a band key meet in a task, a large group in squares, where all pairs are compared by counting common shingles; what
    comes out is a forest, not its pairs. ``linked`` makes further groups ``(node, key)`` from ``(node, fp)``, the ``fingerprint`` of
    the texts; texts of such a group are compared likewise.
    """
    ddl = "doc_id bigint, rid bigint, node bigint, keys array<bigint>, fp bigint, text binary"
    rows = stage(docs.select("doc_id", F.xxhash64("text").alias("rid"), "text").mapInArrow(lambda it: _signatures(it, size, fingerprint), ddl), "signatures")
    ids = stage(rows.select("doc_id", "rid", "node"), "ids")
    nodes = ids.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "rid")).alias("one"))
    keys = rows.select("node", "keys").distinct().select("node", F.explode("keys").alias("key"))
    if linked:
        keys = stage(keys.unionByName(linked(rows.where("node <> 0").select("node", "fp").distinct())), "keys")
    shared = stage(_groups(keys), "shared")
    if linked:
        drop_staged(keys)
    # one row of each node lends its text; how many do grows with the corpus, so they are never broadcast
    lent = shared.select("node").distinct().join(nodes, "node").select(F.col("node").alias("__node"), F.col("one.doc_id").alias("__id"), F.col("one.rid").alias("__rid"))
    texts = stage(rows.join(lent.hint("merge"), (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("rid") == F.col("__rid"))).select("node", "text").dropDuplicates(["node"]), "texts")
    drop_staged(rows)
    sized = shared.join(texts.select("node", F.octet_length("text").alias("long")), "node")
    placed = stage(_spread(sized, side, side_bytes), "placed")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.join(texts, "node").repartition(n, "key", "cell").sortWithinPartitions("key", "cell")
    whole = connected_components(dealt.mapInArrow(lambda it: _links(it, similarity, size), "a bigint, b bigint"))
    for done in (shared, texts, placed):
        drop_staged(done)
    of = nodes.join(whole, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return ids.join(of.join(least, "root").select("node", "component_id"), "node").select("doc_id", "rid", "component_id")
