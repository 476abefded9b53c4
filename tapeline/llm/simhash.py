"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm import minhash
from tapeline.llm._shared import LOWER, chunks, connected_components, drop_staged, forest, runs, stage

SHINGLE = 4
THRESHOLD = 4
SEED = 42
#: Covering radius of the code: a Hamming code on part of a block, all words on the rest.
RADIUS = 1
#: Members of one anchor that a task compares at once; a larger anchor is cut into squares of this side.
SQUARE = 20_000
#: Different fingerprints up to which three blocks cost less than two: with three each is placed at 36 anchors of 2^17, with two
#: at 172 of 2^27, so that an anchor has few members for many billions of them. The links are the same.
THREE_BLOCKS = 50_000_000
#: Pairs compared in one vectorised step.
STEP = 2_000_000


def fingerprint(raw: bytes | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased words' shingles; zero without words."""
    words = (raw or b"").translate(LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(flat, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-size] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 65_536):
        ones += np.unpackbits(h[k : k + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for ids, rids, texts in chunks(batches, "doc_id", "rid", "text"):
        fps = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rids, pa.int64()), pa.array(fps)], names=["doc_id", "rid", "fp"])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, rid, fp)``, a hash of the text and the fingerprint as a signed long, for each row of ``docs(doc_id, text)``."""
    return docs.select("doc_id", F.xxhash64("text").alias("rid"), "text").mapInArrow(lambda it: _fingerprints(it, size), "doc_id bigint, rid bigint, fp bigint")


@lru_cache
def covering_masks(bits: int, within: int) -> tuple[int, list[list[int]]]:
    """For a block of ``bits`` bits: the parity bits r of the Hamming code, and by syndrome the flips of up to ``within`` bits.

    The code is Hamming on the first 2^r - 1 bits and all words on the rest, so its covering radius is 1. Flips whose
    syndrome is that of a word turn the word into an anchor, so they list all anchors within that distance.
    """
    r = max(k for k in range(2, 7) if 2**k - 1 <= bits)
    out: list[list[int]] = [[] for _ in range(2**r)]
    for n in range(within + 1):
        for at in combinations(range(bits), n):
            syndrome = 0
            for i in at:
                syndrome ^= i + 1 if i < 2**r - 1 else 0
            out[syndrome].append(sum(1 << i for i in at))
    return r, out


def _anchor_rows(block: Column, bits: int, within: int, blocks: int, number: int) -> Column:
    """All anchors near a block's word, as structs (key, home); home marks one anchor within the covering radius.

    A key is the anchor and the number of its block.
    """
    r, masks = covering_masks(bits, within)
    checks = [sum(1 << i for i in range(2**r - 1) if (i + 1) >> j & 1) for j in range(r)]
    syndrome = sum((F.bit_count(block.bitwiseAND(F.lit(c))).bitwiseAND(F.lit(1)) * (1 << j) for j, c in enumerate(checks)), F.lit(0))
    table = F.array(*[F.array(*[F.lit(m).cast("long") for m in own]) for own in masks])
    near = F.get(table, syndrome)
    # the home anchor is reached by the first mask: no flip, or the one flip within the Hamming part
    return F.transform(near, lambda m, i: F.struct((block.bitwiseXOR(m) * blocks + number).alias("key"), (i == 0).alias("home")))


def _words(blocks: int, threshold: int) -> list[tuple[Column, int, int]]:
    """Of each block its word of ``fp``, its bits, and the distance within which a fingerprint is placed at anchors."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    bits = [b - a for a, b in zip(edges, edges[1:], strict=False)]
    return [(F.shiftrightunsigned("fp", edges[k]).bitwiseAND(F.lit((1 << bits[k]) - 1)), bits[k], RADIUS + threshold // blocks) for k in range(blocks)]


def _members(fps: DataFrame, blocks: int, threshold: int) -> DataFrame:
    """``(key, fp, home)``: each fingerprint at every anchor within covering radius plus the block's share of the threshold."""
    parts = [_anchor_rows(word, bits, within, blocks, k) for k, (word, bits, within) in enumerate(_words(blocks, threshold))]
    dealt = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")  # few bytes become many
    return dealt.select("fp", F.explode(F.concat(*parts)).alias("m")).select("m.key", "fp", "m.home")


def _hot(fps: DataFrame, blocks: int, threshold: int, square: int) -> DataFrame:
    """``(key, cuts)`` of anchors with more than ``square`` members.

    Fingerprints are counted by block word first: there are as many words as their bits allow, however many fingerprints.
    """
    counted = []
    for k, (word, bits, within) in enumerate(_words(blocks, threshold)):
        words = fps.groupBy(word.alias("word")).agg(F.count("*").alias("n"))
        counted.append(words.select("n", F.explode(_anchor_rows(F.col("word"), bits, within, blocks, k)).alias("m")).select("m.key", "n"))
    sums = reduce(DataFrame.unionByName, counted).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > square)
    return sums.select("key", F.ceil(F.col("n") / square).cast("int").alias("cuts"))


def _spread(members: DataFrame, hot: DataFrame) -> DataFrame:
    """Cut hot anchors into squares (i, j): home members of slice i meet members of slice j."""
    cut = members.join(hot, "key", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    each = F.sequence(F.lit(0), F.col("cuts") - 1)
    row = lambda cell, home, member: F.struct(cell.alias("cell"), home.alias("home"), member.alias("member"))
    as_member = F.transform(each, lambda i: row(i * F.col("cuts") + own, F.lit(False), F.lit(True)))
    as_home = F.transform(each, lambda j: row(own * F.col("cuts") + j, F.lit(True), F.lit(False)))
    whole = F.array(row(F.lit(0), F.col("home"), F.lit(True)))
    rows = F.when(F.col("cuts") == 1, whole).when(F.col("home"), F.concat(as_member, as_home)).otherwise(as_member)
    return cut.select("key", "fp", F.explode(rows).alias("c")).select("key", "c.cell", "fp", "c.home", "c.member")


def _compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray, is_member: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal ``key``: every home row against every member row of its run."""
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    run = np.repeat(np.arange(len(starts)), sizes)
    homes = np.flatnonzero(home & (sizes[run] > 1))
    if not len(homes):
        return
    work = np.cumsum(sizes[run[homes]])
    for k in range(int(work[-1] // STEP) + 1):
        part = homes[slice(*np.searchsorted(work, [k * STEP, (k + 1) * STEP], "right"))]
        if not len(part):
            continue
        n = sizes[run[part]]
        left = np.repeat(part, n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[run[part]], n)
        near = (np.bitwise_count(fp[left] ^ fp[right]) <= threshold) & (fp[left] != fp[right]) & is_member[right]
        if near.any():
            yield forest(fp[left[near]].view(np.int64), fp[right[near]].view(np.int64))


def _links(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Links of whole runs of equal (key, cell), many small ones at a time; a run is at most a square's two sides."""
    for part in runs(batches, "key", "cell", together=True):
        col = lambda c: part.column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
        keys = np.stack([col("key"), col("cell").astype(np.int64)], 1)
        for a, b in _compare(keys, col("fp").view(np.uint64), col("home"), col("member"), threshold):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fps: DataFrame, threshold: int = THRESHOLD, blocks: int | None = None, square: int = SQUARE) -> DataFrame:
    """A forest ``(a, b)`` of links between the different fingerprints of ``fps(fp)`` at ``threshold`` or fewer differing bits.

    Two such fingerprints differ in at most threshold // blocks bits of some block. There the first's home anchor, within
    the covering radius, is within radius plus that many bits of the second, so they meet. An anchor yields a forest, not
    its pairs; components of the forest are those of all links. ``blocks`` is chosen by the number of fingerprints.
    """
    blocks = blocks or (3 if fps.count() <= THREE_BLOCKS else 2)
    spread = _spread(_members(fps, blocks, threshold), _hot(fps, blocks, threshold, square))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartition(n, "key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(lambda it: _links(it, threshold), "a bigint, b bigint")


def _placed(docs: DataFrame, threshold: int, size: int, blocks: int | None) -> DataFrame:
    """``(doc_id, rid, fp, component_id)`` for each row."""
    rows = stage(fingerprints(docs, size), "fingerprints")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    roots = connected_components(links(fps, threshold, blocks)).select(F.col("node").alias("fp"), "root")
    placed = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = stage(placed.join(least, "root").select("fp", "component_id"), "components")  # a written side lets Spark split the join by fingerprint
    drop_staged(fps)
    return rows.join(of, "fp")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE, blocks: int | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs(doc_id, text)``.

    Links join fingerprints at ``threshold`` or fewer differing bits, and the component's id is its smallest doc_id. Null,
    empty and wordless texts have fingerprint zero and link like any other. Equal fingerprints are one node, so copies
    are never paired. Rows of equal doc_id each appear; other columns are ignored; an empty table gives an empty result.
    """
    return _placed(docs, threshold, size, blocks).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def component_keys(nodes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(node, key)`` of ``nodes(node, fp)``: nodes whose fingerprints are in one component of :func:`links` share a key."""
    fps = stage(nodes.select("fp").distinct(), "fps")
    roots = connected_components(links(fps, threshold)).select(F.col("node").alias("fp"), "root")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return placed.select("node", F.xxhash64(F.lit("simhash"), "root").alias("key")).distinct()


def keep_one(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """``docs`` without the near-duplicates: of each component the document of the smallest doc_id stays, with all columns.

    Links are those of fingerprints at ``threshold``. With ``similarity`` the texts of a component of them, and those that share
    a band of MinHash values, which reaches the similar texts whose fingerprints differ in more bits, are compared exactly, and
    links are those of their shingles at that Jaccard similarity (:mod:`minhash`). Texts without a word are one group. Rows of equal doc_id are told apart by their texts;
    equal rows of the document that stays all stay, and so do rows without an id.
    """
    if similarity is None:
        parts = _placed(docs, threshold, size, None)
    else:
        parts = minhash.near_duplicates(docs, similarity, size, fingerprint=fingerprint, linked=lambda nodes: component_keys(nodes, threshold))
    gone = stage(parts.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"), F.col("rid").alias("__rid")).distinct(), "gone")
    # how many go grows with the corpus, so they are never broadcast
    return docs.join(gone.hint("merge"), (docs["doc_id"] == gone["__gone"]) & (F.xxhash64(docs["text"]) == gone["__rid"]), "left_anti")
