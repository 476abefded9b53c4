"""Incremental substring deduplication on a log-structured index of window fingerprints.

A window of 13 words has as fingerprint the least hash of its 6-word parts (winnowing), so that equal windows have equal
fingerprints and neighbouring windows mostly share theirs: about 0.22 fingerprints a word instead of one hash a word, and no
window is lost. The index keeps the distinct fingerprints of all documents seen in sorted immutable runs, bucketed by
fingerprint. A batch becomes a run; it is merge-joined with each older run, what they share is verified on 128-bit hashes of
whole windows, and full levels are merged into one run of the next level.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.llm._shared import chunks, drop_staged, stage
from tapeline.sources.paths import fresh_path

WINDOW = 13
#: Words of the parts whose least hash stands for a window.
PART = 6
#: Runs of one level that are compacted into one of the next.
FANOUT = 2
#: Batches of :func:`deduplicate`: so many that two levels fill.
BATCHES = 4

_MIX = [np.array([xxhash.xxh64_intdigest(b"%d" % i, s) | 1 for i in range(64)], np.uint64) for s in (1, 2, 3)]


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(hashes: np.ndarray, size: int, mix: np.ndarray) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes: a sum with random odd factors, mixed once more."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += hashes[j : j + n] * mix[j]
    return _finish(out)


class _Chunk:
    """Two independent hashes of each word of some texts in one array, so that each step is one pass over all of them."""

    def __init__(self, texts: list[bytes | None], window: int, part: int):
        words = [(t or b"").split() for t in texts]
        self.window = window
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        flat = [w for own in words for w in own]
        self.hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, flat)), ">u8").astype(np.uint64).reshape(-1, 2)
        n_windows = np.maximum(self.sizes - window + 1, 0)
        first = np.cumsum(self.sizes) - self.sizes
        #: of every window: its text, its place in the text and in the array
        self.text = np.repeat(np.arange(len(texts)), n_windows)
        self.pos = np.arange(len(self.text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        self.at = self.pos + first[self.text]
        self.anchors = np.empty(0, np.uint64)
        if len(self.text):
            parts = _rolling(self.hashes[:, 0], part, _MIX[0])
            least = parts
            for j in range(1, window - part + 1):
                least = np.minimum(least[:-1], parts[j:])
            self.anchors = least[self.at]

    def windows(self, which: np.ndarray, half: int) -> np.ndarray:
        """A hash of whole windows from one of the two word hashes."""
        return _rolling(self.hashes[:, half], self.window, _MIX[1 + half])[self.at[which]]


def _postings(batches: Iterator[pa.RecordBatch], window: int, part: int) -> Iterator[pa.RecordBatch]:
    for ids, rids, texts in chunks(batches, "doc_id", "rid", "text"):
        c = _Chunk(texts, window, part)
        if not len(c.anchors):
            continue
        new = np.concatenate([[True], (c.anchors[1:] != c.anchors[:-1]) | (c.text[1:] != c.text[:-1])])  # neighbours mostly share theirs
        text, anchor = c.text[new], c.anchors[new]
        order = np.lexsort((anchor, text))
        text, anchor = text[order], anchor[order]
        once = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        text, anchor = text[once], anchor[once]
        long = np.flatnonzero(c.sizes >= window)
        whole = [xxhash.xxh3_128_intdigest(b" ".join(c.words[i])) for i in long]
        h = np.concatenate([anchor, np.array([w & (2**64 - 1) for w in whole], np.uint64)])
        kind = np.concatenate([np.zeros(len(anchor), np.uint64), np.array([w >> 64 | 1 for w in whole], np.uint64)])
        of = np.concatenate([text, long])
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(kind.view(np.int64)), pa.array(np.array(ids, np.int64)[of]), pa.array(np.array(rids, np.int64)[of])], names=["h", "whole", "doc_id", "rid"])


#: Candidate windows that a task compares among themselves before it passes them on.
HELD = 500_000


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values.astype(np.int32)))


NAMES = ["a", "b", "doc_id", "rid", "pos", "late"]


def _settled(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Windows to compare with other tasks', one row for each with its places in the first row of its first document, and
    those that are settled: in a later document they are late, in another row of the first document they wait for the same
    verdict. This keeps a window that very many documents share, or one document repeats, from meeting in one task."""
    a, b, docs, rids, pos = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((pos, rids, docs, b, a))
    a, b, docs, rids, pos = a[order], b[order], docs[order], rids[order], pos[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = docs[new][np.cumsum(new) - 1] == docs
    row = np.concatenate([[True], new[1:] | (docs[1:] != docs[:-1]) | (rids[1:] != rids[:-1])])
    at = row[first]
    starts = np.flatnonzero(at)
    own = np.flatnonzero(first)[at]
    yield pa.RecordBatch.from_arrays([pa.array(a[own].view(np.int64)), pa.array(b[own].view(np.int64)), pa.array(docs[own]), pa.array(rids[own]), _lists(pos[first], starts), pa.array(np.zeros(len(own), bool))], names=NAMES)
    docs, rids, pos = docs[~first], rids[~first], pos[~first]
    if len(docs):
        order = np.lexsort((rids, docs))
        docs, rids, pos = docs[order], rids[order], pos[order]
        starts = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (rids[1:] != rids[:-1])]))
        k = len(starts)
        yield pa.RecordBatch.from_arrays([pa.array(docs[starts]), pa.array(np.arange(k)), pa.array(docs[starts]), pa.array(rids[starts]), _lists(pos, starts), pa.array(np.ones(k, bool))], names=NAMES)


def _windows(batches: Iterator[pa.RecordBatch], window: int, part: int) -> Iterator[pa.RecordBatch]:
    """Two hashes of each whole window whose fingerprint is a candidate of its row."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for ids, rids, texts, wanted in chunks(batches, "doc_id", "rid", "text", "hs"):
        c = _Chunk(texts, window, part)
        # a text's own candidates: the text is mixed in; a chance hit is one more window to compare
        salt = _finish(np.arange(1, len(texts) + 1, dtype=np.uint64))
        keys = np.array([h for own in wanted for h in own], np.int64).view(np.uint64) ^ np.repeat(salt, [len(own) for own in wanted])
        which = np.flatnonzero(np.isin(c.anchors ^ salt[c.text], keys))
        held.append((c.windows(which, 0), c.windows(which, 1), np.array(ids, np.int64)[c.text[which]], np.array(rids, np.int64)[c.text[which]], c.pos[which]))
        n += len(which)
        if n >= HELD:
            yield from _settled(held)
            held, n = [], 0
    if n:
        yield from _settled(held)


def covered(n: int, starts: list[int], window: int) -> np.ndarray:
    """Which of n words a window at one of ``starts`` covers."""
    at = np.array(starts, np.int64)
    edge = np.zeros(n + window + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[:n] > 0


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _remove(batches: Iterator[pa.RecordBatch], window: int, texts_too: bool) -> Iterator[pa.RecordBatch]:
    for ids, texts, copies, hits in chunks(batches, "doc_id", "text", "is_copy", "starts"):
        out = []
        for doc_id, raw, copy, starts in zip(ids, texts, copies, hits, strict=True):
            words = (raw or b"").split()
            n = len(words)
            if copy and n >= window:
                words = []
            elif starts:
                gone = covered(n, starts, window)
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            out.append((doc_id, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if texts_too else None))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), OUT, strict=True)], schema=OUT)


KEY, ROW = ["h", "whole"], ["doc_id", "rid"]


def _named(docs: DataFrame) -> DataFrame:
    """Rows with an id, and ``rid``, which tells rows of one doc_id with different texts apart."""
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("rid"), "text")


class FingerprintIndex:
    """Runs ``(h, whole, lo, many)`` of distinct fingerprints in the shared folder, and the operations on them.

    ``whole`` is zero for a window's fingerprint; a row of another value is the 128-bit hash of a whole text, by which copies
    are found without their windows. ``lo`` is the smallest doc_id that has the fingerprint, ``many`` says whether others do.
    As a run has each fingerprint once, however many documents share it, no bucket is larger than others. Which documents
    have a fingerprint is kept apart, in the order in which the texts were read (``postings``).
    """

    def __init__(self, spark: SparkSession, window: int = WINDOW, part: int = PART, fanout: int = FANOUT):
        self.spark, self.window, self.part, self.fanout = spark, window, part, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.postings: list[DataFrame] = []
        self.compactions = 0

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> DataFrame:
        """A run: one file for each bucket, sorted by fingerprint, so that merge joins need no exchange."""
        name, path = f"run_{uuid.uuid4().hex}", fresh_path(self.spark, "run")
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        run = self.spark.table(name)
        run.staged_path, run.name = path, name
        return run

    def _drop(self, run: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run.name}")
        drop_staged(run)

    def build_run(self, batch: DataFrame) -> DataFrame:
        """The batch's run; its postings join those of the index."""
        window, part = self.window, self.part
        own = stage(_named(batch).mapInArrow(lambda it: _postings(it, window, part), "h bigint, whole bigint, doc_id bigint, rid bigint"), "postings")
        self.postings.append(own)
        once = own.groupBy(*KEY).agg(F.min("doc_id").alias("lo"), (F.min("doc_id") < F.max("doc_id")).alias("many"))
        return self._write(once.repartition(self.buckets, *KEY))

    def shared(self, new: DataFrame) -> DataFrame:
        """``(h, whole, lo)`` of the new run's fingerprints that another document has, in the run or in the index."""
        found = [new.where("many").select(*KEY, "lo")]
        for run in self.runs:
            found.append(new.select(*KEY, F.col("lo").alias("__lo")).join(run.select(*KEY, "lo"), KEY).select(*KEY, F.least("lo", "__lo").alias("lo")))
        return reduce(DataFrame.unionByName, found)

    def insert(self, run: DataFrame) -> None:
        """Add a run and compact every level that is full."""
        level = 0
        self.levels[0].append(run)
        while len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            merged = self._write(reduce(self._merged, full))
            self.compactions += 1
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            for old in full:
                self._drop(old)
            level += 1

    @staticmethod
    def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one by a full merge join, bucket by bucket, without an exchange."""
        other = b.select(*KEY, F.col("lo").alias("__lo"), F.col("many").alias("__many"))
        many = F.coalesce("many", F.lit(False)) | F.coalesce("__many", F.lit(False)) | F.coalesce(F.col("lo") != F.col("__lo"), F.lit(False))
        return a.join(other, KEY, "full").select(*KEY, F.least("lo", "__lo").alias("lo"), many.alias("many"))

    def drop(self) -> None:
        """Delete all runs and postings; results that were returned before don't read them."""
        for run in self.runs:
            self._drop(run)
        for own in self.postings:
            drop_staged(own)
        self.levels, self.postings = [[]], []

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch of documents, all of larger doc_id than those seen. Returns what it shares with them or within itself,
        written: the fingerprints that :meth:`without` verifies."""
        new = self.build_run(batch)
        found = stage(self.shared(new), "shared")
        self.insert(new)
        return found

    def without(self, found: list[DataFrame], seen: DataFrame, batch: DataFrame, texts: bool = True) -> DataFrame:
        """The batch's rows without the windows that a document of smaller doc_id has, as :func:`deduplicate` returns them.

        ``found`` is what :meth:`add` returned for the batch, or for several that are judged together; ``seen`` has the texts
        of all documents in the index that may share a window with it, the batch included. Shared fingerprints are
        verified on whole windows of the rows that have them. Joins of postings can be split by Spark where a fingerprint is
        in very many documents, as both sides are written tables.
        """
        window, part = self.window, self.part
        keys = stage(reduce(DataFrame.unionByName, found).groupBy(*KEY).agg(F.min("lo").alias("lo")), "keys")
        hits = reduce(DataFrame.unionByName, self.postings).join(keys, KEY)
        copy = F.max((F.col("whole") != 0) & (F.col("doc_id") > F.col("lo")))
        marks = stage(hits.groupBy(*ROW).agg(copy.alias("is_copy"), F.collect_list(F.when(F.col("whole") == 0, F.col("h"))).alias("hs")), "marks")  # a row's own
        drop_staged(keys)
        rows = _named(seen)
        compared = rows.join(marks.where("NOT is_copy AND size(hs) > 0").drop("is_copy"), ROW).mapInArrow(lambda it: _windows(it, window, part), "a bigint, b bigint, doc_id bigint, rid bigint, pos array<int>, late boolean")
        ordered = Window.partitionBy("late", "a", "b").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        late = compared.withColumn("first", F.first("doc_id").over(ordered)).where("late OR doc_id > first")
        hit = late.groupBy(*ROW).agg(F.flatten(F.collect_list("pos")).alias("starts")).select(*ROW, F.lit(False).alias("is_copy"), "starts")
        flags = hit.unionByName(marks.where("is_copy").select(*ROW, "is_copy", F.array().cast("array<int>").alias("starts")))
        out = _removed(_named(batch).join(flags, ROW, "left"), window, texts)
        nobody = batch.where("doc_id IS NULL").select("doc_id", "text", F.lit(False).alias("is_copy"), F.array().cast("array<int>").alias("starts"))
        return out.unionByName(_removed(nobody, window, texts))


def _removed(marked: DataFrame, window: int, texts: bool) -> DataFrame:
    return marked.select("doc_id", "text", "is_copy", "starts").mapInArrow(lambda it: _remove(it, window, texts), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def deduplicate(docs: DataFrame, batches: int = BATCHES, window: int = WINDOW, part: int = PART, texts: bool = True) -> DataFrame:
    """Remove from each document the words of windows that a document of smaller doc_id has.

    ``docs(doc_id, text)`` is dealt to ``batches`` ranges of doc_id, which are indexed one after the other; the texts are
    read again once, to verify what all of them share. One row per input row: n_words, n_removed, kept_sha256 and, unless
    ``texts`` is false, the kept words joined by a space. Windows are judged on the input. Rows of equal doc_id are one
    document, so they take nothing from each other; each loses its own covered words. Rows without an id are nobody's earlier
    document and lose nothing. Null, empty and short texts have no window and lose nothing. Other columns are ignored.
    The index holds winnowed fingerprints of windows, not all their hashes; see the module.
    """
    docs = docs.select("doc_id", "text")
    cuts = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, cuts)), F.lit(10_000)).alias("q")).first()["q"] if cuts else []
    bounds = [None, *sorted(set(bounds or [])), None]
    index = FingerprintIndex(docs.sparkSession, window, part)
    found = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        batch = docs if low is None else docs.where(F.col("doc_id") > low)
        found.append(index.add(batch if high is None else batch.where(F.col("doc_id") <= high)))
    out = index.without(found, docs, docs, texts)
    index.drop()
    return out
