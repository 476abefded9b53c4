"""Benchmark decontamination with an Aho-Corasick automaton over normalised test passages."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import chunks, rows, stage

WINDOW = 10
#: Words of the benchmark that one automaton holds, about: some 900 bytes of a worker's memory for each. A larger benchmark
#: is cut into blocks, which scan one after the other.
BLOCK_WORDS = 200_000

#: Lower-cases A-Z and turns every byte outside of words into a space. Bytes of non-ASCII characters belong to words.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[^ ]+")

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

FOUND = [("hit_words", pa.list_(pa.int32())), ("item_ids", pa.list_(pa.string()))]
PART = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), *FOUND])
WHOLE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), *FOUND, ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
PART_DDL = "doc_id bigint, text string, hit_words array<int>, item_ids array<string>"
WHOLE_DDL = "doc_id bigint, n_words bigint, hit_words array<int>, item_ids array<string>, spans array<struct<start:bigint,end:bigint>>"

Items = list[tuple[str, list[str]]]


@dataclass(frozen=True)
class Machine:
    """An automaton over words. Each word of the benchmark has a code of ``width`` characters, so that a window takes few
    states; other words have a character that no window has. Values are (words, item ids)."""

    automaton: ahocorasick.Automaton
    codes: dict[bytes, str]
    width: int

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """``(last word, number of words, item ids)`` of each window that occurs; codes are met at their own places only."""
        if not words or not self.codes:
            return
        text = "".join(map(self.codes.get, words, repeat("\0" * self.width)))
        for end, (n, ids) in self.automaton.iter(text):
            if end % self.width == self.width - 1:
                yield end // self.width, n, ids


_built: dict[str, Machine] = {}


def _machine(items: Items, size: int) -> Machine:
    key = hashlib.sha256(repr((items, size)).encode()).hexdigest()
    if key not in _built:
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in items for w in words))}
        width = 1
        while 255**width < len(vocabulary):
            width += 1
        codes = {w: "".join(chr(1 + i // 255**k % 255) for k in range(width)) for w, i in vocabulary.items()}
        of: dict[tuple[str, int], set[str]] = {}
        for item, words in items:
            own = [codes[w] for w in words]
            for i in range(max(1, len(own) - size + 1)):
                of.setdefault(("".join(own[i : i + size]), min(size, len(own))), set()).add(item)
        automaton = ahocorasick.Automaton()
        for (window, n), ids in of.items():
            automaton.add_word(window, (n, tuple(ids)))
        if of:
            automaton.make_automaton()
        _built.clear()
        _built[key] = Machine(automaton, {w.encode(): c for w, c in codes.items()}, width)
    return _built[key]


def _char_spans(raw: bytes, flat: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as character offsets of the original text."""
    at = np.array([m.span() for m in WORD.finditer(flat)])
    char = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(char[at[a, 0]]), "end": int(char[at[b - 1, 1]])} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _scan(batches: Iterator[pa.RecordBatch], items: Items, size: int, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    """Adds a block's hits to those of the blocks before; the last block's rows have spans instead of the text."""
    machine = _machine(items, size)
    for ids, texts, *before in chunks(batches, "doc_id", "text", *([] if first else ["hit_words", "item_ids"])):
        out = []
        for doc_id, raw, held, had in zip(ids, texts, *(before or [repeat(()), repeat(())]), strict=bool(before)):
            flat = (raw or b"").translate(NORMAL)
            words = flat.split()
            edges = np.zeros(len(words) + 1, np.int32)
            found = set(had)
            for k, n, its in machine.matches(words):
                edges[k - n + 1] += 1
                edges[k + 1] -= 1
                found.update(its)
            covered = np.cumsum(edges)[:-1] > 0
            covered[list(held)] = True
            row = {"doc_id": doc_id, "hit_words": np.flatnonzero(covered).tolist(), "item_ids": sorted(found)}
            out.append(row | ({"n_words": len(words), "spans": _char_spans(raw, flat, covered) if covered.any() else []} if last else {"text": None if raw is None else raw.decode()}))
        yield pa.RecordBatch.from_pylist(out, schema=WHOLE if last else PART)


def _blocks(benchmark: DataFrame, size: int, block_words: int) -> tuple[int, Iterator[Items]]:
    """The number of blocks, at least one, and their items, a block at a time on the driver.

    A hash deals pieces of items to blocks: so many words of an item that each window starts in one piece.
    """
    words: Column = F.regexp_extract_all(F.translate("text", *LETTERS), F.lit(WORDS), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).where("item_id is not null and size(words) > 0")
    step = max(1, block_words // 4)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)), F.lit(step))
    pieces = items.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", "at", F.slice("words", F.col("at"), F.lit(step + size - 1)).alias("words"))
    n = -(-(items.agg(F.sum(F.size("words"))).first()[0] or 0) // block_words) or 1
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "at"), F.lit(n)))
    return n, ([(r["item_id"], r["words"]) for r in dealt.where(F.col("block") == k).select("item_id", "words").collect()] for k in range(n))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Find windows of ``benchmark(item_id, text)`` in ``docs(doc_id, text)``; other columns are ignored.

    One row per input row, repeated and null doc_id included: ``n_words``, sorted positions of hit words, the items found,
    and spans in the original text. A null or wordless text gives zero words and no hit; a wordless item, or one without an
    id, matches nothing. Usually the benchmark is one block, and the text is scanned once without a shuffle. A larger one is
    cut into blocks of about ``block_words``, of which the driver and the tasks hold one at a time; each block's rows
    are written with the text and scanned for the next one, with the same result.
    """
    n, blocks = _blocks(benchmark, size, block_words)
    out = docs.select("doc_id", "text")
    for k, block in enumerate(blocks):
        last = k == n - 1
        out = out.mapInArrow(lambda it, block=block, k=k, last=last: _scan(it, block, size, k == 0, last), WHOLE_DDL if last else PART_DDL)
        out = out if last else stage(out, "scanned")
    return out


def _clean(batches: Iterator[pa.RecordBatch], items: Items, size: int) -> Iterator[pa.RecordBatch]:
    machine = _machine(items, size)
    for part in rows(batches):
        texts = part.column("text").cast(pa.binary()).to_pylist()
        yield part.filter(pa.array([next(machine.matches((t or b"").translate(NORMAL).split()), None) is None for t in texts], pa.bool_()))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns, without a shuffle. Null texts are kept."""
    n, blocks = _blocks(benchmark, size, block_words)
    for k, block in enumerate(blocks):
        docs = docs.mapInArrow(lambda it, block=block: _clean(it, block, size), docs.schema)
        docs = docs if k == n - 1 else stage(docs, "scanned")
    return docs
