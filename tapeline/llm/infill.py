"""Fill-in-the-middle: texts are cut in three and their blocks exchanged in place, reversibly.

Sentinels are inserted where the blocks begin, in one bytearray; neighbouring blocks change places by rotation, which is three
reversals. The inverse finds the sentinels, rotates back and takes them out. No sentinel can arise where a block meets another, as none
begins with what another ends with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapeline.llm._shared import chunks, rows

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts so many are rearranged, and of 100 of those so many have the suffix first.
RATE, SUFFIX_FIRST = 90, 20

SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that follow from the id; a null id draws as an empty one."""
    digest = hashlib.sha256(b"1:%s" % (b"" if doc_id is None else b"%d" % doc_id)).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _rotate(buf: bytearray, a: int, b: int, c: int) -> None:
    """``buf[a:b]`` and ``buf[b:c]`` change places by three reversals."""
    view = np.frombuffer(buf, np.uint8)
    for i, j in ((a, b), (b, c), (a, c)):
        view[i:j] = view[i:j][::-1]


def rearrange(text: bytes, first: int, second: int, suffix_first: bool) -> bytes:
    """``text`` cut at the bytes ``first`` and ``second``: prefix, suffix, middle, or suffix, prefix, middle, each behind its sentinel."""
    buf = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):  # from the end, so that cuts stay where they are
        buf[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    _rotate(buf, middle, suffix, len(buf))
    if suffix_first:
        _rotate(buf, 0, middle, middle + len(buf) - suffix)
    return bytes(buf)


def restore(output: bytes, form: str) -> bytes:
    """The text that became ``output``."""
    if form == "plain":
        return output
    buf = bytearray(output)
    if form == "spm":  # suffix, prefix, middle: the prefix comes to the front
        _rotate(buf, 0, buf.index(PREFIX), buf.index(MIDDLE))
    suffix = buf.index(SUFFIX)
    _rotate(buf, suffix, buf.index(MIDDLE, suffix), len(buf))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(sentinel)
        del buf[at : at + len(sentinel)]
    return bytes(buf)


def _cuts(text: bytes, n: int, first: int, second: int) -> tuple[int, int]:
    """The bytes at which the code points ``first`` and ``second`` begin."""
    if n == len(text):
        return first, second
    heads = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
    return int(heads[first]), int(heads[second])


def _length(text: bytes) -> int:
    return len(text) if text.isascii() else int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def example(doc_id: int | None, text: bytes, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, bytes]:
    """Length in code points, form, those of prefix and middle, and the output."""
    n, (h1, h2, h3, h4) = _length(text), draws(doc_id)
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    turned = h4 % 100 < suffix_first
    return n, "spm" if turned else "psm", first, second - first, rearrange(text, *_cuts(text, n, first, second), turned)


def _examples(batches: Iterator[pa.RecordBatch], rate: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in chunks(batches, "doc_id", "text"):
        n, form, prefix, middle, output = zip(*(example(i, t or b"", rate, suffix_first) for i, t in zip(ids, texts, strict=True)), strict=True)
        longs = [pa.array(x, pa.int64()) for x in (ids, n, prefix, middle)]
        yield pa.RecordBatch.from_arrays([*longs[:2], pa.array(form), *longs[2:], pa.array(output, pa.binary()).cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for each row of ``docs(doc_id, text)``, in one scan without a shuffle.

    Cuts are at code points drawn from the id, so equal ids with equal texts give equal rows. A text that is empty, null or has a
    sentinel, and one in ten of the others, stays ``plain`` and has no cuts. Other columns are ignored; an empty table gives none.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda it: _examples(it, rate, suffix_first), SCHEMA)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in rows(batches):
        for outputs, forms in chunks(iter([part]), "output", "form"):
            texts = [restore(o, f.decode()) for o, f in zip(outputs, forms, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*part.schema.names, "restored"])


def with_restored(examples: DataFrame) -> DataFrame:
    """``examples`` of :func:`transform` with ``restored``, rebuilt from ``output`` and ``form`` alone."""
    return examples.mapInArrow(_restored, f"{SCHEMA}, restored string")
