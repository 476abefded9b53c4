"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.sources.paths import drop_staged, stage

__all__ = ["LOWER", "chunks", "connected_components", "drop_staged", "forest", "rows", "runs", "shares", "stage"]

#: Rows of an Arrow batch that are turned into Python objects at a time.
ROWS = 256


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Python lists of the named columns, some rows at a time; strings come as UTF-8 bytes."""
    for part in rows(batches):
        out = []
        for name in columns:
            col = part.column(name)
            if pa.types.is_string(col.type):
                col = col.cast(pa.binary())
            elif pa.types.is_large_string(col.type):
                col = col.cast(pa.large_binary())
            out.append(col.to_pylist())
        yield tuple(out)


#: Lower-cases A-Z in UTF-8 bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def runs(batches: Iterator[pa.RecordBatch], *keys: str, together: bool = False) -> Iterator[pa.RecordBatch]:
    """Whole runs of rows of equal ``keys``, of batches sorted by them; ``together`` gives runs that end in one batch at once."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if rest and any(rest[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True)):
            yield _one(rest)
            rest = []
        turns = (np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist()
        if turns:
            yield _one([*rest, batch.slice(0, turns[-1] if together else turns[0])])
            for a, b in () if together else zip(turns, turns[1:], strict=False):
                yield batch.slice(a, b - a)
            rest = [batch.slice(turns[-1])]
        else:
            rest.append(batch)
    if rest:
        yield _one(rest)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest of its component: as many as nodes, however many pairs came in."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def shares(counts: dict, rows: int, least: int = 50) -> dict:
    """The share of each label's rows in a sample of about ``rows``: all of rare labels, as many of each other, and ``least`` or more."""
    quota, left = float(rows), rows
    for k, n in enumerate(sorted(counts.values())):
        quota = left / (len(counts) - k)
        if n > quota:
            break
        left -= n
    return {label: min(1.0, max(quota, least) / n) for label, n in counts.items()}


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Alternating large-star and small-star rounds; each is a partial aggregation and an equi-join. A node with very many
    neighbours is pre-aggregated, and its part of the join can be split by Spark, as the aggregate is a written table. Rounds grow with the logarithm of a component's
    size. Nulls and self-loops are ignored; an empty input gives an empty result.
    """
    current = stage(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")  # written, so that the join can be split
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stage(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "edges")
        drop_staged(current)
        drop_staged(least)
        current = after
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
