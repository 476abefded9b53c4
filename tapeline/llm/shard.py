"""Shard placement by a hierarchical weighted hash tree, with built-in expressions only."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """A shard, where it stands and what share it should take. Weights are positive."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def topology(n: int, shards_per_rack: int = 3, racks_per_region: int = 2) -> list[Leaf]:
    """``n`` equal shards, filled rack by rack and region by region; a shard that opens a region takes rows only into itself."""
    per = shards_per_rack * racks_per_region
    return [Leaf(i, f"region{i // per}", f"region{i // per}/rack{i % per // shards_per_rack}") for i in range(n)]


def _pick(key: Column, nodes: Column, seed: int) -> Column:
    """The id of one of ``nodes(name, weight, id)``: exponential draws from the hash of key and name, the smallest wins.

    A node wins in proportion to its weight, and a weight that grows only takes keys, from all others alike.
    """

    def draw(node: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, node["name"], F.lit(seed)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.log(unit) / node["weight"]).alias("draw"), node["id"].alias("id"))

    return F.array_min(F.transform(nodes, draw))["id"]


def _nodes(rows: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("id")) for n, w, i in rows])


def place(key: Column, leaves: list[Leaf], seed: int = 0) -> Column:
    """The shard of a key: weighted draws for region, then rack, then shard.

    A changed weight moves rows only into or out of the subtrees above it. A null key is a key like any other.
    """
    tree: dict[str, dict[str, list[Leaf]]] = defaultdict(lambda: defaultdict(list))
    for leaf in leaves:
        tree[leaf.region][leaf.rack].append(leaf)
    regions, racks, shards = [], [], []
    for region, below in sorted(tree.items()):
        regions.append((region, sum(x.weight for own in below.values() for x in own), len(regions)))
        racks.append([])
        for rack, own in sorted(below.items()):
            racks[-1].append((rack, sum(x.weight for x in own), len(shards)))
            shards.append([(f"shard{x.shard}", x.weight, x.shard) for x in own])
    region = _pick(key, _nodes(regions), seed)
    rack = _pick(key, F.get(F.array(*map(_nodes, racks)), region), seed)
    return _pick(key, F.get(F.array(*map(_nodes, shards)), rack), seed)


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns that Spark can hash, which tells rows of one key apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def _free(df: DataFrame, *names: str) -> list[str]:
    """A name for each of ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    return [next(own for k in count() if (own := f"__{name}{k or ''}") not in taken) for name in names]


def with_slots(df: DataFrame, order: str, shard: str = "shard", slot: str = "slot", cells: int | None = None) -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    Each shard is cut into ``cells`` by a hash of the whole row, by default 64 or a quarter of the session's shuffle
    partitions; rows are numbered within a cell, by ``order`` and that hash, and the counts of the cells
    before are added. So no task holds a shard, nor all rows of one key. Rows that are equal throughout share a cell. All
    columns stay, whatever their names; only one named like ``slot`` is replaced.
    """
    cells = cells or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    row, cell, number, of, at, base = _free(df, "row", "cell", "number", "of", "at", "base")
    cut = df.withColumn(row, _row_hash(df)).withColumn(cell, F.pmod(F.xxhash64(row, F.lit("cell")), F.lit(cells)).cast("int"))
    counts = cut.groupBy(F.col(shard).alias(of), F.col(cell).alias(at)).agg(F.count("*").alias(number))
    before = Window.partitionBy(of).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(of, at, F.coalesce(F.sum(number).over(before), F.lit(0)).alias(base))
    inside = F.row_number().over(Window.partitionBy(shard, cell).orderBy(order, row)) - 1
    # bases has a row for each shard and cell at most, whatever the input
    joined = cut.withColumn(number, inside).join(F.broadcast(bases), (F.col(shard) == F.col(of)) & (F.col(cell) == F.col(at)))
    return joined.withColumn(slot, (F.col(base) + F.col(number)).cast("long")).drop(row, cell, number, of, at, base)


def opens_region(leaves: list[Leaf], grown: list[Leaf]) -> bool:
    """Whether all that ``grown`` adds stands in regions of its own, so that it takes rows only into itself."""
    old = {x.region for x in leaves}
    return [x for x in grown if x.region in old] == leaves


def shard(docs: DataFrame, n: int, key: str = "doc_id", seed: int = 0, cells: int | None = None, grow: bool = True) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` and ``grown_shard``, the shard if there were one more, or null without ``grow``.

    The key and ``n`` alone decide. One more shard takes rows only into itself where it opens a region; as it would stand
    in a region with others unless n is a multiple of six, ``grow`` is an error for other n. All columns are carried, so
    select those that are needed. Where ``docs`` has columns of these names they are replaced. Empty input gives an empty
    result; rows of a null key share a shard.
    """
    if grow and not opens_region(topology(n), topology(n + 1)):
        raise ValueError(f"shard {n} would join a region of others and move rows among them; take full regions or grow=False")
    kept = docs.drop("shard", "slot", "grown_shard")
    more = place(F.col(key), topology(n + 1), seed) if grow else F.lit(None).cast("int")
    return with_slots(kept.withColumns({"shard": place(F.col(key), topology(n), seed), "grown_shard": more}), key, cells=cells)
