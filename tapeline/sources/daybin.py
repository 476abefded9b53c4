"""Day vectors: little-endian float32, the first value the position of the first day, then a value for each day.

A vector per instrument and field. Each write makes a version, a folder ``<path>/v<number>-<id>`` with what it wrote: Parquet files of
packed vectors, of which there are ``BUCKETS`` however many vectors there are, as a file each would make millions of files, and as
many tasks to read them. Whole instruments go to a bucket by a hash of their name. A manifest names the versions that hold and their files,
and of a vector's copies the one in the newest version counts. The driver publishes a manifest by one rename, so readers see a
write whole or not at all. Vectors that can't be written are the version's rejects. Registered as format ``daybin``;
:func:`copy_tree` gives a file per vector, ``<instrument>/<field>.day.bin``.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from dataclasses import field as attribute

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tapeline.sources import paths

SUFFIX = ".day.bin"
#: Files of a version, by a hash of the instrument; a bucket is written by one task.
BUCKETS = 256
#: Bytes of vectors that a task holds before it writes them, and values that it holds before it hands them on.
HELD_BYTES, HELD_VALUES = 8 << 20, 1 << 19
PACKED = "instrument string, field string, content binary"
PACKED_ARROW = pa.schema([("instrument", pa.string()), ("field", pa.string()), ("content", pa.binary())])
#: Positions are exact in a float32 up to here.
MOST_DAYS = 1 << 24
#: Versions that a manifest names at most; a write that makes more merges them first.
VERSIONS = 8
MANIFEST, REJECTS = "_manifest-", "_rejects"


def pack(index: np.ndarray, values: np.ndarray) -> bytes | None:
    """A file from positions in order and their values; ends without a value are cut, gaps are NaN. None without any value.

    Positions that repeat or that a file can't hold, and values too large for its numbers, are errors.
    """
    if len(index) and (index[0] < 0 or index[-1] >= MOST_DAYS):
        raise ValueError(f"day {index[0] if index[0] < 0 else index[-1]} is no position")
    if (np.diff(index) <= 0).any():
        raise ValueError("two values for a day")
    with np.errstate(over="ignore"):
        narrow = values.astype("<f4")
    if (np.isinf(narrow) & np.isfinite(values)).any():
        raise ValueError("a value is too large")
    values = narrow
    good = np.flatnonzero(~np.isnan(values))
    if not len(good):
        return None
    index, values = index[good[0] : good[-1] + 1], values[good[0] : good[-1] + 1]
    out = np.full(int(index[-1] - index[0]) + 2, np.nan, "<f4")
    out[0] = index[0]
    out[1 + (index - index[0])] = values
    return out.tobytes()


def unpack(raw: bytes) -> tuple[int, np.ndarray] | None:
    """Start position and values; None if the bytes aren't such a file."""
    if len(raw) < 4 or len(raw) % 4:
        return None
    a = np.frombuffer(raw, "<f4")
    return int(a[0]), a[1:]


def extend(raw: bytes, index: np.ndarray, values: np.ndarray) -> bytes | None:
    """An older file with the values after its end; days between are NaN. Broken files are written anew; None if there is nothing new."""
    old = unpack(raw)
    if old is None:
        return pack(index, values)
    start, have = old
    new = (index >= start + len(have)) & ~np.isnan(values)
    if not new.any():
        return None
    return pack(np.concatenate([start + np.arange(len(have)), index[new]]), np.concatenate([have, values[new].astype("<f4")]))


def merge(raw: bytes | None, index: np.ndarray, values: np.ndarray) -> bytes | None:
    """An older file with the given values at their positions, in it or beyond its ends. Broken files are written anew; None if nothing is new."""
    old = unpack(raw) if raw else None
    new = ~np.isnan(values)
    if old is None or not len(old[1]):
        return pack(index, values)
    if not new.any():
        return None
    fresh = unpack(pack(index[new], values[new]))
    (a, have), (b, more) = old, fresh
    start = min(a, b)
    out = np.full(max(a + len(have), b + len(more)) - start, np.nan, "<f4")
    out[a - start : a - start + len(have)] = have
    at = np.flatnonzero(~np.isnan(more))
    out[b - start + at] = more[at]
    return pack(start + np.arange(len(out)), out)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:").rstrip("/"))


def manifest(path: str) -> dict | None:
    """``{number, versions, files, notes}`` of the vectors at ``path``; None where there are none, or none with versions."""
    disk, root = _open(path)
    there = [i.path for i in disk.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.base_name.startswith(MANIFEST)]
    found = json.loads(disk.open_input_stream(max(there)).read()) if there else None
    if found and "files" not in found:
        raise ValueError(f"{path} has a file for each vector, as earlier versions of this library wrote them: reset the export and run it again")
    return found


def bucket(instrument: str) -> int:
    return zlib.crc32(instrument.encode()) % BUCKETS


def _dealt(rows: DataFrame, tasks: int, *order: str) -> DataFrame:
    """Whole buckets to tasks, in their order there."""
    own = rows.withColumn("__bucket", F.crc32(F.col("instrument").cast("binary")) % BUCKETS)
    return own.repartition(tasks, "__bucket").sortWithinPartitions("__bucket", *order).drop("__bucket")


class _Older:
    """The vectors of a bucket's files, newest file first, asked for in order; a row group of each file is held."""

    def __init__(self, disk: fs.FileSystem, files: list[str]):
        self.rows = [self._read(disk, f) for f in files]
        self.heads = [next(r, None) for r in self.rows]

    @staticmethod
    def _read(disk: fs.FileSystem, path: str) -> Iterator[tuple[tuple[str, str], bytes]]:
        with disk.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=256):
                inst, name, content = (batch.column(c).to_pylist() for c in PACKED_ARROW.names)
                yield from zip(zip(inst, name, strict=True), content, strict=True)

    def get(self, key: tuple[str, str]) -> bytes | None:
        """The newest copy; None where there is none, or where it was taken away."""
        for k, rows in enumerate(self.rows):
            while self.heads[k] and self.heads[k][0] < key:
                self.heads[k] = next(rows, None)
            if self.heads[k] and self.heads[k][0] == key:
                return self.heads[k][1] or None
        return None


class _Bucket:
    """A bucket's file while it is written. It has its name only when it is whole."""

    def __init__(self, disk: fs.FileSystem, at: str, number: int):
        self.disk, self.at, self.number = disk, at, number
        self.name = f"b{number:04d}-{uuid.uuid4().hex}.parquet"
        self.stream = disk.open_output_stream(f"{at}/_{self.name}")
        self.out = pq.ParquetWriter(self.stream, PACKED_ARROW, use_dictionary=["instrument", "field"], write_statistics=False)
        self.rows: list[tuple[str, str, bytes]] = []
        self.size = 0

    def add(self, rows: list[tuple[str, str, bytes]]) -> None:
        self.rows += rows
        self.size += sum(len(r[2]) for r in rows)
        if self.size >= HELD_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.out.write_batch(pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*self.rows, strict=True), PACKED_ARROW.types, strict=True)], schema=PACKED_ARROW))
        self.rows, self.size = [], 0

    def close(self) -> None:
        self._flush()
        self.out.close()
        self.stream.close()
        self.disk.move(f"{self.at}/_{self.name}", f"{self.at}/{self.name}")


def _publish(path: str, base: dict | None, version: str, files: list[str], alone: bool, notes: dict) -> None:
    """Make ``version`` the newest of those that hold, or the only one. One rename decides; what is deleted then nobody reads any more:
    versions that neither this manifest nor the one before names."""
    disk, root = _open(path)
    now = manifest(path)
    if (now or {}).get("number") != (base or {}).get("number"):
        raise OSError(f"another write to {path} came between")
    disk.create_dir(f"{root}/{version}")
    old = base["versions"] if base else []
    number = base["number"] + 1 if base else 1
    held = {} if alone or not base else base["files"]
    new = {"number": number, "versions": [version] if alone else [*old, version], "files": held | {version: files}, "notes": (base["notes"] if base else {}) | notes}
    with disk.open_output_stream(f"{root}/_new-{version}") as f:
        f.write(json.dumps(new).encode())
    disk.move(f"{root}/_new-{version}", f"{root}/{MANIFEST}{number:010d}.json")
    for i in disk.get_file_info(fs.FileSelector(root)):
        if i.type == fs.FileType.Directory and i.base_name.startswith("v") and i.base_name not in {*old, *new["versions"]} and i.base_name.partition("-")[0][1:].isdigit():
            disk.delete_dir(i.path)
        elif i.base_name.startswith(MANIFEST) and i.base_name < f"{MANIFEST}{number - 1:010d}.json":
            disk.delete_file(i.path)


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: vectors, rejects, and the files that have them."""

    n_files: int
    n_rejects: int
    files: list[str] = attribute(default_factory=list, compare=False)


class DayBinWriter(DataSourceArrowWriter):
    def __init__(self, path: str, mode: str, notes: dict | None = None, of: int | None = None):
        self.path, self.mode, self.notes = path.rstrip("/"), mode, notes or {}
        self.base = manifest(self.path)
        if of is not None and self.base["number"] != of:
            raise OSError(f"another write to {path} came between")
        self.alone = mode in ("overwrite", "packed")
        self.versions = self.base["versions"] if self.base and not self.alone else []
        self.version = f"v{self.base['number'] + 1 if self.base else 1:010d}-{uuid.uuid4().hex}"

    def _older(self, disk: fs.FileSystem, root: str, number: int) -> _Older:
        return _Older(disk, [f"{root}/{v}/{f}" for v in reversed(self.versions) for f in self.base["files"][v] if f.startswith(f"b{number:04d}-")])

    def _content(self, older: _Older, key: tuple[str, str], index: np.ndarray, values: np.ndarray) -> bytes | None:
        """What becomes of a vector: its bytes, none that take an older one away, or None, which leaves it."""
        if self.mode in ("append", "merge"):
            old = older.get(key)
            return merge(old, index, values) if self.mode == "merge" else extend(old, index, values) if old else pack(index, values)
        raw = pack(index, values)
        return b"" if raw is None and older.get(key) else raw

    def _instruments(self, disk: fs.FileSystem, root: str, iterator: Iterator[pa.RecordBatch], rejects: list[dict]) -> Iterator[list[tuple[str, str, bytes]]]:
        """The vectors of each instrument; one with a bad vector has none, but a reject."""
        inst, own, bad = None, [], False
        number, older = None, None
        for (name, field), index, values in _vectors(iterator):
            if name != inst:
                yield own
                inst, own, bad = name, [], False
                if bucket(name) != number:
                    number = bucket(name)
                    older = self._older(disk, root, number)
            if bad:
                continue
            try:
                raw = self._content(older, (name, field), index, values)
            except ValueError as e:
                rejects.append({"instrument": name, "field": field, "reason": str(e)})
                own, bad = [], True
                continue
            if raw is not None:
                own.append((name, field, raw))
        yield own

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Instruments are written whole. One with a bad vector isn't, but is a reject; of a repeated task the files of one attempt count."""
        disk, root = _open(self.path)
        at = f"{root}/{self.version}"
        rejects: list[dict] = []
        done = Written(0, 0)
        if self.mode == "packed":
            found = ([r] for batch in iterator for r in zip(*(batch.column(c).to_pylist() for c in PACKED_ARROW.names), strict=True))
        else:
            found = self._instruments(disk, root, iterator, rejects)
        out: _Bucket | None = None
        for rows in found:
            if not rows:
                continue
            number = bucket(rows[0][0])
            if out is None or out.number != number:
                if out:
                    out.close()
                else:
                    disk.create_dir(at)
                out = _Bucket(disk, at, number)
                done.files.append(out.name)
            out.add(rows)
            done.n_files += len(rows)
        if out:
            out.close()
        if rejects:
            disk.create_dir(f"{at}/{REJECTS}")
            with disk.open_output_stream(f"{at}/{REJECTS}/{uuid.uuid4().hex}.json") as f:
                f.write("".join(json.dumps(r) + "\n" for r in rejects).encode())
        done.n_rejects = len(rejects)
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Publish the version: before that readers have the old vectors, after it the new ones."""
        told = [m for m in messages if m]
        counts = {"n_files": sum(m.n_files for m in told), "n_rejects": sum(m.n_rejects for m in told)}
        notes = {} if self.mode == "packed" else self.notes | counts
        _publish(self.path, self.base, self.version, [f for m in told for f in m.files], self.alone, notes)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        now = manifest(self.path)
        disk, root = _open(self.path)
        if (not now or self.version not in now["versions"]) and disk.get_file_info(f"{root}/{self.version}").type == fs.FileType.Directory:
            disk.delete_dir(f"{root}/{self.version}")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, str], np.ndarray, np.ndarray]]:
    """Each vector of batches sorted by instrument and field: its names, positions and values; nulls are NaN."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    name: tuple[str, str] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).dictionary_encode() for c in ("instrument", "field")]
        inst, field = (x.indices.to_numpy() for x in names)
        index = batch.column("cal_idx").to_numpy()
        values = batch.column("value").to_numpy(zero_copy_only=False).astype(np.float64)
        turns = (np.flatnonzero((inst[1:] != inst[:-1]) | (field[1:] != field[:-1])) + 1).tolist()
        for a, b in zip([0, *turns], [*turns, batch.num_rows], strict=True):
            own = (names[0].dictionary[int(inst[a])].as_py(), names[1].dictionary[int(field[a])].as_py())
            if own != name and held:
                yield name, *(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            name = own
            held.append((index[a:b], values[a:b]))
    if held:
        yield name, *(np.concatenate(x) for x in zip(*held, strict=True))


class DayBin(DataSource):
    """Writes rows ``(instrument, field, cal_idx, value)``, or packed ones, sorted within buckets, a bucket's in one partition."""

    @classmethod
    def name(cls) -> str:
        return "daybin"

    def writer(self, schema: StructType, overwrite: bool) -> DayBinWriter:
        mode = self.options.get("vectors", "overwrite" if overwrite else "append")
        of = self.options.get("of")
        return DayBinWriter(self.options["path"], mode, json.loads(self.options.get("notes", "{}")), int(of) if of else None)


def write_long(rows: DataFrame, path: str, mode: str, tasks: int | None = None, notes: dict | None = None) -> None:
    """Write rows ``(instrument, field, cal_idx, value)``: see :func:`write`."""
    spark = rows.sparkSession
    path = paths.located(spark, path)
    if len((manifest(path) or {"versions": []})["versions"]) >= VERSIONS and mode != "overwrite":
        compact(spark, path)
    spark.dataSource.register(DayBin)
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = rows.select("instrument", "field", F.col("cal_idx").cast("long").alias("cal_idx"), F.col("value").cast("double").alias("value"))
    out = _dealt(own, n, "instrument", "field", "cal_idx").write.format("daybin").mode("overwrite" if mode == "overwrite" else "append").option("vectors", mode)
    out.option("notes", json.dumps(notes or {})).save(path)


def write(slots: DataFrame, fields: list[str], path: str, mode: str = "overwrite", tasks: int | None = None, notes: dict | None = None) -> None:
    """Write features ``(instrument, cal_idx, <fields>)``. ``overwrite``: nothing else stays. ``replace``: the files of these instruments
    and fields are written anew, or go where there is no value, and others stay. ``append``: only what comes after the files' ends.
    ``merge``: values take their positions, in the files or beyond their ends.

    One shuffle deals buckets of instruments to ``tasks``, by default the session's shuffle partitions; each task holds an instrument's vectors
    and 8 MB of packed ones. A path without a scheme lies on the session's default file system, as everywhere in Spark; tasks and driver must share it. Vectors that can't be written are
    :func:`rejects`; of their instruments nothing is written. ``notes`` are published with the files.
    """
    long = slots.select("instrument", "cal_idx", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields])).alias("x"))
    rows = long.select("instrument", "x.field", "cal_idx", "x.value")
    write_long(rows if mode == "replace" else rows.where("value IS NOT NULL"), path, mode, tasks, notes)


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(instrument, field, reason)`` of the vectors that the newest version couldn't take."""
    path = paths.located(spark, path)
    schema, now = "instrument string, field string, reason string", manifest(path)
    disk, root = _open(path)
    at = f"{now['versions'][-1]}/{REJECTS}" if now else REJECTS
    if disk.get_file_info(f"{root}/{at}").type != fs.FileType.Directory:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path}/{at}/*.json").distinct()  # a repeated task says it twice


READ = "instrument string, field string, cal_idx long, value float, reject string"


def _packed(spark: SparkSession, path: str) -> DataFrame:
    """``(instrument, field, content)`` of the vectors that count, or of the files of a plain tree."""
    now = manifest(path)
    if not now:
        there = _open(path)[0].get_file_info(fs.FileSelector(_open(path)[1]))  # folders that Spark takes for hidden are named
        folders = [path, *(f"{path}/{i.base_name}" for i in there if i.type == fs.FileType.Directory and i.base_name.startswith(("_", ".")))]
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{SUFFIX}").load(folders)
        part = F.split("path", "/")
        name = F.element_at(part, -1)
        return found.select(F.element_at(part, -2).alias("instrument"), F.substring(name, F.lit(1), F.length(name) - len(SUFFIX)).alias("field"), "content")
    found = spark.read.schema(PACKED).parquet(*[f"{path}/{v}" for v in now["versions"]])
    names = [f"'{f}'" for v in now["versions"] for f in now["files"][v]]
    found = found.where(f"_metadata.file_name IN ({', '.join(names)})" if names else "false")  # lost attempts left others
    if len(now["versions"]) > 1:
        version = F.element_at(F.split("_metadata.file_path", "/"), -2)  # names begin with the number
        found = found.groupBy("instrument", "field").agg(F.max_by("content", version).alias("content"))
    return found.where("length(content) > 0")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, tuple[int, np.ndarray] | None]]:
    for batch in batches:
        for inst, name, raw in zip(*(batch.column(c) for c in PACKED_ARROW.names), strict=True):
            yield inst.as_py(), name.as_py(), unpack(raw.as_py())


def _long(vectors: Iterator[tuple[str, str, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """``(instrument, field, cal_idx, value)`` in batches of many vectors; NaN is null."""
    held: list[tuple[str, str, np.ndarray, np.ndarray]] = []

    def batch() -> pa.RecordBatch:
        of = pa.array(np.repeat(np.arange(len(held), dtype=np.int32), [len(v[2]) for v in held]))
        names = [pa.DictionaryArray.from_arrays(of, pa.array([v[k] for v in held], pa.string())).cast(pa.string()) for k in (0, 1)]
        index, values = (np.concatenate([v[k] for v in held]) for k in (2, 3))
        return pa.RecordBatch.from_arrays([*names, pa.array(index, pa.int64()), pa.array(values, pa.float32(), from_pandas=True)], ["instrument", "field", "cal_idx", "value"])

    n = 0
    for v in vectors:
        if len(v[2]):
            held.append(v)
            n += len(v[2])
        if n >= HELD_VALUES:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(instrument, field, cal_idx, value, reject)`` of all vectors; days without a value are null, broken ones one rejected row.

    A tree of files without a manifest is read as it is.
    """

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        broken: list[tuple[str, str]] = []

        def good() -> Iterator[tuple[str, str, np.ndarray, np.ndarray]]:
            for inst, name, found in _unpacked(batches):
                if found is None:
                    broken.append((inst, name))
                else:
                    yield inst, name, found[0] + np.arange(len(found[1])), found[1]

        for batch in _long(good()):
            yield batch.append_column("reject", pa.nulls(batch.num_rows, pa.string()))
        if broken:
            names = [pa.array(x, pa.string()) for x in zip(*broken, strict=True)]
            yield pa.RecordBatch.from_arrays([*names, pa.nulls(len(broken), pa.int64()), pa.nulls(len(broken), pa.float32()), pa.array(["not a vector file"] * len(broken))], ["instrument", "field", "cal_idx", "value", "reject"])

    return _packed(spark, paths.located(spark, path)).mapInArrow(unpacked, "instrument string, field string, cal_idx long, value float, reject string")


def remapped(spark: SparkSession, path: str, moved: dict[int, int], but: dict[str, set[int]] | None = None) -> DataFrame:
    """``(instrument, field, cal_idx, value)`` of all vectors at new positions: ``moved`` says the new one of an old one, and what it lacks
    goes. Where several old positions meet, the last value counts. ``but`` lists new positions that a field leaves out.

    Each vector is turned by the task that reads it; the map has a number for each day of a calendar.
    """
    to = np.full(max(moved, default=-1) + 1, -1, np.int64)
    to[list(moved)] = list(moved.values())
    out = {f: np.array(sorted(x), np.int64) for f, x in (but or {}).items()}

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, np.ndarray, np.ndarray]]:
        for inst, name, found in _unpacked(batches):
            start, values = found or (0, np.empty(0, "<f4"))
            good = np.flatnonzero(~np.isnan(values))
            good = good[start + good < len(to)]
            at = to[start + good]
            keep = (at >= 0) & ~np.isin(at, out.get(name, []))
            at, values = at[keep], values[good[keep]]
            last = np.append(at[1:] != at[:-1], True)[: len(at)]  # days stay in order
            yield inst, name, at[last], values[last]

    return _packed(spark, paths.located(spark, path)).mapInArrow(lambda it: _long(turned(it)), "instrument string, field string, cal_idx long, value float")


def compact(spark: SparkSession, path: str) -> None:
    """Merge the versions into one: tasks copy the vectors that count, then the driver publishes the copy."""
    path = paths.located(spark, path)
    base = manifest(path)
    if base and len(base["versions"]) > 1:
        spark.dataSource.register(DayBin)
        dealt = _dealt(_packed(spark, path), int(spark.conf.get("spark.sql.shuffle.partitions")), "instrument", "field")
        dealt.write.format("daybin").mode("overwrite").option("vectors", "packed").option("of", str(base["number"])).save(path)


def copy_tree(spark: SparkSession, path: str, to: str) -> None:
    """The vectors that count as a plain tree ``<to>/<instrument>/<field>.day.bin``, as other programs read it."""
    to = paths.located(spark, to)

    def copied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        disk, root = _open(to)
        n = 0
        for batch in batches:
            for inst, name, raw in zip(batch["instrument"], batch["field"], batch["content"], strict=True):
                own = f"{root}/{inst}"
                disk.create_dir(own)
                tmp = f"{own}/_tmp-{uuid.uuid4().hex}"
                with disk.open_output_stream(tmp) as f:
                    f.write(bytes(raw))
                disk.move(tmp, f"{own}/{name}{SUFFIX}")
                n += 1
        yield pd.DataFrame({"n": [n]})

    _packed(spark, paths.located(spark, path)).mapInPandas(copied, "n bigint").agg(F.sum("n")).collect()  # one number
