from __future__ import annotations

from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tapeline.sources import daybin, text

values = st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=1, max_size=30)


@given(values, st.integers(0, 500))
def test_pack_trims_and_keeps_gaps(vs, start):
    a = np.array([np.nan if v is None else v for v in vs], float)
    raw = daybin.pack(start + np.arange(len(a)), a)
    good = np.flatnonzero(~np.isnan(a))
    if not len(good):
        assert raw is None
        return
    first, back = daybin.unpack(raw)
    assert first == start + good[0]
    np.testing.assert_array_equal(back, a[good[0] : good[-1] + 1].astype("f4"))


@given(values, values)
def test_append_equals_whole(a, b):
    whole = np.array([np.nan if v is None else v for v in a + b], float)
    index = np.arange(len(whole))
    old = daybin.pack(index[: len(a)], whole[: len(a)])
    if old is not None:
        new = daybin.extend(old, index, whole)
        assert (new or old) == daybin.pack(index, whole)


def test_broken_files(spark, tmp_path):
    assert daybin.unpack(b"abc") is None and daybin.unpack(b"12345") is None
    assert daybin.extend(b"abc", np.array([1]), np.array([2.0])) == daybin.pack(np.array([1]), np.array([2.0]))
    (tmp_path / "SZ1").mkdir()
    (tmp_path / "SZ1" / "close.day.bin").write_bytes(b"abc")
    assert [r["reject"] for r in daybin.read(spark, str(tmp_path)).collect()] == ["not a vector file"]


def test_write_append_read(spark, tmp_path):
    path = str(tmp_path / "v")
    schema = "instrument string, cal_idx int, close double, vol double"
    daybin.write(spark.createDataFrame([("A", 3, 1.5, None), ("A", 5, 2.5, None), ("B", 1, None, 7.0)], schema), ["close", "vol"], path)
    daybin.write(spark.createDataFrame([("A", 4, 9.0, None), ("A", 8, 3.5, 4.0)], schema), ["close", "vol"], path, mode="append")
    got = {(r["instrument"], r["field"], r["cal_idx"]): r["value"] for r in daybin.read(spark, path).collect()}
    assert got == {("A", "close", 3): 1.5, ("A", "close", 4): None, ("A", "close", 5): 2.5, ("A", "close", 6): None, ("A", "close", 7): None, ("A", "close", 8): 3.5, ("A", "vol", 8): 4.0, ("B", "vol", 1): 7.0}
    daybin.write(spark.createDataFrame([("C", 1, 1.0, 1.0)], schema), ["close"], path)
    assert [r["instrument"] for r in daybin.read(spark, path).collect()] == ["C"]


def test_replace_touches_its_own_files_only(spark, tmp_path):
    path, schema = str(tmp_path / "v"), "instrument string, cal_idx int, close double, vol double"
    daybin.write(spark.createDataFrame([("A", 3, 1.5, 5.0), ("B", 1, 2.5, 7.0)], schema), ["close", "vol"], path)
    daybin.write(spark.createDataFrame([("A", 9, 4.0, None)], schema), ["close"], path, mode="replace")
    read = lambda: sorted((r["instrument"], r["field"], r["cal_idx"], r["value"]) for r in daybin.read(spark, path).collect())
    assert read() == [("A", "close", 9, 4.0), ("A", "vol", 3, 5.0), ("B", "close", 1, 2.5), ("B", "vol", 1, 7.0)]
    daybin.write(spark.createDataFrame([("A", 9, 4.0, None)], schema), ["close", "vol"], path, mode="replace")
    assert read() == [("A", "close", 9, 4.0), ("B", "close", 1, 2.5), ("B", "vol", 1, 7.0)]


class Fails:
    """A file system whose ``n``-th change fails."""

    def __init__(self, disk, n):
        self.disk, self.left = disk, n

    def __getattr__(self, name):
        real = getattr(self.disk, name)
        if name not in ("create_dir", "move", "delete_dir", "delete_file", "open_output_stream"):
            return real

        def call(*args):
            self.left -= 1
            if not self.left:
                raise OSError("no more changes")
            return real(*args)

        return call


@pytest.mark.parametrize("mode", ["overwrite", "replace", "merge"])
def test_a_commit_that_fails_at_any_step_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch, mode):
    schema = "instrument string, cal_idx int, close double"
    batch = pa.RecordBatch.from_pylist([{"instrument": i, "field": "close", "cal_idx": 1, "value": 9.0} for i in "BCD"])
    real, read = daybin._open, lambda p: sorted((r["instrument"], r["cal_idx"], r["value"]) for r in daybin.read(spark, p).where("value IS NOT NULL").collect())
    old = [(i, 3, 1.5) for i in "ABC"]
    want = {"overwrite": [(i, 1, 9.0) for i in "BCD"], "replace": [("A", 3, 1.5), *[(i, 1, 9.0) for i in "BCD"]], "merge": sorted([*old, *[(i, 1, 9.0) for i in "BCD"]])}[mode]
    seen, calls = set(), 0
    for step in range(1, 12):
        path = str(tmp_path / f"{mode}{step}")
        daybin.write(spark.createDataFrame(old, schema), ["close"], path)
        daybin.write(spark.createDataFrame(old, schema), ["close"], path)  # so that there is something to clean up
        writer = daybin.DayBinWriter(path, mode)
        message = writer.write(iter([batch.slice(0, 1), batch.slice(1)]))
        assert message == daybin.Written(3, 0)
        disk = Fails(real(path)[0], step)
        monkeypatch.setattr(daybin, "_open", lambda p, disk=disk: (disk, real(p)[1]))
        try:
            writer.commit([message])
        except OSError:
            monkeypatch.undo()
            writer.abort([message])
        monkeypatch.undo()
        calls = max(calls, step - disk.left if disk.left > 0 else step)
        got = read(path)
        assert got in (old, want)
        seen.add(tuple(got))
        if disk.left > 0:
            assert got == want
    assert seen == {tuple(old), tuple(want)} and calls < 10  # however many files there are


def test_two_writes_at_once(spark, tmp_path):
    path = str(tmp_path / "v")
    one, two = daybin.DayBinWriter(path, "merge"), daybin.DayBinWriter(path, "merge")
    batch = pa.RecordBatch.from_pylist([{"instrument": "A", "field": "x", "cal_idx": 1, "value": 9.0}])
    done = [w.write(iter([batch])) for w in (one, two)]
    one.commit(done[:1])
    with pytest.raises(OSError, match="came between"):
        two.commit(done[1:])
    two.abort(done[1:])
    assert [r["value"] for r in daybin.read(spark, path).collect()] == [9.0]


def test_repeated_tasks_and_rejects(spark, tmp_path):
    path = str(tmp_path / "v")
    writer = daybin.DayBinWriter(path, "replace")
    rows = [("A", "x", 1, 1.0), ("A", "y", 1, 1e300), ("A", "z", 1, 1.0), ("B", "x", 1, 2.0), ("B", "x", 1, 3.0), ("C", "x", 1 << 24, 1.0), ("D", "x", 5, 4.0), ("E", "x", 5, float("inf"))]
    batch = pa.RecordBatch.from_pylist([dict(zip(("instrument", "field", "cal_idx", "value"), r, strict=True)) for r in rows])
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))
    assert lost == kept == daybin.Written(2, 3)
    writer.commit([kept])
    assert sorted((r["instrument"], r["value"]) for r in daybin.read(spark, path).collect()) == [("D", 4.0), ("E", float("inf"))]
    assert sorted(map(tuple, daybin.rejects(spark, path).collect())) == [("A", "y", "a value is too large"), ("B", "x", "two values for a day"), ("C", "x", "day 16777216 is no position")]
    assert daybin.manifest(path)["notes"] == {"n_files": 2, "n_rejects": 3}


def test_many_versions_are_merged(spark, tmp_path):
    path, schema = str(tmp_path / "v"), "instrument string, cal_idx int, x double, y double"
    want = {}
    for k in range(daybin.VERSIONS + 4):
        inst = ["_I0", "I1", "I2"][k % 3]
        daybin.write(spark.createDataFrame([(inst, k, float(k), None), (inst, 0, float(-k - 1), None)], schema), ["x", "y"], path, mode="merge")
        want |= {(inst, k): float(k), (inst, 0): float(-k - 1)}
    daybin.write(spark.createDataFrame([("I1", 1, None, 5.0)], schema), ["x", "y"], path, mode="replace")
    want = {k: v for k, v in want.items() if k[0] != "I1"} | {("I1", 1): 5.0}
    read = lambda: {(r["instrument"], r["cal_idx"]): r["value"] for r in daybin.read(spark, path).where("value IS NOT NULL").collect()}
    assert read() == want and len(daybin.manifest(path)["versions"]) <= daybin.VERSIONS
    daybin.compact(spark, path)
    assert read() == want and len(daybin.manifest(path)["versions"]) == 1
    daybin.copy_tree(spark, path, str(tmp_path / "tree"))
    assert sorted(str(p.relative_to(tmp_path / "tree")) for p in (tmp_path / "tree").rglob("*.bin")) == ["I1/y.day.bin", "I2/x.day.bin", "_I0/x.day.bin"]
    assert {(r["instrument"], r["cal_idx"]): r["value"] for r in daybin.read(spark, str(tmp_path / "tree")).where("value IS NOT NULL").collect()} == want


@given(values, values, st.integers(0, 20), st.integers(0, 20))
def test_merge_is_by_position(a, b, i, j):
    get = lambda vs, k: {k + n: float(v) for n, v in enumerate(vs) if v is not None}
    x, y = (np.array([np.nan if v is None else v for v in vs], float) for vs in (a, b))
    old = daybin.pack(i + np.arange(len(x)), x)
    raw = daybin.merge(old, j + np.arange(len(y)), y) or old
    want = get(a, i) | get(b, j)
    start, out = daybin.unpack(raw) if raw else (0, np.empty(0))
    assert {start + n: float(v) for n, v in enumerate(out) if not np.isnan(v)} == want


def test_vectors_over_batches():
    rows = [{"instrument": i, "field": f, "cal_idx": k, "value": None if k == 2 else float(k)} for i in "AB" for f in "xy" for k in range(5)]
    batch = pa.RecordBatch.from_pylist(rows)
    for step in (1, 3, 20):
        got = list(daybin._vectors(batch.slice(k, step) for k in range(0, 20, step)))
        assert [n for n, _, _ in got] == [("A", "x"), ("A", "y"), ("B", "x"), ("B", "y")]
        assert all(i.tolist() == [0, 1, 2, 3, 4] and np.isnan(v[2]) and v[4] == 4.0 for _, i, v in got)


def test_lists(spark, tmp_path):
    df = spark.createDataFrame([("SZ1", None, None), ("SH2", date(2020, 1, 1), date(2021, 1, 1))], "instrument string, start date, end date")
    text.write_instruments(df, f"{tmp_path}/i")
    assert [tuple(r) for r in text.read_ranges(spark, f"{tmp_path}/i").collect()] == [("SH2", date(2020, 1, 1), date(2021, 1, 1)), ("SZ1", date(1990, 1, 1), date(2099, 12, 31))]
