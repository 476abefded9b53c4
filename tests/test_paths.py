"""Where tables and vectors go when the shared folder or a path is given without a scheme, or behind a mount."""

from __future__ import annotations

import pytest

from tapeline.sources import daybin, paths


@pytest.mark.parametrize("kind", ["plain", "mount"])
def test_vectors_in_any_shared_folder_of_a_cluster(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")  # what a cluster's session says
    folder = tmp_path / "shared"
    folder.mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.paths.link./s", f"file://{folder}")
    at, get = str(folder) if kind == "plain" else "viewfs://paths/s", type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, key, *of: at if key == "spark.checkpoint.dir" else get(conf, key, *of))
    path = paths.fresh_path(spark, "vectors")
    rows = spark.createDataFrame([("A", 3, 1.5), ("B", 1, 2.5)], "instrument string, cal_idx int, close double")
    daybin.write(rows, ["close"], path)
    got = {(r["instrument"], r["cal_idx"], r["value"]) for r in daybin.read(spark, path).collect()}
    assert got == {("A", 3, 1.5), ("B", 1, 2.5)}
    assert path.startswith("file:") and daybin.manifest(path)["versions"]


def test_vectors_at_a_path_without_a_scheme(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    path = str(tmp_path / "v")
    rows = spark.createDataFrame([("A", 3, 1.5)], "instrument string, cal_idx int, close double")
    for mode in ("overwrite", "append"):
        daybin.write(rows, ["close"], path, mode)
    daybin.copy_tree(spark, path, str(tmp_path / "tree"))
    assert [r["value"] for r in daybin.read(spark, str(tmp_path / "tree")).collect()] == [1.5]
