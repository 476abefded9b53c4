"""Files of a version of day vectors: few, however many vectors, and only those that its manifest names count."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapeline.sources import daybin


def test_files_do_not_grow_with_vectors(spark, tmp_path):
    path, n = str(tmp_path / "v"), 700
    slots = spark.range(n).select(F.format_string("SZ%06d", "id").alias("instrument"), F.explode(F.array(F.lit(3), F.lit(5))).alias("cal_idx"), "id")
    slots = slots.select("instrument", "cal_idx", (F.col("id") + F.col("cal_idx")).cast("double").alias("x"), F.lit(1.0).alias("y"))
    daybin.write(slots.where("cal_idx = 3"), ["x", "y"], path)
    daybin.write(slots, ["x", "y"], path, mode="append")
    assert sum(p.is_file() for p in tmp_path.rglob("v*/*") if "crc" not in p.name) <= 2 * daybin.BUCKETS + 2
    want = {(f"SZ{i:06d}", f, k): float(i + k) if f == "x" else 1.0 for i in range(n) for f in "xy" for k in (3, 5)}
    read = lambda: {(r["instrument"], r["field"], r["cal_idx"]): r["value"] for r in daybin.read(spark, path).where("value IS NOT NULL").collect()}
    assert read() == want
    daybin.compact(spark, path)
    assert read() == want and len(daybin.manifest(path)["versions"]) == 1


def test_compaction_of_another_state_is_refused(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = spark.createDataFrame([("A", 3, 1.5)], "instrument string, cal_idx int, x double")
    daybin.write(rows, ["x"], path)
    daybin.write(rows, ["x"], path, mode="merge")
    with pytest.raises(OSError, match="came between"):
        daybin.DayBinWriter(path, "packed", of=1)


def test_vectors_with_a_file_each_are_refused(tmp_path):
    (tmp_path / f"{daybin.MANIFEST}0000000001.json").write_text('{"number": 1, "versions": ["v1"], "notes": {}}')
    with pytest.raises(ValueError, match="run it again"):
        daybin.manifest(str(tmp_path))
