"""Volumes written, read back as runs, and their headers kept."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.errors import PySparkException

from volcohort.operators import voxel
from volcohort.sources import volumes


@pytest.mark.parametrize("zipped", [False, True])
def test_round_trip(spark, tmp_path, zipped):
    rng = random.Random(1)
    cells = sorted({(c, rng.randrange(9), rng.randrange(4), rng.randrange(6)): rng.randint(1, 3) for c in (1, 2, 3) for _ in range(120)}.items())
    runs = voxel.runs(spark.createDataFrame([(*p, v) for p, v in cells], "case_id int, k int, j int, i int, label int"))
    grids = spark.createDataFrame([(c, 6, 4, 9, 0.5, 1.0, 2.0) for c in (1, 2, 3, 4)], "case_id int, ni int, nj int, nk int, si double, sj double, sk double")
    path = f"file://{tmp_path}/v"
    assert {r.case_id for r in volumes.write_volumes(runs, grids, path, zipped).collect()} == {"1", "2", "3", "4"}
    got = {(int(r.case_id), r.k, r.j, r.i0, r.i1, r.label) for r in volumes.volumes(spark, path, slab=4).collect()}
    assert got == {(r.case_id, r.k, r.j, r.i0, r.i1, r.label) for r in runs.collect()}
    if not zipped:
        assert volumes.volumes(spark, path, slab=4).rdd.getNumPartitions() == 12
    # Files of other cases aren't opened: a broken one does no harm.
    name = f"{tmp_path}/v/2.nii" + ".gz" * zipped
    with open(name, "r+b") as f:
        f.truncate(20)
    assert {r.case_id for r in volumes.volumes(spark, path, ["1", "3"]).collect()} == {"1", "3"}
    with pytest.raises(PySparkException):
        volumes.volumes(spark, path).collect()


def test_headers_are_kept(spark, tmp_path):
    grids = spark.createDataFrame([(c, 6, 4, 9, 0.5, 1.0, 2.0) for c in (1, 2)], "case_id int, ni int, nj int, nk int, si double, sj double, sk double")
    none = spark.createDataFrame([], "case_id int, k int, j int, i0 int, i1 int, label int")
    volumes.write_volumes(none, grids, f"file://{tmp_path}/v").collect()
    cache = f"{tmp_path}/cache"
    get = lambda: {volumes.case_of(r.file): (r.shape, r.spacing, r.error) for r in volumes.cached_headers(spark, f"{tmp_path}/v", cache).collect()}
    assert get() == {c: ([6, 4, 9], [0.5, 1.0, 2.0], None) for c in ("1", "2")}
    assert get()["1"][0] == [6, 4, 9] and spark.read.parquet(cache).count() == 2  # nothing was read again
    with open(f"{tmp_path}/v/2.nii", "wb") as f:
        f.write(b"x" * 400)
    assert get()["2"][2] is not None and spark.read.parquet(cache).count() == 3
    os.remove(f"{tmp_path}/v/1.nii")
    assert set(get()) == {"2"}
