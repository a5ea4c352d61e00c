"""Readers on files in several wrappings."""

from __future__ import annotations

import gzip
import json
import struct

from pyspark.sql import types as T

from volcohort.sources import readers

RECORD = T.StructType([T.StructField("token", T.StringType()), T.StructField("n", T.IntegerType())])


def test_manifest_wrappings(spark, tmp_path):
    rows = [{"token": "1", "n": 2}, {"token": "3"}]
    for name, doc in {"a": rows, "b": {"records": rows}, "c": {"cases": rows}, "d": {"x": rows[0], "y": rows[1]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
        got = sorted((r.token, r.n) for r in readers.manifest(spark, str(tmp_path / f"{name}.json"), RECORD).collect())
        assert got == [("1", 2), ("3", None)], name


def test_log_last_wins_and_counts_broken(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"token": "1", "n": 1}\n{"token": "1", "n": 2}\n{broken\n\n')
    good, bad = readers.log(spark, str(tmp_path), RECORD)
    assert [(r.token, r.n) for r in readers.last_wins(good, ["token"]).collect()] == [("1", 2)]
    assert bad.count() == 1


def test_absent_csv_is_empty(spark, tmp_path):
    assert readers.csv(spark, str(tmp_path / "none.csv"), RECORD).count() == 0
    (tmp_path / "x.csv").write_text("token,n\n1,\n,4\n")
    assert sorted(map(tuple, readers.csv(spark, str(tmp_path / "x.csv"), RECORD).collect()), key=str) == [("1", None), (None, 4)]


def test_landmarks_and_template(spark, tmp_path):
    points = [{"label": "L5", "position": [1, 2, 3]}, {"label": "S1", "position": [0, 0, 0], "positionStatus": "undefined"}]
    (tmp_path / "m.json").write_text(json.dumps({"markups": [{"controlPoints": points}]}))
    assert [(r.name, r.position) for r in readers.landmarks(spark, str(tmp_path / "m.json")).collect()] == [("L5", [1.0, 2.0, 3.0])]
    text = spark.createDataFrame([("Grade : IIb ",), ("# no: x",), ("plain",)], "value string")
    assert [tuple(r) for r in readers.template(text).collect()] == [("grade", "IIb")]


def test_volume_headers(spark, tmp_path):
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, 4, 5, 6, 1, 1, 1, 1)
    struct.pack_into("<8f", head, 76, 1, 0.5, 0.75, 2, 0, 0, 0, 0)
    struct.pack_into("<12f", head, 280, *range(12))
    (tmp_path / "a.nii").write_bytes(bytes(head))
    (tmp_path / "b.nii.gz").write_bytes(gzip.compress(bytes(head)))
    (tmp_path / "c.nii").write_bytes(b"nothing")
    got = {r.file.rsplit("/", 1)[1]: r for r in readers.volume_headers(spark, str(tmp_path)).collect()}
    assert got["a.nii"].shape == got["b.nii.gz"].shape == [4, 5, 6] and got["a.nii"].spacing == [0.5, 0.75, 2.0]
    assert got["a.nii"].affine[:4] == [0.0, 1.0, 2.0, 3.0] and got["c.nii"].error


def test_sinks(spark, tmp_path):
    from volcohort.sources import sinks

    schema = T.StructType([T.StructField("token", T.StringType(), False), T.StructField("n", T.IntegerType(), False), T.StructField("score", T.DoubleType()), T.StructField("late", T.BooleanType())])
    rows = spark.createDataFrame([("1", "7", "", True), ("", None, "x", True), ("3", "1", "2.5", False)], "token string, n string, score string, ok boolean")
    assert sorted(map(tuple, sinks.conform(rows, schema).collect())) == [("", 0, None, None), ("1", 7, None, None), ("3", 1, 2.5, None)]
    sinks.manifest(rows, str(tmp_path / "m"), schema)
    assert sorted(r.token for r in spark.read.json(str(tmp_path / "m/json")).collect()) == ["", "1"]
    sinks.splits(rows.withColumnRenamed("token", "split").where("split <> ''"), str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("split=*")) == ["split=1", "split=3"]
    for n in (1, 2):
        sinks.log(spark.createDataFrame([("1", n)], RECORD), str(tmp_path / "log"))
    good, bad = readers.log(spark, str(tmp_path / "log"), RECORD)
    assert good.count() == 2 and bad.count() == 0
    lines = sinks.label_lines(spark.createDataFrame([(20, "L1")], "id int, name string")).collect()
    assert lines[0].value == '20 60 60 140 1 1 1 "L1"'
