"""Streams over files give what a batch gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.streaming import ledger


def test_windowed_counts_match_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = str(tmp_path / "in")
    source.repartition(3).write.parquet(folder)
    got = ledger.run_available(ledger.windowed_counts(ledger.events(spark, folder, source.schema), "30 days", "1 day"), "counts", "complete", str(tmp_path / "cp"))
    want = source.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day"), "event_type").count()
    assert sorted((str(r.window.start), r.event_type, r.n) for r in got.collect()) == sorted((str(r.window.start), r.event_type, r["count"]) for r in want.collect())


def test_submissions_are_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (2, 4, "c")], "case_id long, event_id long, digest string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = ledger.run_available(ledger.submissions(stream), "outcomes", "append", str(tmp_path / "cp"))
    assert {r.event_id: r.outcome for r in got.collect()} == {1: "accepted", 2: "duplicate", 3: "conflict", 4: "accepted"}


def test_leases(spark, tmp_path):
    rows = [(1, "a", "2026-01-01 00:00:00"), (1, "b", "2026-01-01 01:00:00"), (1, "a", "2026-01-01 02:00:00"), (1, "b", "2026-01-03 00:00:00"), (2, "c", "2026-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "case_id long, reviewer string, t string").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark("ts", "1 hour")
    got = ledger.run_available(ledger.leases(stream, 24), "leases", "append", str(tmp_path / "cp")).collect()
    assert [r.outcome for r in sorted(got, key=lambda r: r.at) if r.case_id == 1 and r.outcome != "expired"] == ["granted", "refused", "granted", "granted"]
    assert [r.reviewer for r in got if r.outcome == "expired"] == ["c"]


def test_watched_folder(spark, tmp_path):
    from pyspark.sql import types as T

    folder = tmp_path / "w"
    folder.mkdir()
    for n, body in enumerate(['{"ok": true}', '{"ok": false}', '{"ok": tr', '{"ok": true}']):
        (folder / f"{n}.json").write_text(body)
    schema = T.StructType([T.StructField("ok", T.BooleanType())])
    got = ledger.run_available(ledger.watched(spark, str(folder), schema), "watched", "complete", str(tmp_path / "cp"))
    assert {r.verdict: r.n for r in got.collect()} == {"pass": 2, "fail": 1, "retry": 1}
