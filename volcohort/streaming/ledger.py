"""The ledger and the watched folder as Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def events(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """New Parquet files of a folder, each once; `ts` becomes a timestamp that can carry a watermark."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(stream: DataFrame, late: str, width: str) -> DataFrame:
    """(window, event_type, n, total): tumbling windows; rows later than `late` are left out."""
    w = F.window("ts", width)
    return stream.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


STATE = "digest string, outcome string"
OUT = "case_id long, event_id long, outcome string"


def submissions(stream: DataFrame) -> DataFrame:
    """(case_id, event_id, outcome) of rows (case_id, event_id, digest): the first digest of a case is accepted, the same
    again is a duplicate, another one is a conflict. The state of a case is one digest."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get[0] if state.exists else None
        rows = []
        for b in batches:
            for i, d in sorted(zip(b["event_id"], b["digest"], strict=True)):
                rows.append((key[0], i, "accepted" if held is None else "duplicate" if d == held else "conflict"))
                held = held or d
        state.update((held, ""))
        yield pd.DataFrame(rows, columns=["case_id", "event_id", "outcome"])

    return stream.groupBy("case_id").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Run over what is there and stop; the result is an in-memory table, for reports and tests."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return stream.sparkSession.table(name)


LEASES = "case_id long, reviewer string, at timestamp, outcome string"


def leases(stream: DataFrame, hours: int) -> DataFrame:
    """(case_id, reviewer, at, outcome) of claims (case_id, reviewer, ts) with a watermark: granted if the case is free, its lease
    has run out or is the reviewer's own; else refused. When the watermark passes a lease's end it is given up: expired."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = []
        if state.hasTimedOut:
            holder, until = state.get
            rows.append((key[0], holder, pd.Timestamp(until, unit="ms"), "expired"))
            state.remove()
        else:
            holder, until = state.get if state.exists else (None, 0)
            claims = pd.concat(list(batches)).sort_values(["ts", "reviewer"])
            for who, at in zip(claims["reviewer"], claims["ts"], strict=True):
                now = int(at.timestamp() * 1000)
                if holder is None or now >= until or who == holder:
                    holder, until = who, now + hours * 3_600_000
                    rows.append((key[0], who, at, "granted"))
                else:
                    rows.append((key[0], who, at, "refused"))
            state.update((holder, until))
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=["case_id", "reviewer", "at", "outcome"])

    return stream.groupBy("case_id").applyInPandasWithState(step, LEASES, "reviewer string, until long", "append", GroupStateTimeout.EventTimeTimeout)


def watched(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """(verdict, n): running totals of verdicts over JSON files of a folder, each read once; a file whose JSON is broken counts as
    retry."""
    rows = spark.readStream.text(folder, wholetext=True).select(F.from_json("value", schema).alias("r"))
    verdict = F.when(F.col("r").isNull() | F.col("r.ok").isNull(), "retry").when(F.col("r.ok"), "pass").otherwise("fail")
    return rows.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
