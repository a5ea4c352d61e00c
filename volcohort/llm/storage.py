"""Tables that cut lineage, kept in the folder the cluster shares (`spark.checkpoint.dir`)."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes of its serialized rows, that is sent whole to every executor.
BROADCAST_BYTES = 48 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session may go without one: it gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later steps survive a lost executor without recomputing."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_of(staged: DataFrame) -> int:
    """Bytes of the files behind a table that `stage` returned."""
    jvm = staged.sparkSession._jvm
    conf = staged.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in staged.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def drop(staged: DataFrame) -> None:
    """Delete the files behind a table that `stage` returned, once nothing reads it any more."""
    jvm = staged.sparkSession._jvm
    conf = staged.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def small(staged: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast where the files of a staged table are within `limit` (a quarter of it, as they are compressed);
    else leave the join to be shuffled."""
    return F.broadcast(staged) if 4 * size_of(staged) <= limit else staged


#: Keys with more than one in HOT of all rows, of which there are fewer than HOT, are looked up by broadcast.
HOT = 1000


def lookup(df: DataFrame, staged: DataFrame, keys: list[str], count: str) -> DataFrame:
    """`df` left-joined on `keys` with `staged`, which has each key once and in `count` how many rows of `df` have it at most.
    A table that isn't small is shuffled, but for the hot keys, so that no task gets all rows of a key."""
    held = staged.drop(count)
    if 4 * size_of(staged) <= BROADCAST_BYTES:
        return df.join(F.broadcast(held), keys, "left")
    total = staged.agg(F.sum(count).alias("n")).first()["n"] or 0
    hot = F.broadcast(staged.where(F.col(count) * HOT > total).drop(count))
    rest = df.join(hot.select(*keys), keys, "left_anti").join(held, keys, "left")
    return df.join(hot, keys).select(*rest.columns).union(rest)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for the jobs inside; the session's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more, before the next round adds its own."""
    gc.collect()
    spark._jvm.System.gc()
