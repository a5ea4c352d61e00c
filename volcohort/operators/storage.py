"""Tables that cut lineage, in the folder the cluster shares (`spark.checkpoint.dir`).

They are written and read again rather than checkpointed: a checkpoint hands the constraints of its plan on, and in loops of joins
these multiply until planning takes longer than the work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder. Only a local session may go without one: it gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="cohort-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def staged(df: DataFrame, tag: str) -> DataFrame:
    """`df`, written and read again. Runs and voxels pack so well that Spark takes the table for small, so its joins are told to
    shuffle."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """`df` by its keys over a fixed number of tasks. Groups that Python works on are few bytes and much work, so Spark would join
    their partitions into a few tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def forget(table: DataFrame) -> None:
    """Delete the files of a table from `staged` that nothing reads any more."""
    spark = table.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
