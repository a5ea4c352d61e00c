"""Writers: a manifest with a fixed schema, splits by folder, append-only logs, label tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults of columns that may not be NULL.
ZEROS = {T.StringType(): "", T.IntegerType(): 0, T.LongType(): 0, T.DoubleType(): 0.0, T.BooleanType(): False}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, in its order and types: a missing column is NULL, empty text is NULL, and a column that
    may not be NULL gets the zero of its type."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        c = F.when(c.cast("string") != "", c).try_cast(f.dataType)
        out.append((c if f.nullable else F.coalesce(c, F.lit(ZEROS[f.dataType]).cast(f.dataType))).alias(f.name))
    return df.select(*out)


def manifest(df: DataFrame, path: str, schema: T.StructType, ok: str = "ok") -> None:
    """The rows that are ok, as JSON lines and as CSV, in parts as Spark writes them."""
    held = conform(df.where(F.col(ok)), schema)
    held.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/json")
    held.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def splits(df: DataFrame, path: str, split: str = "split") -> None:
    """A folder for each split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def log(df: DataFrame, path: str) -> None:
    """Rows appended to a log of JSON lines; readers let later lines win."""
    df.write.mode("append").json(path)


def label_lines(labels: DataFrame) -> DataFrame:
    """(value): a line `id r g b a visible mesh "name"` for each label (id, name), with colours by rule."""
    shade = lambda m: F.pmod(F.col("id") * m, F.lit(256)).cast("int")
    return labels.select(F.format_string('%d %d %d %d 1 1 1 "%s"', F.col("id"), shade(67), shade(131), shade(199), F.col("name")).alias("value"))
