"""Tolerant readers: JSON documents in several wrappings, NDJSON logs, CSV tables that may be absent, volume headers."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with a header; an absent file is an empty table. Empty text is NULL."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema, nullValue="", mode="PERMISSIVE")


def manifest(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of JSON documents: a list, or a list under `records` or `cases`, or a map of records."""
    rows = T.ArrayType(record)
    text = spark.read.text(path, wholetext=True)
    fits = lambda kind: F.from_json("value", kind, {"mode": "PERMISSIVE"})
    under = fits(T.StructType([T.StructField("records", rows), T.StructField("cases", rows)]))
    start = F.ltrim(F.regexp_replace("value", r"^\s+", "")).startswith("[")
    found = F.when(start, fits(rows)).otherwise(F.coalesce(under["records"], under["cases"], F.map_values(fits(T.MapType(T.StringType(), record)))))
    return text.select(F.explode(found).alias("r")).select("r.*")


def log(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines) of NDJSON files; rows have `_file` and `_line`, by which later ones win."""
    lines = spark.read.text(path).withColumn("_file", F.col("_metadata.file_path")).withColumn("_line", F.monotonically_increasing_id())
    parsed = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())]), {"columnNameOfCorruptRecord": "_corrupt_record"}))
    good = parsed.where("r._corrupt_record is null").select(*[f"r.{f.name}" for f in schema.fields], "_file", "_line")
    return good, parsed.where("r._corrupt_record is not null").select("value", "_file", "_line")


def last_wins(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in [*keys, "_file", "_line"]]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_file", "_line")).alias("_r")).select(*keys, "_r.*")


def template(text, key: str = "key", value: str = "value") -> DataFrame:
    """(key, value) of lines `key: value` of a text table with column `value`; lines of other forms are left out."""
    return text.where(F.col("value").rlike(r"^\s*[^:#]+:")).select(
        F.lower(F.trim(F.regexp_extract("value", r"^\s*([^:#]+):\s*(.*)$", 1))).alias(key), F.trim(F.regexp_extract("value", r"^\s*([^:#]+):\s*(.*)$", 2)).alias(value)
    )


def landmarks(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, position): placed control points of markup documents."""
    point = T.StructType([T.StructField("label", T.StringType()), T.StructField("position", T.ArrayType(T.DoubleType())), T.StructField("positionStatus", T.StringType())])
    schema = T.StructType([T.StructField("markups", T.ArrayType(T.StructType([T.StructField("controlPoints", T.ArrayType(point))])))])
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", schema).alias("d"))
    points = docs.select("file", F.explode("d.markups").alias("m")).select("file", F.explode("m.controlPoints").alias("p"))
    return points.where("coalesce(p.positionStatus, 'defined') = 'defined' and size(p.position) = 3").select("file", F.col("p.label").alias("name"), "p.position")


#: Bytes that hold a header, packed or not.
HEAD = 4096
HEADER = "file string, shape array<int>, spacing array<double>, affine array<double>, error string"


def _header(data: bytes) -> tuple[list[int], list[float], list[float]]:
    """Shape, spacing and row-major affine of a NIfTI-1 header."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompressobj(wbits=31).decompress(data, 352)
    end = "<" if struct.unpack("<i", data[:4])[0] == 348 else ">"
    if struct.unpack(end + "i", data[:4])[0] != 348:
        raise ValueError("not a NIfTI-1 header")
    dim = struct.unpack(end + "8h", data[40:56])
    spacing = [float(x) for x in struct.unpack(end + "8f", data[76:108])[1:4]]
    rows = struct.unpack(end + "12f", data[280:328])
    return [int(x) for x in dim[1 : 1 + dim[0]]], spacing, [float(x) for x in rows] + [0.0, 0.0, 0.0, 1.0]


def volume_headers(spark: SparkSession, path: str, pattern: str = "*.nii*") -> DataFrame:
    """Shape, spacing and affine of each volume file; a broken file gets a row with its error. Only the first HEAD bytes of a file
    are read, by the task that has its path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file in b["path"]:
                try:
                    store, name = fs.FileSystem.from_uri(unquote(file) if file.startswith("file:") else file)
                    with store.open_input_stream(name) as f:
                        rows.append((file, *_header(f.read(HEAD)), None))
                except (ValueError, struct.error, OSError, EOFError, zlib.error) as e:
                    rows.append((file, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["file", "shape", "spacing", "affine", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path").mapInPandas(run, HEADER)
