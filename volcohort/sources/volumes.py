"""Labelled volumes as files: a data source that reads them as runs, a writer, and a table of headers that is kept.

A file is a NIfTI-1 volume, its voxels by i, then j, then k, packed or not; its case is its name without the ending. The source cuts
a plain file that is larger than a task's share into parts of `slab` slices, each read from there on alone; other files stay whole,
packed ones are unpacked as they are read, and no more than a slab is held. Parts are put together up to a task's share, as opening
a small file costs more than reading it. Files of cases that aren't asked for are not opened. Files are opened by the tasks through
Arrow's file systems, only those that are cut by the driver too."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from volcohort.operators.storage import dealt
from volcohort.sources.readers import HEAD, HEADER, _header

RUNS = "case_id string, k int, j int, i0 int, i1 int, label int"
ENDINGS = (".nii.gz", ".nii")
# Fixed values of the format: number types by code, bytes of the header.
TYPES = {2: "u1", 4: "i2", 8: "i4", 256: "i1", 512: "u2", 768: "u4"}
HEADER_BYTES, INT16 = 352, 4
SLAB = 32
#: Bytes that a task reads, about, and what opening a file counts as; the fewest tasks that parts are dealt over.
SHARE, OPENING, TASKS = 32 << 20, 1 << 16, 64
#: Rows of a batch, about; voxels of the volumes that are written in one call, one after the other.
ROWS, CELLS = 1 << 16, 1 << 21


def case_of(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return next((name[: -len(e)] for e in ENDINGS if name.endswith(e)), name)


def _opened(path: str) -> pa.NativeFile:
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def layout(head: bytes) -> tuple[list[int], str, int]:
    """(ni, nj, nk), number type and first byte of the voxels."""
    shape, _, _ = _header(head)
    end = "<" if struct.unpack("<i", head[:4])[0] == 348 else ">"
    (kind,), (first,) = struct.unpack(end + "h", head[70:72]), struct.unpack(end + "f", head[108:112])
    if kind not in TYPES:
        raise ValueError(f"voxels of type {kind} aren't labels")
    return [*shape, 1, 1, 1][:3], end + TYPES[kind], int(first)


def runs_of(case: str, slab: np.ndarray, k0: int) -> pa.RecordBatch:
    """Runs along i of a block (slices, lines, places) that begins at slice k0."""
    nk, nj, ni = slab.shape
    flat = slab.reshape(-1)
    starts = np.ones(len(flat), bool)
    starts[1:] = flat[1:] != flat[:-1]
    starts[::ni] = True
    at = np.flatnonzero(starts)
    end = np.append(at[1:], len(flat))
    kept = flat[at] != 0
    at, end = at[kept], end[kept]
    cells = [at // (ni * nj) + k0, at // ni % nj, at % ni, (end - 1) % ni, flat[at]]
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(case, pa.string()), len(at)), *(pa.array(c.astype(np.int32)) for c in cells)], names=["case_id", "k", "j", "i0", "i1", "label"])


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= ROWS:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


class _Part(InputPartition):
    """Parts (path, first, last) of files; no last: the whole file."""

    def __init__(self, pieces: list[tuple[str, int, int | None]]) -> None:
        self.pieces = pieces


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.slab, self.tasks = options["path"], int(options.get("slab", SLAB)), int(options.get("tasks", TASKS))
        self.cases = set(json.loads(options["cases"])) if "cases" in options else None

    def partitions(self) -> list[_Part]:
        store, name = fs.FileSystem.from_uri(self.path)
        files = [(f.path, f.size) for f in store.get_file_info(fs.FileSelector(name, recursive=True)) if f.type == fs.FileType.File and f.path.endswith(ENDINGS)]
        files = sorted(f for f in files if self.cases is None or case_of(f[0]) in self.cases)
        share = min(SHARE, sum(size + OPENING for _, size in files) // self.tasks)
        pieces = []
        for path, size in files:
            if path.endswith(".gz") or size + OPENING <= share:
                pieces.append((path, 0, None, size + OPENING))
                continue
            with store.open_input_file(path) as data:
                (ni, nj, nk), kind, _ = layout(data.read(HEADER_BYTES))
            part = ni * nj * self.slab * np.dtype(kind).itemsize + OPENING
            pieces += [(path, k, min(nk, k + self.slab), part) for k in range(0, nk, self.slab)]
        out, held, total = [], [], 0
        for *piece, cost in pieces:
            if held and total + cost > share:
                out.append(_Part(held))
                held, total = [], 0
            held.append(tuple(piece))
            total += cost
        return [*out, _Part(held)] if held else out

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        yield from joined(b for piece in part.pieces for b in self._slabs(*piece))

    def _slabs(self, path: str, k0: int, k1: int | None) -> Iterator[pa.RecordBatch]:
        store, case = fs.FileSystem.from_uri(self.path)[0], case_of(path)
        with store.open_input_file(path) as data:
            if path.endswith(".gz"):
                yield from self._unpacked(path, data)
                return
            (ni, nj, nk), kind, first = layout(data.read(HEADER_BYTES))
            size, k1 = ni * nj * np.dtype(kind).itemsize, nk if k1 is None else k1
            data.seek(first + k0 * size)
            for k in range(k0, k1, self.slab):
                n = min(k1, k + self.slab) - k
                held = data.read(n * size)
                if len(held) < n * size:
                    raise ValueError(f"{path} ends early")
                yield runs_of(case, np.frombuffer(held, kind).reshape(n, nj, ni), k)

    def _unpacked(self, path: str, data: pa.NativeFile) -> Iterator[pa.RecordBatch]:
        unpack, held, shape, k = zlib.decompressobj(wbits=31), b"", None, 0
        while True:
            block = data.read(1 << 20)
            held += unpack.decompress(block) if block else unpack.flush()
            if shape is None and len(held) >= HEADER_BYTES:
                shape, kind, first = layout(held[:HEADER_BYTES])
                held = held[first:]
                line = shape[0] * shape[1] * np.dtype(kind).itemsize
            if shape is not None:
                n = min(len(held) // line, shape[2] - k)
                for a in range(0, n, self.slab):
                    b = min(n, a + self.slab)
                    yield runs_of(case_of(path), np.frombuffer(held[a * line : b * line], kind).reshape(-1, shape[1], shape[0]), k + a)
                held, k = held[n * line :], k + n
            if not block:
                break
        if shape is None or k < shape[2]:
            raise ValueError(f"{path} ends early")


class VolumeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "labelled_volumes"

    def schema(self) -> str:
        return RUNS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def volumes(spark: SparkSession, path: str, cases: list[str] | None = None, slab: int = SLAB) -> DataFrame:
    """Runs of the volumes under a folder; of these cases only, if they are given."""
    spark.dataSource.register(VolumeSource)
    read = spark.read.format("labelled_volumes").option("slab", slab).option("tasks", max(TASKS, 4 * spark.sparkContext.defaultParallelism))
    return (read if cases is None else read.option("cases", json.dumps(cases))).load(path)


def packed(ni: int, nj: int, nk: int, spacing: list[float], voxels: np.ndarray) -> bytes:
    """A volume of 16-bit labels as the bytes of a file."""
    head = bytearray(HEADER_BYTES)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, ni, nj, nk, 1, 1, 1, 1)
    struct.pack_into("<hh", head, 70, INT16, 16)
    struct.pack_into("<8f", head, 76, 1, *spacing, 1, 1, 1, 1)
    struct.pack_into("<ff", head, 108, HEADER_BYTES, 1)
    struct.pack_into("<hh", head, 252, 0, 1)
    struct.pack_into("<12f", head, 280, spacing[0], 0, 0, 0, 0, spacing[1], 0, 0, 0, 0, spacing[2], 0)
    head[344:348] = b"n+1\0"
    return bytes(head) + voxels.astype("<i2").tobytes()


def write_volumes(runs: DataFrame, grids: DataFrame, path: str, zipped: bool = False) -> DataFrame:
    """Write a file for each case of `grids` (case_id, ni, nj, nk, si, sj, sk) with its runs; (case_id, file, bytes, crc) of what was
    written, which is done as this is read. A call gets the runs of the cases that fall to it and makes their volumes one after the
    other, so it holds one volume; a task that is tried again writes the same files over."""
    names = ["case_id", "file", "bytes", "crc"]

    def one(store: fs.FileSystem, folder: str, g: dict, k: np.ndarray, j: np.ndarray, i0: np.ndarray, i1: np.ndarray, label: np.ndarray) -> tuple:
        ni, nj, nk = int(g["ni"]), int(g["nj"]), int(g["nk"])
        line = (k * nj + j) * ni
        edge = np.zeros(ni * nj * nk + 1, np.int64)
        np.add.at(edge, line + i0, label)
        np.add.at(edge, line + i1 + 1, -label)
        data = packed(ni, nj, nk, [float(g[c]) for c in ("si", "sj", "sk")], np.cumsum(edge)[:-1])
        if zipped:
            pack = zlib.compressobj(wbits=31)
            data = pack.compress(data) + pack.flush()
        name = f"{g['case_id']}{ENDINGS[0] if zipped else ENDINGS[1]}"
        with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
            out.write(data)
        return g["case_id"], f"{path}/{name}", len(data), zlib.crc32(data)

    def some(grid: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(grid):
            return pd.DataFrame([], columns=names)
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        col = [held[c].to_numpy(np.int64) for c in ("k", "j", "i0", "i1", "label")]
        at, none = held.groupby("case_id").indices, np.zeros(0, np.int64)
        return pd.DataFrame([one(store, folder, g, *[c[at.get(g["case_id"], none)] for c in col]) for g in grid.to_dict("records")], columns=names)

    g = grids.select(F.col("case_id").cast("string").alias("case_id"), "ni", "nj", "nk", "si", "sj", "sk")
    r = runs.select(F.col("case_id").cast("string").alias("case_id"), "k", "j", "i0", "i1", "label")
    cells = g.agg(F.sum(F.col("ni").cast("long") * F.col("nj") * F.col("nk")).alias("n")).first()["n"] or 0
    calls = max(g.sparkSession.sparkContext.defaultParallelism, -(-cells // CELLS))
    both = [dealt(d.withColumn("_call", F.pmod(F.hash("case_id"), F.lit(calls))), "_call").groupBy("_call") for d in (g, r)]
    return both[0].cogroup(both[1]).applyInPandas(some, "case_id string, file string, bytes long, crc long")


def cached_headers(spark: SparkSession, path: str, cache: str, pattern: str = "*.nii*") -> DataFrame:
    """(file, modified, bytes, shape, spacing, affine, error) of the volumes under a folder. Headers are kept in the table `cache`, by
    name, time and size of their file: only files that aren't there, or have changed, are opened. Rows of files that went stay in
    the table and are not returned."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    files = listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    kept = f"{HEADER}, modified timestamp, bytes long"
    where = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    stored = spark.read.schema(kept).parquet(cache) if there else spark.createDataFrame([], kept)
    key = ["file", "modified", "bytes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file, modified, size in b[key].itertuples(index=False):
                try:
                    with _opened(file) as f:
                        rows.append((file, *_header(f.read(HEAD)), None, modified, size))
                except (ValueError, struct.error, OSError, EOFError, zlib.error) as e:
                    rows.append((file, None, None, None, str(e), modified, size))
            yield pd.DataFrame(rows, columns=["file", "shape", "spacing", "affine", "error", "modified", "bytes"])

    files.join(stored.select(*key), key, "left_anti").mapInPandas(run, kept).write.mode("append").parquet(cache)
    return files.join(spark.read.schema(kept).parquet(cache).dropDuplicates(key), key)
