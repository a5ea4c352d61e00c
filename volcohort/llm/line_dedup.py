"""Line dedup by a sharded minimal perfect hash.

A line's key is the line without white space at both ends, A-Z in lower case, named by two hashes of 64 bits. A key of LEAST code
points or more that several documents hold keeps its lines only in the document of smallest doc_id.

Spark gathers each key's first document and the number of rows that hold it; a task brings one row for a key, so a line of all
documents is no hot group. The distinct names that more than one document holds, the only ones that can drop a line, are dealt
to shards by hash. A shard is a minimal perfect hash with no key stored: at each level a key sets a bit by a hash of its own, the
keys alone at their bit are done, the others go one level deeper; the rank of a key's bit among all is its slot. By slot the shard
holds a fingerprint of 64 bits, the count and the first document. Documents probe these arrays; no line is joined. A name that
isn't indexed lands on a slot of another fingerprint.

Where the arrays are within BROADCAST_BYTES they are sent to the tasks. Beyond it the probes, names alone, are shuffled to the
shards in portions of about PORTION rows: a shard whose keys are asked for more often is handed out several times.

Nulls: a null text is one empty line; a null doc_id counts as the smallest. Rows that share a doc_id are one document. Repeated
lines stay where their document is the first. Very long texts are taken line by line, whole. Empty tables give no rows. Other
columns of the input pass through `drop_lines` and are ignored by `measure`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from volcohort.llm.repeats import NO_ID, mix
from volcohort.llm.storage import BROADCAST_BYTES, small, stage
from volcohort.llm.text import text_of, unboxed

LEAST = 10
WHITE = b" \t\n\x0b\x0c\r"
#: Keys of a shard, on average; few keys still make several shards for each partition.
SHARD_KEYS = 1 << 15
#: Bits for each key that a level still has.
SPARSE = 2
#: Probes of a shard that one task answers at once.
PORTION = 1 << 20
#: Bytes of an indexed key: fingerprint, first document, count, and four bits of its level.
KEY_BYTES = 21
NAMES = "a long, b long"
SHARD = "shard int, sizes binary, bits binary, prints binary, firsts binary, counts binary"


def keys_of(text: bytes | None) -> list[bytes]:
    """The key of each line; the empty one where it has fewer than LEAST code points."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(WHITE).lower()
        out.append(key if len(key) >= LEAST and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= LEAST) else b"")
    return out


def named(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two names of 64 bits for each key."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def _bit(a: np.ndarray, b: np.ndarray, level: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """The bit that a key takes among `size` at a level."""
    return mix(a ^ mix(b + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))) % size


def build(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(size of each level, all bits, slot of each key) of a minimal perfect hash over distinct names."""
    sizes, bits, left = [], [], np.arange(len(a))
    level_of, bit_of = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    while len(left):
        size = max(8, SPARSE * len(left))
        at = _bit(a[left], b[left], len(sizes), np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        done = alone[at]
        level_of[left[done]], bit_of[left[done]] = len(sizes), at[done]
        sizes.append(size)
        bits.append(alone)
        left = left[~done]
    every = np.concatenate(bits) if bits else np.zeros(0, bool)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return sizes, every, (np.cumsum(every) - 1)[starts[level_of] + bit_of] if len(a) else np.empty(0, np.int64)


class Index:
    """Shards side by side: `find` gives the slot of names that are indexed, over all shards, else -1."""

    def __init__(self, rows: list[dict], shards: int) -> None:
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards, self.row = shards, np.full(shards, -1)
        self.row[[r["shard"] for r in rows]] = np.arange(len(rows))
        levels = [np.frombuffer(r["sizes"], np.int64) for r in rows]
        self.sizes = np.zeros((len(rows), max([len(x) for x in levels], default=0)), np.int64)
        for i, x in enumerate(levels):
            self.sizes[i, : len(x)] = x
        of = np.concatenate([[0], np.cumsum(self.sizes)])[:-1] if self.sizes.size else np.empty(0, np.int64)
        self.starts = of.reshape(self.sizes.shape)
        bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: int(x.sum())] for r, x in zip(rows, levels, strict=True)]
        self.bits = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits, dtype=np.int32) - 1
        put = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows]) if rows else np.empty(0, kind)
        self.prints, self.firsts, self.counts = put("prints", np.uint64), put("firsts", np.int64), put("counts", np.int32)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        row = self.row[(a % np.uint64(self.shards)).astype(np.int64)]
        left = np.flatnonzero(row >= 0)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[row[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.starts[row[left], level] + _bit(a[left], b[left], level, size.astype(np.uint64)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        known = out >= 0
        known[known] = self.prints[out[known]] == b[known]
        return np.where(known, out, -1)

    def later(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """A mask of the names that are indexed with a document before `doc`."""
        slot = self.find(a, b)
        out = slot >= 0
        out[out] = self.firsts[slot[out]] < doc[out]
        return out


def _names(docs: DataFrame) -> DataFrame:
    """(a, b, doc, last, n): for each key of a batch of documents its names, first and last document and rows that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[bytes, list] = {}
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for key in set(keys_of(text)) - {b""}:
                    x = first.get(key)
                    if x is None:
                        first[key] = [doc, doc, 1]
                    else:
                        x[:] = min(x[0], doc), max(x[1], doc), x[2] + 1
            a, b = named(list(first))
            held = np.array(list(first.values()), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a.view(np.int64), b.view(np.int64), *held.T)], names=["a", "b", "doc", "last", "n"])

    return docs.mapInArrow(run, f"{NAMES}, doc long, last long, n long")


def _shard_of(a: str, shards: int) -> Column:
    """a modulo the number of shards, a read as unsigned."""
    k = F.lit(shards)
    return F.pmod(F.pmod(a, k) + F.when(F.col(a) < 0, F.lit((1 << 64) % shards)).otherwise(0), k).cast("int")


def _built(shared: DataFrame, shards: int) -> DataFrame:
    """A row of arrays for each shard of (a, b, doc, n)."""

    def one(table: pa.Table) -> pa.Table:
        a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        sizes, bits, slot = build(a, b)
        order = np.argsort(slot)
        held = [np.array(sizes, np.int64), np.packbits(bits), b[order], table.column("doc").to_numpy()[order], table.column("n").to_numpy()[order].clip(max=2**31 - 1).astype(np.int32)]
        cells = [pa.array([table.column("shard")[0].as_py()], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in held)]
        return pa.Table.from_arrays(cells, names=["shard", "sizes", "bits", "prints", "firsts", "counts"])

    return shared.withColumn("shard", _shard_of("a", shards)).groupBy("shard").applyInArrow(one, SHARD)


def _applied(docs: DataFrame, extra: list[str], gone: Callable[[pa.RecordBatch, np.ndarray, list[bytes]], np.ndarray]) -> DataFrame:
    """`docs` without `extra`: text with the lines that stay, n_lines and n_dropped. gone(batch, row of each key, keys): which go."""
    kept = [c for c in docs.columns if c not in extra]
    schema = docs.select(*kept, F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            keys = [keys_of(t) for t in texts]
            lines = np.array([len(k) for k in keys], np.int64)
            flat = [k for x in keys for k in x]
            at = np.flatnonzero(np.array([bool(k) for k in flat], bool))
            row = np.repeat(np.arange(len(texts)), lines)
            hit = at[gone(batch, row[at], [flat[i] for i in at.tolist()])] if len(at) else at
            drops = np.bincount(row[hit], minlength=len(texts))
            stays = np.ones(len(flat), bool)
            stays[hit] = False
            ends = np.cumsum(lines)
            for i in np.flatnonzero(drops).tolist():
                mask = stays[ends[i] - lines[i] : ends[i]].tolist()
                texts[i] = b"\n".join([x for x, k in zip(texts[i].split(b"\n"), mask, strict=True) if k])
            made = {c: batch.column(c) for c in kept} | {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines), "n_dropped": pa.array(drops.astype(np.int64))}
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return docs.mapInArrow(run, schema)


def _probed(docs: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """The arrays are sent to the tasks, which probe them."""
    sent = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in index.collect()])  # within BROADCAST_BYTES
    held: list[Index] = []

    def gone(batch: pa.RecordBatch, row: np.ndarray, keys: list[bytes]) -> np.ndarray:
        if not held:
            held.append(Index(sent.value, shards))
        return held[0].later(*named(keys), batch.column("doc").to_numpy()[row])

    return _applied(docs, [], gone)


def _shuffled(docs: DataFrame, index: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Names are shuffled to their shards. asked: (shard, n), how many rows hold the keys of a shard."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sorted(set(keys_of(t)) - {b""}) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            a, b = named([k for x in keys for k in x])
            doc = np.repeat(batch.column("doc").to_numpy(), [len(x) for x in keys])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a.view(np.int64), b.view(np.int64), doc)], names=["a", "b", "doc"])

    def answer(key: tuple, probes: pa.Table, arrays: pa.Table) -> pa.Table:
        a, b, doc = (probes.column(c).to_numpy() for c in ("a", "b", "doc"))
        found = Index(arrays.to_pylist(), shards).later(a.view(np.uint64), b.view(np.uint64), doc)
        return probes.select(["doc", "a"]).filter(pa.array(found))

    def gone(batch: pa.RecordBatch, row: np.ndarray, keys: list[bytes]) -> np.ndarray:
        a, out = named(keys)[0].view(np.int64), np.zeros(len(keys), bool)
        for i, names in enumerate(batch.column("_gone").to_pylist()):
            if names:
                low, high = np.searchsorted(row, [i, i + 1])
                out[low:high] = np.isin(a[low:high], np.array(names, np.int64))
        return out

    # A shard that is asked for more than PORTION times is there several times; fewer than asked / PORTION shards are.
    many = F.broadcast(asked.select(F.col("shard").alias("_s"), F.ceil(F.col("n") / PORTION).alias("_n")).where("_n > 1"))
    copies = F.coalesce("_n", F.lit(1).cast("long"))
    probes = docs.select("doc", "text").mapInArrow(names, f"{NAMES}, doc long").withColumn("shard", _shard_of("a", shards))
    probes = probes.join(many, F.col("shard") == F.col("_s"), "left").withColumn("copy", F.pmod(F.xxhash64("doc", "a"), copies)).drop("_s", "_n")
    arrays = index.join(many, F.col("shard") == F.col("_s"), "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("_s", "_n")
    found = probes.groupBy("shard", "copy").cogroup(arrays.groupBy("shard", "copy")).applyInArrow(answer, "doc long, a long")
    by_doc = stage(found.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("a").alias("_gone")), "lines-gone")
    return _applied(docs.join(small(by_doc), F.col("doc") == F.col("_doc"), "left"), ["_doc", "_gone"], gone)


def _dropped(docs: DataFrame, limit: int) -> DataFrame:
    """`docs` (doc, text and others) as `_applied` returns it."""
    spark, counted = docs.sparkSession, Observation()
    keys = _names(docs.select("doc", "text")).groupBy("a", "b").agg(F.min("doc").alias("doc"), F.max("last").alias("last"), F.sum("n").alias("n"))
    shared = stage(keys.observe(counted, F.count(F.lit(1)).alias("keys")).where("doc < last").drop("last"), "shared-lines")
    # Shards follow all distinct keys: those of one document aren't indexed, but they probe.
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counted.get["keys"] // SHARD_KEYS))
    index = stage(_built(shared, shards), "line-index")
    if shared.count() * KEY_BYTES <= limit:
        return _probed(docs, index, shards)
    return _shuffled(docs, index, shared.groupBy(_shard_of("a", shards).alias("shard")).agg(F.sum("n").alias("n")), shards)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")


def measure(docs: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for every row of `docs`. limit: bytes of arrays that may be broadcast."""
    held = _dropped(docs.select(_doc(), "text", F.col("doc_id").cast("long").alias("doc_id")), limit)
    return held.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` without the lines that an earlier document holds; a null text stays null. n_chars, if there, follows."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row_in")
    held = _dropped(docs.select(rest, _doc(), "text"), limit)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("row_in.n_chars")).cast(docs.schema["n_chars"].dataType)
    return unboxed(held, docs, **changed)
