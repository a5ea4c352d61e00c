"""SimHash near-duplicates with verified similarity: one shared-shingle link law on top of the byte-position index.

Texts are near-duplicates at a Jaccard similarity of THRESHOLD or more of their sets of five-word shingles (lower-cased A-Z;
a text of fewer words is one shingle). Candidates come from SimHashes of BITS bits, wider than the 64 of `simhash`, as at this
similarity about a tenth of the bits differ:

1. Copies are joined by a digest of their words. Each other text has 16 positional bytes. Any MATCHES of them hold two of
   the first eight or two of the last eight, so postings are keyed by such pairs of positional bytes (56 for each text).
2. In a posting list the pairs that share MATCHES positional bytes and differ in RADIUS bits at most are candidates. A list
   of up to SMALL texts hands on all of them; a longer one a minimum spanning forest by distance, so a group of copies never
   brings all its pairs: these links are those that single linkage would use, and a text has a chance in every list that
   it is in. Lists are cut into blocks, so a task never holds more than two of them.
3. The links are verified on the shingles, and components are taken of those that hold.
4. What these miss comes from an index that misses nothing. All shingles have one order, those of few texts first by a table of
   counts of bounded size (it decides the work, never the result). Two sets of THRESHOLD share a shingle among the first fifth of
   both, so postings are keyed by these. In each list all pairs of different components whose sizes and places allow THRESHOLD
   are verified as well, and components are taken of all links.

Nulls: a null text is an empty one; texts without words are copies of each other. Repeated rows are copies. Rows with a null
doc_id can't be told apart: `keep_one` keeps them all if a group has no other doc_id, else none. Very long texts are compared
whole; an empty table gives no rows. Other columns pass through `keep_one`.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.components import components
from volcohort.llm.repeats import mix
from volcohort.llm.simhash import SEED
from volcohort.llm.storage import lookup, small, stage
from volcohort.llm.text import boxed, one_each, unboxed

SHINGLE = 5
THRESHOLD = 0.8
#: Words of the shingles behind a fingerprint; shorter ones move less under an edit.
FINGERPRINT_WORDS = 3
RADIUS = 30
MATCHES = 3
BLOCK = 2048
SMALL = 32
#: Bits of the table that counts shingles, and cells in a piece of it.
COUNTED = 20
PIECE = 1 << 16
#: Pairs in a batch of rows.
MANY = 1 << 20
PAIRS = [c for half in (range(8), range(8, 16)) for c in combinations(half, 2)]


def _names(words: list[bytes], k: int) -> np.ndarray:
    """64-bit names of the k-word shingles of a text with words; a shorter text is one shingle."""
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-k]]).tolist()
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)], np.uint64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _majority(names: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(names), 65536):
        counts += np.unpackbits(names[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(names)).tobytes(), "big")


def _fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, d1, d2, f0, f1): a digest of the words and the two halves of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros((b.num_rows, 4), np.uint64)
            for i, t in enumerate(b.column("text")):
                w = _words(t.as_py())
                joined = b" ".join(w)
                out[i, :2] = xxhash.xxh64_intdigest(joined, 1), xxhash.xxh64_intdigest(joined, 2)
                if w:
                    names = _names(w, FINGERPRINT_WORDS)
                    out[i, 2:] = _majority(names), _majority(mix(names))
            cols = [pa.array(np.ascontiguousarray(out[:, c]).view(np.int64)) for c in range(4)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", "d1", "d2", "f0", "f1"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, d1 long, d2 long, f0 long, f1 long")


def _near(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of two halves; RADIUS + 1 for pairs that aren't candidates."""
    x = p ^ q
    far = np.bitwise_count(x).sum(axis=-1, dtype=np.int64)
    near = far <= RADIUS
    at = np.flatnonzero(near)
    shared = (np.ascontiguousarray(x[at]).view(np.uint8).reshape(len(at), 16) == 0).sum(axis=1)
    far[at[shared < MATCHES]] = RADIUS + 1
    far[~near] = RADIUS + 1
    return far


def _forest(fp: np.ndarray) -> list[tuple[int, int]]:
    """A minimum spanning forest of the candidates among the rows: one row after the other joins at its least distance."""
    n = len(fp)
    best, link, free = np.full(n, RADIUS + 1), np.full(n, -1), np.ones(n, bool)
    out, at = [], 0
    for _ in range(n):
        free[at] = False
        left = np.flatnonzero(free)
        if not len(left):
            break
        far = _near(fp[left], fp[at])
        closer = left[far < best[left]]
        best[closer], link[closer] = far[far < best[left]], at
        nxt = int(left[np.argmin(best[left])])
        if best[nxt] <= RADIUS:
            out.append((int(link[nxt]), nxt))
        at = nxt
    return out


def _lists(g: np.ndarray, doc: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of all lists (rows with one g, which are neighbours)."""
    n = len(g)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [n]])
    sizes = np.diff(cuts)
    of = np.repeat(np.arange(len(sizes)), sizes)
    active = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    rows = np.flatnonzero(np.isin(of, active))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for d in range(1, SMALL):  # neighbours at distance d, of all short lists at once
        rows = rows[rows + d < n]
        rows = rows[of[rows] == of[rows + d]]
        if not len(rows):
            break
        near = rows[_near(fp[rows], fp[rows + d]) <= RADIUS]
        a.append(near)
        b.append(near + d)
    for x in np.flatnonzero(sizes > SMALL).tolist():
        s = int(cuts[x])
        found = np.array(_forest(fp[s : int(cuts[x + 1])]), np.int64).reshape(-1, 2) + s
        a.append(found[:, 0])
        b.append(found[:, 1])
    return doc[np.concatenate(a)], doc[np.concatenate(b)]


def _candidates(texts: DataFrame) -> DataFrame:
    """(a, b): distinct links between texts (doc_id, f0, f1)."""
    byte = lambda i: F.shiftrightunsigned("f0" if i < 8 else "f1", 8 * (i % 8)).bitwiseAND(F.lit(255))
    keys = [F.lit(n << 16).cast("long") + F.shiftleft(byte(p), 8) + byte(q) for n, (p, q) in enumerate(PAIRS)]
    keyed = texts.select("doc_id", "f0", "f1", F.explode(F.array(*keys)).alias("key"))
    long = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    long = small(stage(long.select(F.col("key").alias("_long"), F.ceil(F.col("n") / BLOCK).cast("long").alias("parts")), "long-lists"))
    held = keyed.join(long, F.col("key") == F.col("_long"), "left")
    # A long list is cut into parts; each pair of parts meets in one group.
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    other = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    held = held.select("doc_id", "f0", "f1", "key", F.coalesce(part, F.lit(0)).alias("part"), F.explode(other).alias("other"))
    held = held.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("g"), "doc_id", "f0", "f1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.uint64)]
        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(4)]
            new = [cols[0], cols[1], np.stack([cols[2], cols[3]], axis=1).view(np.uint64)]
            have = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if not len(have[0]):
                continue
            last = int(np.flatnonzero(have[0] == have[0][-1])[0])  # the list that may go on
            if last:
                x, y = _lists(*(h[:last] for h in have))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
            rest = [h[last:] for h in have]
        if len(rest[0]):
            x, y = _lists(*rest)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    found = held.repartition(F.col("g")).sortWithinPartitions("g", "doc_id").mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _shingled(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [np.unique(_names(_words(t.as_py()), SHINGLE)).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(held, pa.binary())], names=["doc_id", "names"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, names binary")


def _levels(docs: DataFrame) -> np.ndarray:
    """A step for each cell of the table of counts: quarters of a doubling of the shingles that texts have in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << COUNTED, np.uint32)
        for b in batches:
            for t in b.column("text"):
                np.add.at(cells, (np.unique(_names(_words(t.as_py()), SHINGLE)) >> np.uint64(64 - COUNTED)).astype(np.int64), 1)
        pieces = [p for p in range(len(cells) // PIECE) if cells[p * PIECE : (p + 1) * PIECE].any()]
        held = pa.array([cells[p * PIECE : (p + 1) * PIECE].tobytes() for p in pieces], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), held], names=["piece", "cells"])

    def add(found: pa.Table) -> pa.Table:
        total = np.zeros(PIECE, np.int64)
        for x in found.column("cells"):
            total += np.frombuffer(x.as_py(), np.uint32)
        steps = (4 * np.log2(1 + total)).astype(np.uint8)
        return pa.table({"piece": found.column("piece").slice(0, 1), "steps": pa.array([steps.tobytes()], pa.binary())})

    out = np.zeros(1 << COUNTED, np.uint8)
    for r in docs.select("text").mapInArrow(count, "piece int, cells binary").groupBy("piece").applyInArrow(add, "piece int, steps binary").collect():
        out[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["steps"], np.uint8)
    return out


def _prefixes(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(doc_id, size, first): how many shingles a text has, and those of which any similar text shares one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, first = [], []
            for t in b.column("text"):
                names = np.unique(_names(_words(t.as_py()), SHINGLE))
                n = len(names)
                order = np.argsort(levels[(names >> np.uint64(64 - COUNTED)).astype(np.int64)], kind="stable")
                sizes.append(n)
                first.append(names[order[: n - math.ceil(THRESHOLD * n - 1e-9) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.list_(pa.int64()))], names=["doc_id", "size", "first"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, size long, first array<long>")


def _across(g: np.ndarray, doc: np.ndarray, comp: np.ndarray, size: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of different components in all lists (rows with one g, by size) that may be similar."""
    rows, held, have = np.arange(len(g)), [], 0
    for d in range(1, len(g)):
        rows = rows[rows + d < len(g)]
        far = rows + d
        rows = rows[(g[rows] == g[far]) & (THRESHOLD * size[far] <= size[rows] + 1e-6)]
        if not len(rows):
            break
        far = rows + d
        most = np.minimum(size[rows] - at[rows], size[far] - at[far])  # in the list of their first common shingle
        maybe = (comp[rows] != comp[far]) & ((1 + THRESHOLD) * most >= THRESHOLD * (size[rows] + size[far]) - 1e-6)
        held.append((doc[rows[maybe]], doc[far[maybe]]))
        have += int(maybe.sum())
        if have > MANY:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, have = [], 0
    if have:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _missed(prefixes: DataFrame, heads: DataFrame) -> DataFrame:
    """(a, b): distinct pairs of texts of different components that share a first shingle and may be similar.

    prefixes: as `_prefixes`; heads: (doc_id, comp) of the texts.
    """
    texts = prefixes.join(heads, "doc_id").select("doc_id", "comp", "size", "first")
    texts = stage(texts, "first-shingles")
    keyed = texts.select("doc_id", "comp", "size", F.posexplode("first").alias("at", "key"))
    lists = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    lists = small(stage(lists.select(F.col("key").alias("_key"), F.ceil(F.col("n") / BLOCK).cast("long").alias("parts")), "first-lists"))
    held = keyed.join(lists, F.col("key") == F.col("_key"))
    # A long list is cut into parts; each pair of parts meets in one group.
    part, other = F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    held = held.select("doc_id", "comp", "size", F.col("at").cast("long").alias("at"), "key", part.alias("part"), F.explode(other).alias("other"))
    held = held.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("g"), "doc_id", "comp", "size", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 5
        for b in itertools.chain(batches, [None]):
            have = rest if b is None else [np.concatenate([x, b.column(i).to_numpy()]) for i, x in enumerate(rest)]
            if not len(have[0]):
                continue
            last = len(have[0]) if b is None else int(np.flatnonzero(have[0] == have[0][-1])[0])  # the list that may go on
            for x, y in _across(*(h[:last] for h in have)):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
            rest = [h[last:] for h in have]

    found = held.repartition(F.col("g")).sortWithinPartitions("g", "size").mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose shingles reach THRESHOLD."""
    x = shingled.select(F.col("doc_id").alias("a"), F.col("names").alias("x"))
    y = shingled.select(F.col("doc_id").alias("b"), F.col("names").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= THRESHOLD * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b) of the staged pairs that hold on the shingles, staged."""
    nodes = stage(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "wide-nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small(nodes), F.col("doc_id") == F.col("_id")).select("doc_id", "text")
    shingled = stage(_shingled(texts).dropDuplicates(["doc_id"]), "wide-shingles")
    return stage(_verified(pairs, shingled), "wide-verified")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row of `docs`: the smallest doc_id that verified links reach."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4000)
    fps = stage(_fingerprints(docs), "wide-simhash")
    least = F.min("doc_id")
    groups = stage(fps.groupBy("d1", "d2").agg(least.alias("doc_id"), F.first("f0").alias("f0"), F.first("f1").alias("f1"), F.count(F.lit(1)).alias("n")), "wide-texts")
    texts = groups.where("doc_id is not null")
    links = _links(docs, stage(_candidates(texts.select("doc_id", "f0", "f1")), "wide-links"))
    named = components(links).select(F.col("node").alias("_node"), "component")
    heads = texts.join(named, F.col("doc_id") == F.col("_node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("comp"))
    prefixes = stage(_prefixes(docs, _levels(docs)), "wide-prefixes")
    named = components(links.union(_links(docs, stage(_missed(prefixes, heads), "first-links"))))
    of = groups.join(named, groups["doc_id"] == named["node"], "left")
    of = stage(of.select("d1", "d2", "n", F.coalesce("component", "doc_id").alias("component_id")), "wide-components")
    return lookup(fps, of, ["d1", "d2"], "n").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of the smallest doc_id of each component, with the columns it came with; a repeated row stays once."""
    named = near_duplicates(docs).where("doc_id <=> component_id").select("doc_id")
    named = stage(named, "kept")
    keep = named.distinct().select(F.col("doc_id").alias("_keep"))
    kept = boxed(docs, "doc_id").join(small(stage(keep, "kept")), F.col("doc_id").eqNullSafe(F.col("_keep")))
    return unboxed(one_each(kept, "doc_id", named), docs)
