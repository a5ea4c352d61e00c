"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint has eight bytes. Two fingerprints at RADIUS bits or fewer differ in at most RADIUS bytes, so they share at
least 8 - RADIUS = 5 positional bytes, and at least three of the first four or three of the last four. Postings are keyed
by such triples of positional bytes (eight for each distinct fingerprint). Within a posting list the shared positional
bytes of a pair are tallied; pairs with at least five are verified by their Hamming distance.

Copies share a fingerprint and are joined before the index. A posting list is cut into blocks; each task compares two
blocks of bounded size and returns a spanning forest of the links it found, never all pairs. Lists longer than
BLOCK postings are split by two further bytes first (ten keys, one of which a pair with five shared bytes has in common).

Nulls: a null text is an empty one; texts without a word have fingerprint zero and link like any other. A null doc_id gets a
row but doesn't name a component unless all its members are null. Repeated rows each get a row. Very long texts are hashed
whole, ties of a bit (half of the shingles) leave it zero, and an empty table gives no rows. `keep_one` passes other columns
through, `near_duplicates` ignores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.components import components
from volcohort.llm.storage import lookup, stage
from volcohort.llm.text import boxed, one_each, unboxed

SEED = 42
RADIUS = 3
BLOCK = 2048
#: Triples of byte positions; any five of eight positions hold one of them.
TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]


def fingerprint(text: str | None, k: int) -> int:
    """The 64-bit SimHash of the k-word shingles of a text, each counted as often as it occurs."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= k:
        names = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-k]]).tolist()
        names = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
    held = np.array(names, dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(held), 65536):
        part = held[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(held)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t.as_py(), k) for t in b.column("text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes two fingerprints share, from their exclusive or: its bytes that are zero."""
    return 8 - np.bitwise_count((((x & LOW) + LOW) | x) & ~LOW)


def _links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks (which may be the same): ends as indices into both, joined."""
    both = np.concatenate([left, right])
    n = len(left)
    root = np.arange(len(both))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a, b = [], []
    for i in range(n):
        x = right ^ left[i]
        at = np.flatnonzero(shared_bytes(x) >= 8 - radius)  # the count filter
        for j in at[np.bitwise_count(x[at]) <= radius]:  # the verification
            if left[i] != right[j] and (p := top(i)) != (q := top(n + int(j))):
                root[max(p, q)] = min(p, q)
                a.append(i)
                b.append(n + int(j))
    return both[a].astype(np.uint64), both[b].astype(np.uint64)


def _compare(keyed: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between fingerprints with an equal key. keyed: (key string, fp)."""
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(1 << 20)))
    sizes = salted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("long"))
    held = salted.join(sizes, "key").withColumn("part", F.col("salt") % F.col("parts"))
    # Each pair of parts meets in one group: a member goes to the groups of its part with every part.
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    held = held.select(
        F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("g"), "fp", (F.col("part") > F.col("other")).alias("second")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by group: a group is compared once its last row has come."""
        rest: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)]

        def compared(g, fp, second):
            cut = np.flatnonzero(np.diff(g)) + 1
            out = []
            for f, s in zip(np.split(fp, cut), np.split(second, cut), strict=True):
                if len(f) > 1:
                    x = (f, f) if not s.any() else (f[~s], f[s])
                    out.append(_links(*x, radius))
            a = np.concatenate([o[0] for o in out]) if out else np.empty(0, np.uint64)
            b = np.concatenate([o[1] for o in out]) if out else np.empty(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            new = [b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(zero_copy_only=False)]
            have = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if not len(have[0]):
                continue
            last = int(np.searchsorted(have[0], have[0][-1]))  # the group that may go on
            if last:
                yield compared(*(x[:last] for x in have))
            rest = [x[last:] for x in have]
        if len(rest[0]):
            yield compared(*rest)

    return held.repartition(F.col("g")).sortWithinPartitions("g").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that connect all those at `radius` bits or fewer."""
    byte = lambda i: F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))
    postings = distinct.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("t"), sum((F.shiftleft(byte(p), 8 * k) for k, p in enumerate(t)), F.lit(0).cast("long")).alias("v"))
            for n, t in enumerate(TRIPLES)
        ])).alias("x"),
    ).select("fp", F.concat_ws(":", F.col("x.t"), F.col("x.v")).alias("key"), F.col("x.t").alias("t"))
    long = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select(F.col("key").alias("long"))
    tagged = postings.join(long, F.col("key") == F.col("long"), "left")
    # The two further bytes of a key are taken from the five positions that the triple leaves.
    more = F.array(*[
        F.array(*[
            F.concat_ws(":", F.lit(f"{p}{q}"), byte(p), byte(q)) for p, q in combinations([i for i in range(8) if i not in t], 2)
        ]) for t in TRIPLES
    ])
    keys = F.when(F.col("long").isNull(), F.array("key")).otherwise(F.transform(F.get(more, F.col("t")), lambda m: F.concat_ws("/", F.col("key"), m)))
    return _compare(tagged.select("fp", F.explode(keys).alias("key")), radius)


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`."""
    fps = stage(fingerprints(docs, k), "simhash")
    groups = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-groups")
    found = links(groups.select("fp"), radius)
    # Components are named by their smallest doc_id, not by a fingerprint.
    named = components(stage(found, "simhash-links"))
    of = groups.join(named, groups["fp"] == named["node"], "left").select("fp", "first", "n", F.coalesce("component", "fp").alias("c"))
    least = of.groupBy("c").agg(F.min("first").alias("component_id"))
    of = stage(of.join(least, "c").select("fp", "n", "component_id"), "simhash-components")
    return lookup(fps, of, ["fp"], "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, k: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of the smallest doc_id of each component, with the columns it came with; a repeated row stays once."""
    named = stage(near_duplicates(docs, k, radius).where("doc_id <=> component_id").select("doc_id"), "kept")
    keep = named.distinct().select(F.col("doc_id").alias("_keep"))
    kept = boxed(docs, "doc_id").join(keep, F.col("doc_id").eqNullSafe(F.col("_keep")))
    return unboxed(one_each(kept, "doc_id", named), docs)
