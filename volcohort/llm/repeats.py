"""Exact repeats of fixed length across documents, in rounds of Spark: shared by the byte and the word operator.

A document is a row of symbols; a window is L symbols from a start. A round gives each window that is still open a name that
equal windows share, and hands Spark one row for each stretch of neighbouring windows with one name: (name, check, document,
first window, further windows). Spark brings equal names together. There are two kinds of rounds:

* a *filter* drops the windows whose name occurs in one place only: they can't repeat. It covers nothing by itself;
* a *decision* compares names and checks (80 bits at least in all): all but the first of equal stretches are covered. Stretches
  of one name but several checks stay open for the next round, which takes shorter ones, down to single windows.

What is left open returns to the documents as ranges of windows. Copies within a batch are settled before the shuffle, so a
hot name brings at most one row from each batch. Rows travel in blocks of columns, several thousand to a block, to keep the
shuffle a small multiple of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import arrow_rows, drop, release, small, stage

RUN, COVERED, OPEN = 0, 1, 2
BLOCK = "bucket int, kind int, name binary, ctx binary, doc binary, at binary, more binary"
TYPES = {"name": np.uint64, "ctx": np.uint64, "doc": np.int64, "at": np.uint32, "more": np.uint32}
#: Bytes of text that are worked on at once.
CHUNK = 1 << 18
#: Documents in an Arrow batch.
ARROW_ROWS = 2000
#: Stretches of windows that a task holds before it hands them on.
FLUSH = 1 << 19
#: Bytes of text for each bucket: what a task holds at once doesn't grow with the input.
BUCKET_BYTES = 4 << 20
NO_ID = -(1 << 63)
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

Columns = dict[str, np.ndarray]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """The name of a pair of names."""
    return mix(a * M1 + b * M3 + np.uint64(salt))


def columns(**k: np.ndarray) -> Columns:
    return {n: np.asarray(k[n], dtype=t) for n, t in TYPES.items()}


def joined(parts: list[Columns]) -> Columns:
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.empty(0, t) for n, t in TYPES.items()}


def _tight(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs; the first byte tells how many."""
    size = next(n for n in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * n)
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def _loose(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1)


def _blocks(kind: int, bucket: np.ndarray, c: Columns) -> pa.RecordBatch:
    """A row of columns for each bucket; documents ascend within it, so they are kept as differences."""
    order = np.argsort(bucket, kind="stable")
    bucket, c = bucket[order], {n: x[order] for n, x in c.items()}
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist()
    spans = list(zip(cuts[:-1], cuts[1:], strict=True)) if len(bucket) else []
    held = {
        "name": [c["name"][a:b].tobytes() if kind == RUN else b"" for a, b in spans],
        "ctx": [_tight(c["ctx"][a:b]) if kind == RUN else b"" for a, b in spans],
        "doc": [c["doc"][a : a + 1].tobytes() + _tight(np.diff(c["doc"][a:b]).view(np.uint64)) for a, b in spans],
        "at": [_tight(c["at"][a:b]) for a, b in spans],
        "more": [_tight(c["more"][a:b]) for a, b in spans],
    }
    heads = [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()), pa.array([kind] * len(spans), pa.int32())]
    return pa.RecordBatch.from_arrays([*heads, *(pa.array(x, pa.binary()) for x in held.values())], names=["bucket", "kind", *held])


def _unblocked(rows: list[dict]) -> Columns:
    parts = []
    for r in rows:
        at = _loose(r["at"])
        none = np.zeros(len(at), np.uint64)
        name, ctx = (np.frombuffer(r["name"], np.uint64), _loose(r["ctx"])) if r["kind"] == RUN else (none, none)
        doc = np.cumsum(np.concatenate([np.frombuffer(r["doc"][:8], np.int64), _loose(r["doc"][8:]).astype(np.uint64).view(np.int64)]))
        parts.append(columns(name=name, ctx=ctx, doc=doc, at=at, more=_loose(r["more"])))
    return joined(parts)


def _merged(doc: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges [at, end] in the order of (doc, at), those that touch joined."""
    order = np.lexsort((at, doc))
    doc, at, end = doc[order], at[order].astype(np.int64), end[order].astype(np.int64)
    if not len(doc):
        return doc, at, end
    # The furthest end so far in each document, by ranks that rise from one document to the next.
    group = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    step = int(end.max()) + 2
    far = np.maximum.accumulate(end + group * step) - group * step
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] > far[:-1] + 1)])
    last = np.concatenate([first[1:], [True]])
    return doc[first], at[first], far[last]


def settle(c: Columns, across: bool, decide: bool) -> tuple[np.ndarray, np.ndarray]:
    """(covered, open) masks over runs. across: only runs of other documents cover a run; decide: whether any may be covered."""
    if across:  # the least document of a class is looked up, so rows needn't be in the order of their places
        order = np.lexsort((c["ctx"], c["name"])) if decide else np.argsort(c["name"])
    else:
        order = np.lexsort((c["at"], c["doc"], c["ctx"], c["name"]) if decide else (c["at"], c["doc"], c["name"]))
    name, doc, at = c["name"][order], c["doc"][order], c["at"][order]
    n = len(order)
    covered, open_ = np.zeros(n, bool), np.zeros(n, bool)
    if not n:
        return covered, open_
    new_name = np.concatenate([[True], name[1:] != name[:-1]])
    of = np.cumsum(new_name) - 1
    starts = np.flatnonzero(new_name)
    other = lambda first: (doc != doc[first]) | (at != at[first])  # noqa: E731  # a repeated row doesn't cover itself
    if not decide:  # a name in several documents, or in several places
        far = np.maximum.reduceat(doc, starts) > np.minimum.reduceat(doc, starts) if across else np.logical_or.reduceat(other(starts[of]), starts)
        open_[order] = far[of]
        return covered, open_
    ctx = c["ctx"][order]
    new = new_name | np.concatenate([[True], ctx[1:] != ctx[:-1]])
    firsts, nth = np.flatnonzero(new), np.cumsum(new) - 1
    hit = doc > np.minimum.reduceat(doc, firsts)[nth] if across else other(firsts[nth])  # not of the first document, or row, of the class
    several = np.bincount(of, weights=new)[of] > 1
    if across:  # and in several documents
        several &= (np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts))[of]
    covered[order], open_[order] = hit, several & ~hit
    return covered, open_


def _ranges(kind: int, c: Columns, mask: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The marked runs as ranges of windows, by document."""
    if mask.any():
        doc, at, end = _merged(c["doc"][mask], c["at"][mask], c["at"][mask] + c["more"][mask])
        none = np.zeros(len(doc), np.uint64)
        yield _blocks(kind, (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), columns(name=none, ctx=none, doc=doc, at=at, more=end - at))


def _local(c: Columns, across: bool, decide: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a batch: what it settles by itself, and one run of each name (and check) for the other batches."""
    if not len(c["name"]):
        return
    hit, several = settle(c, across, decide)
    if decide:
        yield from _ranges(COVERED, c, hit, buckets)
        rest = {n: x[~hit] for n, x in c.items()}
    else:
        yield from _ranges(OPEN, c, several, buckets)
        names, first = np.unique(c["name"][several], return_index=True)
        keep = ~several
        keep[np.flatnonzero(several)[first]] = True
        rest = {n: x[keep] for n, x in c.items()}
    order = np.lexsort((rest["at"], rest["doc"]))
    rest = {n: x[order] for n, x in rest.items()}
    yield _blocks(RUN, (mix(rest["name"]) % np.uint64(buckets)).astype(np.int64), rest)


def exchange(blocks: DataFrame, work: Callable[[dict[int, Columns]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring the blocks of each bucket together and apply `work` to its rows by kind."""

    def done(held: list[dict]) -> Iterator[pa.RecordBatch]:
        return work({kind: _unblocked([r for r in held if r["kind"] == kind]) for kind in (RUN, COVERED, OPEN)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != at:
                    if held:
                        yield from done(held)
                    at, held = row["bucket"], []
                held.append(row)
        if held:
            yield from done(held)

    return blocks.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(run, schema)


#: emit((id, bytes) of documents, open ranges or None for each): the runs of their windows, or of those in the ranges.
Emit = Callable[[list, list], Iterator[Columns]]


def _emitted(docs: DataFrame, emit: Emit, across: bool, decide: bool, buckets: int) -> DataFrame:
    """Blocks of the runs of `docs` (doc, text and, if only those are asked for, open ranges)."""
    ranges = "open" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("doc").to_pylist()
            asked = [None] * len(ids) if not ranges else [np.frombuffer(x, np.uint32).reshape(-1, 2) for x in b.column("open").to_pylist()]
            data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            held, have = [], 0
            for part in emit(list(zip(ids, data, strict=True)), asked):
                held.append(part)
                have += len(part["name"])
                if have > FLUSH:
                    yield from _local(joined(held), across, decide, buckets)
                    held, have = [], 0
            yield from _local(joined(held), across, decide, buckets)

    return docs.mapInArrow(run, BLOCK)


def _by_doc(blocks: DataFrame, across: bool, decide: bool, buckets: int, keep_open: bool) -> DataFrame:
    """(doc, covered, open): the window ranges of each document as pairs of 32-bit numbers."""

    def first(by: dict[int, Columns]) -> Iterator[pa.RecordBatch]:
        hit, more = settle(by[RUN], across, decide)
        for kind, mask in ((COVERED, hit), (OPEN, more & keep_open)):
            yield from _ranges(kind, by[RUN], mask, buckets)
            yield from _ranges(kind, by[kind], np.ones(len(by[kind]["doc"]), bool), buckets)

    def second(by: dict[int, Columns]) -> Iterator[pa.RecordBatch]:
        ids = np.unique(np.concatenate([by[OPEN]["doc"], by[COVERED]["doc"]]))
        found = []
        for c in (by[COVERED], by[OPEN]):
            doc, at, end = _merged(c["doc"], c["at"], c["at"] + c["more"])
            flat = np.stack([at, end], axis=1).astype(np.uint32)
            low, high = np.searchsorted(doc, ids, "left").tolist(), np.searchsorted(doc, ids, "right").tolist()
            found.append(pa.array([flat[a:b].tobytes() for a, b in zip(low, high, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(ids), *found], names=["doc", "covered", "open"])

    return exchange(exchange(blocks, first, BLOCK), second, "doc long, covered binary, open binary")


def repeated(docs: DataFrame, rounds: list[tuple[Emit, bool]], across: bool) -> DataFrame:
    """(_doc, _spans): for each document with covered windows, their ranges [first, last] as pairs of 32-bit numbers.

    docs: (doc, text). rounds: how each names the open windows, and whether it decides; the last one decides single windows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, size // BUCKET_BYTES)
    asked, before, covered = docs, None, []
    with arrow_rows(spark, ARROW_ROWS):
        for i, (emit, decide) in enumerate(rounds):
            last = i == len(rounds) - 1
            runs = stage(_by_doc(_emitted(asked, emit, across, decide, buckets), across, decide, buckets, not last), "repeat-runs")
            if before is not None:
                drop(before)
            if decide:
                covered.append(runs.where(F.octet_length("covered") > 0).select(F.col("doc").alias("_doc"), "covered"))
            if not last:
                before = stage(runs.where(F.octet_length("open") > 0).select(F.col("doc").alias("_doc"), "open"), "repeat-open")
                asked = docs.join(small(before), F.col("doc") == F.col("_doc")).select("doc", "text", "open")
                if not decide:
                    drop(runs)
            release(spark)
    every = covered[0]
    for more in covered[1:]:
        every = every.union(more)
    return stage(every.groupBy("_doc").agg(F.array_join(F.collect_list(F.hex("covered")), "").alias("_spans")), "repeat-spans")


def spans_of(packed: str | None, length: int) -> np.ndarray:
    """Merged ranges [start, end) of symbols that windows of `length` symbols cover."""
    if not packed:
        return np.empty((0, 2), np.int64)
    x = np.frombuffer(bytes.fromhex(packed), np.uint32).reshape(-1, 2).astype(np.int64)
    _, at, end = _merged(np.zeros(len(x), np.int64), x[:, 0], x[:, 1] + length - 1)
    return np.stack([at, end + 1], axis=1)


def chunks(docs: list, asked: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Documents in groups of about CHUNK bytes: (all bytes, start of each document, id of each, ranges of each)."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0], i))
    at = 0
    while at < len(order):
        size, to = 0, at
        while to < len(order) and (to == at or size + len(docs[order[to]][1]) <= CHUNK):
            size += len(docs[order[to]][1])
            to += 1
        part = [docs[i] for i in order[at:to]]
        starts = np.concatenate([[0], np.cumsum([len(x[1]) for x in part])])
        yield np.frombuffer(b"".join(x[1] for x in part), np.uint8), starts, np.array([x[0] for x in part], np.int64), [asked[i] for i in order[at:to]]
        at = to


def chosen(p: np.ndarray, began: np.ndarray, ranges: list) -> np.ndarray:
    """A mask of the windows p that lie in the ranges of their document; documents begin at `began`."""
    if ranges[0] is None:
        return np.ones(len(p), bool)
    most = int(p[-1]) + 2 if len(p) else 1
    edge = np.zeros(most + 1, np.int64)
    for i, x in enumerate(ranges):
        if len(x):
            np.add.at(edge, np.minimum(x[:, 0].astype(np.int64) + began[i], most), 1)
            np.add.at(edge, np.minimum(x[:, 1].astype(np.int64) + began[i] + 1, most), -1)
    return np.cumsum(edge)[p] > 0


def groups(p: np.ndarray, doc: np.ndarray, anchor: np.ndarray, back: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the groups of neighbouring windows p of one document, one anchor and one stretch of `width`
    windows, counted by the distance `back` from the anchor."""
    if not len(p):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    part = back // width
    change = (p[1:] != p[:-1] + 1) | (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(np.concatenate([[True], change]))
    return first, np.append(first[1:] - 1, len(p) - 1)
