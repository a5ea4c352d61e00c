"""Suffix-array dedup of bytes by prefix doubling, distributed.

A rank names the bytes from a position on: positions of equal ranks have equal bytes as far as the rank reaches. Ranks start as
the eight bytes themselves and double by pairing the rank at a position with that at an offset. In each round Spark brings
the (rank, document, position) rows of equal ranks together, sorted; positions whose rank occurs in one document only are
dropped, and what is left goes to the next, longer rank:

1. 20 bytes, a filter that a sparse set of positions is enough for: of the 31 positions of a 50-byte string at which 20 of
   its bytes start, the one of least scrambled rank stands for it (equal strings choose the same), so a string whose
   chosen position is unique can't repeat. About one position in 16 is shuffled; nothing is covered by this round;
2. 32 bytes, ranks 16 at offsets 0 and 16: every position that is left;
3. 50 bytes (the threshold), ranks 32 at offsets 0 and 18, with a check of 16 bits over the bytes: every position that is left.
   All but those of the smallest doc_id of a rank are covered.

A rank is a 64-bit name of the ranks it is made of, which all documents compute alike; a textbook renumbers the sorted
pairs and sends the numbers back, which would shuffle every position once more in each round. Texts that equal the text of a
smaller doc_id are covered as a whole before the first round: each of their strings starts there too.

Nulls: a null text is an empty one; a null doc_id counts as the smallest. Texts under 50 bytes lose nothing, empty tables give
no rows. Rows that share a doc_id are one document: they don't cover each other, and what is covered in one is removed from
each. Very long texts are ranked as a whole. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm import repeats
from volcohort.llm.repeats import NO_ID, Columns, columns, mix, pair
from volcohort.llm.storage import lookup, small, stage

LENGTH = 50
FIRST = 20
#: Positions of rank FIRST within LENGTH bytes.
WINDOW = LENGTH - FIRST + 1
CHECK = np.uint64(0xFFFF)
#: Odd multipliers of the eight-byte words of a check, by rule.
WEIGHTS = mix(np.arange(1, 8, dtype=np.uint64)) | np.uint64(1)
#: Positions in one piece of the rows that a task hands on.
PIECE = 1 << 18


def _ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of 8 bytes, the bytes themselves, and of 16 bytes from each position that has as many."""
    r = data.astype(np.uint64)
    for have in (1, 2, 4):
        r = r[:-have] | (r[have:] << np.uint64(8 * have))
    return r, pair(r[:-8], r[8:])


def _positions(starts: np.ndarray, n: int, ranges: list) -> tuple[np.ndarray, np.ndarray]:
    """The asked positions with LENGTH bytes of one document after them, and the document of each."""
    valid = np.ones(n - LENGTH + 1, bool)
    for end in starts[1:].tolist():
        valid[max(0, end - LENGTH + 1) : end] = False
    p = np.flatnonzero(valid)
    p = p[repeats.chosen(p, starts, ranges)]
    return p, np.searchsorted(starts, p, "right") - 1


def rank_20(docs: list, asked: list) -> Iterator[Columns]:
    """The position that stands for each stretch of neighbouring strings, by its rank of 20 bytes."""
    for data, starts, ids, ranges in repeats.chunks(docs, asked):
        n = len(data)
        if n < LENGTH:
            continue
        _, r16 = _ranks(data)
        r20 = pair(r16[: -(FIRST - 16)], r16[FIRST - 16 :], 20)
        place = np.uint64((1 << n.bit_length()) - 1)
        m = (mix(r20) & ~place) | np.arange(len(r20), dtype=np.uint64)
        for have in (1, 2, 4, 8):
            m = np.minimum(m[:-have], m[have:])
        m = np.minimum(m[: -(WINDOW - 16)], m[WINDOW - 16 :])
        p, doc = _positions(starts, n, ranges)
        at = (m[p] & place).astype(np.int64)
        first, end = repeats.groups(p, doc, at, at - p, WINDOW)
        p, last, d = p[first], p[end], doc[first]
        yield columns(name=r20[at[first]], ctx=np.zeros(len(p)), doc=ids[d], at=p - starts[d], more=last - p)


def _each(docs: list, asked: list, final: bool) -> Iterator[Columns]:
    """All asked positions by their rank of 32 bytes, or of LENGTH with the check if final."""
    for data, starts, ids, ranges in repeats.chunks(docs, asked):
        if len(data) < LENGTH:
            continue
        r8, r16 = _ranks(data)
        every, of = _positions(starts, len(data), ranges)
        for i in range(0, len(every), PIECE):
            p, doc = every[i : i + PIECE], of[i : i + PIECE]
            name = pair(r16[p], r16[p + 16], 32)
            check = np.zeros(len(p), np.uint64)
            if final:
                name = pair(name, pair(r16[p + 18], r16[p + 34], 32), LENGTH)
                for w, at in zip(WEIGHTS, (0, 8, 16, 24, 32, 40, LENGTH - 8), strict=True):
                    check += r8[p + at] * w
                check = (mix(check) >> np.uint64(20)) & CHECK
            yield columns(name=name, ctx=check, doc=ids[doc], at=p - starts[doc], more=np.zeros(len(p)))


def rank_32(docs: list, asked: list) -> Iterator[Columns]:
    yield from _each(docs, asked, False)


def rank_50(docs: list, asked: list) -> Iterator[Columns]:
    yield from _each(docs, asked, True)


ROUNDS = [(rank_20, False), (rank_32, False), (rank_50, True)]


def _cut(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with `_copy`, whether the text is that of a smaller doc_id, and `_spans`, the covered windows."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    groups = docs.select(doc.alias("doc"), digest.alias("digest")).groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    groups = stage(groups.where("first < last").drop("last"), "suffix-copies")
    held = lookup(docs.select("doc_id", "text", doc.alias("doc"), digest.alias("digest")), groups, ["digest"], "n")
    held = held.select("doc_id", "text", "doc", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)).alias("_copy"))
    # A generator between: the digest isn't computed again in a filter.
    held = held.withColumn("_copy", F.explode(F.array("_copy")))
    spans = repeats.repeated(held.where("not _copy").select("doc", "text"), ROUNDS, True)
    return held.join(small(spans), F.col("doc") == F.col("_doc"), "left")


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of `docs`."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, copy, packed in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_copy", "_spans")), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = repeats.spans_of(packed, LENGTH).clip(max=len(data))
                if copy:
                    spans = np.array([[0, len(data)]] if len(data) >= LENGTH else [], np.int64).reshape(-1, 2)
                kept = hashlib.sha256()
                at = 0
                for start, end in spans.tolist():
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                rows.append((i, len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _cut(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long"), "text", "_copy", "_spans").mapInArrow(run, schema)
