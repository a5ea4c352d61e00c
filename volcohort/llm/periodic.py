"""Periodic runs of words by a harmonic grid.

A run is a stretch of consecutive words with smallest period q, at least LEAST words and two periods long, that no neighbouring
word extends. For each period p the places p, 2p, 3p, ... of a text form a grid; any run of period p holds two neighbours of it.
How far the words from jp and from (j+1)p on agree, and how far those before them do, are two LCE queries: minima, over a range
of ranks, of the LCP array of the words and of the reversed words. Both arrays are suffix arrays made by prefix doubling, with
sparse tables for the minima. Where both stretches are long enough they make a run; a run found at several multiples of its
period is kept at the smallest.

Most pairs of a grid differ within a few words. Those whose stretch ends within NEAR words on either side and is too short are
dropped before the arrays are built, and texts without any pair left need no arrays; what is dropped can't be a run, so nothing
is lost. Texts are worked on in groups of about CHUNK words, like lengths together; arrays take some 200 bytes a word.

Nulls: a null text has no words and no run; a null doc_id gets its row. Repeated rows each get a row. Ties: the run of greatest
length that starts first, then of smallest period, is the longest. Very long texts are worked on whole, one at a time. An empty
table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.text import keyed_crc, text_of, words

LEAST = 12
#: Words that are worked on at once, if more than one text.
CHUNK = 1 << 18
#: Words on either side that are compared before the arrays are asked.
NEAR = 8
RUN = "struct<start: bigint, length: bigint, period: bigint>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Lce:
    """How many words agree from two places on: suffix array, LCP array and a sparse table of its minima. No word agrees with the
    last one, and places asked for differ."""

    def __init__(self, x: np.ndarray) -> None:
        n = len(x)
        levels = [np.unique(x, return_inverse=True)[1].astype(np.int32)]  # ranks of the prefixes of 1, 2, 4, ... words
        order = np.argsort(levels[0], kind="stable")
        while int(levels[-1][order[-1]]) < n - 1:
            rank, k = levels[-1], 1 << (len(levels) - 1)
            key = rank.astype(np.int64) * (n + 1)
            key[: n - k] += rank[k:] + 1
            order = np.argsort(key, kind="stable")
            key = key[order]
            after = np.empty(n, np.int32)
            after[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            levels.append(after)
        self.rank = levels.pop()
        a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int32)
        for t in range(len(levels) - 1, -1, -1):
            step = (levels[t][a] == levels[t][b]) * (1 << t)
            a += step
            b += step
            lcp[1:] += step.astype(np.int32)
        self.table = [lcp]  # minima of 1, 2, 4, ... neighbours
        while 2 << (len(self.table) - 1) <= n:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(i), np.int64)
        for t in np.unique(level).tolist():
            at = np.flatnonzero(level == t)
            out[at] = np.minimum(self.table[t][low[at]], self.table[t][high[at] - (1 << t) + 1])
        return out


def _grid(x: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all neighbours jp, (j+1)p of the grids whose words agree, for periods up to half the longest text."""
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for p in range(1, longest // 2 + 1):
        on = x[::p]
        hit = np.flatnonzero(on[1:] == on[:-1])
        if len(hit):
            places.append(hit * p)
            periods.append(np.full(len(hit), p))
    return np.concatenate(places), np.concatenate(periods)


def _near(x: np.ndarray, i: np.ndarray, p: np.ndarray, least: int) -> np.ndarray:
    """A mask of the pairs that the NEAR words on either side don't rule out: their stretch goes on beyond, or is long enough."""
    count, beyond = np.zeros(len(i), np.int64), np.zeros(len(i), bool)
    for step in (1, -1):
        alive = np.arange(len(i))
        for k in range(NEAR):
            at = i[alive] + (k if step > 0 else -1 - k)
            fits = (at >= 0) & (at + p[alive] < len(x))
            alive, at = alive[fits], at[fits]
            alive = alive[x[at] == x[at + p[alive]]]
            count[alive] += 1
        beyond[alive] = True
    return beyond | (count >= np.maximum(least - p, p))


def runs_of(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text, a sequence of word numbers: rows of (start, length, period) by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = [np.empty((0, 3), np.int64) for _ in texts]
    if not sizes.sum():
        return out
    # A number of its own, found nowhere else, stands before the first text and after each.
    ends = lambda held: -1 - np.arange(len(held) + 1)
    put = lambda held: np.concatenate([[-1], *[y for t, e in zip(held, ends(held)[1:], strict=True) for y in (t, [e])]]).astype(np.int64)
    x, began = put(texts), 1 + np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    of = np.repeat(np.arange(len(texts)), sizes + 1)  # of place 1, 2, ...
    i, p = _grid(x, int(sizes.max()))
    same = of[np.maximum(i, 1) - 1] == of[i + p - 1]
    i, p = i[same], p[same]
    kept = _near(x, i, p, least)
    i, p = i[kept], p[kept]
    if not len(i):
        return out
    asked = np.unique(of[i - 1])
    sub = put([texts[d] for d in asked.tolist()])
    start = 1 + np.concatenate([[0], np.cumsum(sizes[asked] + 1)])[:-1]
    k = np.searchsorted(asked, of[i - 1])
    at, n = i - began[asked[k]] + start[k], len(sub)
    forward = Lce(sub).of(at, at + p)
    back = Lce(sub[::-1].copy()).of(n - at, n - at - p)  # of the words before
    low, size = at - back - start[k], back + p + forward
    good = size >= np.maximum(least, 2 * p)
    found = np.stack([k, low, size, p], axis=1)[good]
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    first = np.concatenate([[True], (found[1:, :3] != found[:-1, :3]).any(axis=1)]) if len(found) else np.empty(0, bool)
    found = found[first]
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    cuts = np.searchsorted(found[:, 0], np.arange(len(asked) + 1))
    for d, a, b in zip(asked.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        out[d] = found[a:b, 1:]
    return out


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """A mask of the words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def _groups(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of texts, like sizes together, in groups of about CHUNK words."""
    held, have = [], 0
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        if held and have + sizes[i] > CHUNK:
            yield held
            held, have = [], 0
        held.append(i)
        have += sizes[i]
    if held:
        yield held


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of `docs`: its runs by start, then period, and its words but for those that a run
    holds after its first period, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            texts = [(t or b"").split() for t in b.column("text").cast(pa.binary()).to_pylist()]
            for group in _groups([len(t) for t in texts]):
                number: dict[bytes, int] = {}
                coded = [np.array([number.setdefault(w, len(number)) for w in texts[i]], np.int64) for i in group]
                runs, collapsed = runs_of(coded, least), []
                for i, r in zip(group, runs, strict=True):
                    held = texts[i]
                    if len(r):
                        held = [w for w, k in zip(held, _kept(len(held), r).tolist(), strict=True) if k]
                    collapsed.append(b" ".join(held))
                    texts[i] = []
                flat = np.concatenate(runs)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN_TYPE.value_type)))
                columns = [ids.take(pa.array(group)), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, runs array<{RUN}>, collapsed string")


def summary(collapsed: DataFrame) -> DataFrame:
    """What `collapse` returned as numbers and digests: one row for each."""
    longest = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (a, r) -> if(a is null or r.length > a.length, r, a))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    told = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    out = collapsed.withColumn("longest", longest)  # runs come by start and period: the first of the greatest length
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"), F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where one document in ten, by the crc32 of its id, repeats a passage from some word on to its end."""
    held = docs.select("doc_id", text_of().alias("text"), keyed_crc().alias("h"))
    repeats = F.expr("transform(sequence(0, n - 1), i -> if(i < a, w[i], w[cast(a + (i - a) % p as int)]))")
    w = words(F.col("text"))
    held = held.withColumn("w", F.when(F.col("h") % 10 == 0, w)).withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    held = held.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    return held.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeats, " ")).otherwise(F.col("text")).alias("text"))
