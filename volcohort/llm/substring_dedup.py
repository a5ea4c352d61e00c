"""Substring dedup of words by recompression, in rounds of Spark.

A text is a sequence of symbols: its words at first. A round of recompression names runs of one symbol (before the first
pairs) and pairs of neighbouring symbols: a pair is joined if its first symbol falls in the left half of the alphabet and its
second in the right half, by a bit of their names in that round. A name is made of the names it joins, so all documents give
equal runs and pairs the same one. Inside two equal windows of LENGTH words the symbols are equal but for those at the edges
that a neighbour outside might join; the others are the window's interior symbols, one at least after ROUNDS rounds in
windows without runs. A window without any is named as a whole.

Of the interior symbols the one of least scrambled name stands for the window. After each round of recompression Spark brings
the symbols of all documents together by name: windows whose symbol occurs in one place only can't repeat and are dropped,
so each round works on what the one before left open. The symbols of the last round that are shared reveal the repeats; they
are verified on the words of whole stretches of windows, then of shorter ones and of single windows. Each word has two names of
64 bits, both scrambled from its bytes; one makes the names of stretches, the other the checks beside them.

Nulls: a null text has no words; a null doc_id counts as the smallest. Texts under 20 words lose nothing, empty tables give no
rows. Rows that share a doc_id are one document; a row that is repeated doesn't cover itself. Very long texts are compressed as
a whole. Other columns of the input pass through `strip_documents` and are ignored by `measure`.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm import repeats
from volcohort.llm.repeats import M1, M2, M3, NO_ID, Columns, columns, mix, pair
from volcohort.llm.storage import small
from volcohort.llm.text import boxed, unboxed

LENGTH = 20
ROUNDS = 3
#: Windows of a stretch in each step that verifies.
WIDTHS = (LENGTH, 5, 1)
BASE = 0xD6E8FEB86659FD93
BACK = pow(BASE, -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Masks of the first 0 to 8 bytes of a number.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LOG2 = np.array([0, 0, 1, 1, *[2] * 4, *[3] * 8, *[4] * 16])
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, repeats.CHUNK + 1)
        for key, base in (("up", BASE), ("down", BACK)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[key] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


class Names:
    """Names of ranges of a sequence of numbers, by differences of prefix sums."""

    def __init__(self, values: np.ndarray) -> None:
        up, self.down = powers(len(values) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of documents that begin at `starts`."""
    solid = ~SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first = solid & np.concatenate([[True], ~solid[:-1]]) | solid & edge[:-1]
    last = solid & np.concatenate([~solid[1:], [True]]) | solid & edge[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_names(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two names of 64 bits for each word of the bytes data[a:b], made by scrambling eight bytes at a time: each step mixes what
    it has with the next bytes, so no rule of arithmetic makes words of different bytes meet."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = (b - a).astype(np.uint64)
    one, two = mix(size * M1 + M2), mix(size * M3 + M1)
    at, left, rows = a, b - a, slice(None)
    while len(at):
        part = eight[at] & FIRST[np.minimum(left, 8)]
        one[rows] = mix(one[rows] ^ mix(part + M1))
        two[rows] = mix(two[rows] + mix(part ^ M2) * M3)
        more = left > 8
        rows = np.flatnonzero(more) if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return one, two


def _interior(word: np.ndarray, doc: np.ndarray, p: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first word of each, first and last interior symbol of each window that starts at p) after so many rounds."""
    new = np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(word))).astype(np.uint64)
    sym, of = np.where(size > 1, pair(word[at], size, 7), word[at]), doc[at]
    index = np.cumsum(new) - 1
    low, high = index[p] + 1, index[p + LENGTH - 1] - 1  # a run at an edge may go on outside
    for r in range(rounds):
        left = (mix(sym + np.uint64(r + 1)) >> np.uint64(17)) & np.uint64(1) == 1
        starts = np.concatenate([left[:-1] & ~left[1:] & (of[1:] == of[:-1]), [False]])
        kept = np.concatenate([[True], ~starts[:-1]])
        index = np.cumsum(kept) - 1
        low, high = np.minimum(low, len(sym) - 1), np.maximum(high, 0)
        none = low > high
        low = np.minimum(low + ~left[low], len(sym) - 1)
        high = np.maximum(high - left[high], 0)
        none |= low > high
        low, high = np.where(none, 1, index[low]), np.where(none, 0, index[high])
        sym = np.where(starts, pair(sym, np.roll(sym, -1), 11 + r), sym)[kept]
        of, at = of[kept], at[kept]
    return sym, at, low, high


def _anchors(word: np.ndarray, doc: np.ndarray, p: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, whether there is any) of the interior symbol that stands for each window; else the window itself."""
    sym, at, low, high = _interior(word, doc, p, rounds)
    none = low > high
    place = np.uint64((1 << len(sym).bit_length()) - 1)
    key = (mix(sym) & ~place) | np.arange(len(sym), dtype=np.uint64)
    table = np.full((5, len(key)), np.iinfo(np.uint64).max, np.uint64)  # least key of 1, 2, 4, 8, 16 symbols
    table[0] = key
    for j in range(1, 5):
        h, n = 1 << (j - 1), len(key) - (1 << j) + 1
        if n > 0:
            table[j, :n] = np.minimum(table[j - 1, :n], table[j - 1, h : h + n])
    low, high = np.where(none, 0, low), np.where(none, 0, high)
    j = LOG2[high - low + 1]
    best = (np.minimum(table[j, low], table[j, high - (1 << j) + 1]) & place).astype(np.int64)
    return sym[best], np.where(none, p, at[best]), ~none


def symbols(docs: list, asked: list, rounds: int, width: int, check: bool) -> Iterator[Columns]:
    """Stretches of up to `width` windows by the symbol that stands for them after `rounds` rounds; check: with names of their words."""
    for data, starts, ids, ranges in repeats.chunks(docs, asked):
        if not len(data):
            continue
        a, b = word_bounds(data, starts)
        if len(a) < LENGTH:
            continue
        word, other = word_names(data, a, b)
        doc = np.searchsorted(starts, a, "right") - 1
        began = np.searchsorted(doc, np.arange(len(ids)))  # the first word of each document
        p = np.flatnonzero(doc[: len(word) - LENGTH + 1] == doc[LENGTH - 1 :])
        p = p[repeats.chosen(p, began, ranges)]
        if not len(p):
            continue
        name, anchor, any_ = _anchors(word, doc, p, rounds)
        first, end = repeats.groups(p, doc[p], np.where(any_, anchor, -1 - p), anchor - p, width)
        p, last, a, name, any_ = p[first], p[end], anchor[first], name[first], any_[first]
        names = Names(word)
        content = names.of(p, last + LENGTH)
        if width < LENGTH:  # the words that all windows of a stretch have in common
            low = (a - p) // width * width
            name = names.of(a - low, a - np.minimum(low + width, LENGTH) + 1 + LENGTH)
        name = np.where(any_, name, mix(content + np.uint64(5)))
        ctx = np.zeros(len(p), np.uint64)
        if check:
            again = Names(other).of(p, last + LENGTH)
            ctx = pair(pair(content, again), ((a - p) * 64 + (last - p)).astype(np.uint64), 9)
        yield columns(name=name, ctx=ctx, doc=ids[doc[p]], at=p - began[doc[p]], more=last - p)


#: A filter after each round of recompression but the last, whose shared symbols are verified.
STEPS = [(functools.partial(symbols, rounds=r, width=LENGTH, check=False), False) for r in range(1, ROUNDS)]
STEPS += [(functools.partial(symbols, rounds=ROUNDS, width=w, check=True), True) for w in WIDTHS]


def _cut(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    spans = repeats.repeated(docs.select(doc.alias("doc"), "text"), STEPS, False)
    return docs.join(small(spans), doc == F.col("_doc"), "left")


def _gone(n: int, packed: str | None) -> np.ndarray:
    """A mask of the words that go."""
    out = np.zeros(n, bool)
    for start, end in repeats.spans_of(packed, LENGTH).tolist():
        out[start:end] = True
    return out


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, packed in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_spans")), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                gone = _gone(len(words), packed)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if packed else words
                rows.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    held = docs.select("doc_id", "text")
    return _cut(held).select(F.col("doc_id").cast("long"), "text", "_spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def strip_documents(docs: DataFrame) -> DataFrame:
    """`docs` with repeated words taken out of `text`; white space before kept words stays. n_chars, if there, follows."""

    @F.pandas_udf("string")
    def cut(text, packed):
        def one(t, s):
            if s is None or t is None:
                return t
            data = t.encode("utf-8", "surrogatepass")
            a, b = word_bounds(np.frombuffer(data, np.uint8), np.array([0]))
            gone = _gone(len(a), s)
            before = np.concatenate([[0], b[:-1]])
            kept = b"".join(data[x:y] for x, y, g in zip(before.tolist(), b.tolist(), gone.tolist(), strict=True) if not g)
            return kept.strip(b" \t\n\x0b\x0c\r").decode("utf-8", "surrogatepass")

        return text.combine(packed, one)

    out = _cut(boxed(docs, "doc_id", "text")).withColumn("text", cut("text", "_spans"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unboxed(out, docs, **changed)
