"""A hidden Markov language model, trained by Baum-Welch over all training documents.

Symbols are the HEAD most frequent training tokens, the end of a text, and TAIL classes that hold all other tokens by digest.
Expected counts of a partition are added up in Spark, one row for each symbol; the scaled forward recursion then gives the
exact likelihood of a text's symbols. A token of a tail class adds its share within the class, from the exact counts of all
training tokens, which are joined by shuffle; a token that training lacks has the share of one unseen token. So the
probabilities of all texts add up to one over the training tokens and one unseen token in each class.

Training starts from emissions near the token frequencies and takes STEPS steps. For training, texts are cut into pieces of PIECE
tokens, of which all are used; scoring runs through the whole text.

Nulls: a null text is an empty one, just the end token. A null doc_id counts as the empty text under crc32. Repeated rows each
get a score. Without training rows every count is zero and the scores are those of even emissions. Very long texts are scored
whole; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import stage
from volcohort.llm.text import keyed_crc

STATES = 4
STEPS = 3
HEAD = 65000
TAIL = 256
END = b" "  # no word holds a blank
PIECE = 512
ARROW_ROWS = 4000
#: Distinct words that a task holds before it hands on its counts.
FLUSH = 1_000_000
#: Weight of the token frequencies in the emissions of a state.
SMOOTH = 1.0


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _counted(docs: DataFrame) -> DataFrame:
    """(word, c) over all training documents, the end of texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

        for b in batches:
            for t in b.column("text"):
                held.update(tokens(t.as_py()))
                held[END] += 1
            if len(held) > FLUSH:
                yield rows()
                held.clear()
        if held:
            yield rows()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _head(vocab: DataFrame) -> list[bytes]:
    """The HEAD words of the highest counts, by steps of their logarithm; within the last step those of smallest digest."""
    level = F.floor(F.log2("c") * 64).cast("long")
    levels = sorted(((r["l"], r["n"]) for r in vocab.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, bound = 0, None
    for at, n in levels:
        if total + n > HEAD:
            break
        total, bound = total + n, at
    whole = vocab.where(level >= bound) if bound is not None else vocab.where("false")
    part = vocab.where(level < bound) if bound is not None else vocab
    if total < HEAD and part.limit(1).count():
        next_ = part.where(level == part.agg(F.max(level)).first()[0])
        whole = whole.union(next_.orderBy(F.xxhash64("word"), "word").limit(HEAD - total))
    return sorted(bytes(r["word"]) for r in whole.select("word").collect() if bytes(r["word"]) != END)  # HEAD words at most


def _encoded(docs: DataFrame, head: list[bytes]) -> DataFrame:
    """A row for each document: its symbols as 16-bit numbers, and its other words with their numbers."""
    ids = docs.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(head)})  # 0 is the end
    first = len(head) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids.value.get
        row = TaskContext.get().partitionId() << 40
        for b in (b for b in batches if b.num_rows):
            out: list[tuple] = []
            for doc, held, text in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), b.column("text"), strict=True):
                words = tokens(text.as_py())
                seq = [known(w, -1) for w in words]
                rest = Counter(w for w, s in zip(words, seq, strict=True) if s < 0)
                if rest:
                    seq = [s if s >= 0 else first + zlib.crc32(w) % TAIL for w, s in zip(words, seq, strict=True)]
                seq.append(0)
                out.append((row, doc, held, len(seq), np.array(seq, "<u2").tobytes(), list(rest), list(rest.values())))
                row += 1
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            names = ["row", "doc_id", "held_out", "n_tokens", "seq", "rest", "times"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "row long, doc_id long, held_out boolean, n_tokens long, seq binary, rest array<binary>, times array<long>"
    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, schema)


def _sequences(column: pa.Array, piece: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, start and length of each piece, whether it begins a text), longest first."""
    seqs = [np.frombuffer(x.as_py(), "<u2") for x in column]
    flat = np.concatenate(seqs).astype(np.int64)
    sizes = np.array([len(s) for s in seqs])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    begins = np.ones(len(sizes), bool)
    if piece:
        parts = -(-sizes // piece)
        of = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, sizes, begins = starts[of] + nth * piece, np.minimum(piece, sizes[of] - nth * piece), nth == 0
    order = np.argsort(-sizes, kind="stable")
    return flat, starts[order], sizes[order], np.stack([order, begins[order]])


def forward(flat, starts, sizes, begins, model, keep: bool):
    """Natural log likelihood of each piece (longest first) by the scaled forward recursion; if keep, also the scaled
    forward variables and scales by place in `flat`."""
    start, middle, move, emit = model
    logs = np.zeros(len(starts))
    alphas = np.empty((len(flat), len(start))) if keep else None
    scales = np.empty(len(flat)) if keep else None
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    a = np.where(begins[:, None], start, middle)
    for t, k in enumerate(active.tolist()):
        at = starts[:k] + t
        a = (a[:k] if not t else a[:k] @ move) * emit[flat[at]]
        s = a.sum(axis=1)
        a /= s[:, None]
        logs[:k] += np.log(s)
        if keep:
            alphas[at], scales[at] = a, s
    return logs, alphas, scales


def expected(flat, starts, sizes, begins, model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of (symbol, state), of moves, and of states at the start of texts."""
    _, _, move, emit = model
    _, alphas, scales = forward(flat, starts, sizes, begins, model, keep=True)
    moves = np.zeros_like(move)
    gammas = alphas.copy()  # beta is one at the end of a piece
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right").tolist()
    beta = np.ones((len(starts), len(move)))
    for t in range(len(active) - 1, 0, -1):
        k = active[t]
        at = starts[:k] + t
        x = emit[flat[at]] * beta[:k] / scales[at][:, None]
        before = alphas[at - 1]
        moves += before.T @ x
        beta[:k] = x @ move.T
        gammas[at - 1] = before * beta[:k]
    moves *= move
    counts = np.stack([np.bincount(flat, gammas[:, s], minlength=len(emit)) for s in range(len(move))], axis=1)
    return counts, moves, gammas[starts[begins]].sum(axis=0)


def _step(train: DataFrame, model) -> dict[int, list[float]]:
    """Expected counts over all rows: a row of the sum for each symbol, and for each state's moves and the starts."""
    shared = train.sparkSession.sparkContext.broadcast(model)
    names = [f"s{i}" for i in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            flat, starts, sizes, more = _sequences(b.column("seq"), PIECE)
            got = expected(flat, starts, sizes, more[1].astype(bool), shared.value)
            total = got if total is None else tuple(x + y for x, y in zip(total, got, strict=True))
        if total is not None:
            counts, moves, begun = total
            used = np.flatnonzero(counts.sum(axis=1) > 0)
            ids = np.concatenate([used, -1 - np.arange(STATES), [-1 - STATES]])
            rows = np.vstack([counts[used], moves, begun[None]])
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(rows[:, s]) for s in range(STATES))], names=["id", *names])

    sums = train.select("seq").mapInArrow(run, "id long, " + ", ".join(f"{n} double" for n in names))
    found = sums.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).collect()  # HEAD + TAIL + STATES + 2 rows at most
    shared.unpersist()
    return {r["id"]: [r[n] for n in names] for r in found}


def _initial(frequency: np.ndarray):
    rng = np.random.default_rng(9)
    emit = frequency[:, None] * np.exp(rng.normal(0, 0.5, (len(frequency), STATES)))
    move = np.full((STATES, STATES), 0.5 / STATES) + 0.5 * np.eye(STATES)
    even = np.full(STATES, 1 / STATES)
    return even, even, move, emit / emit.sum(axis=0)


def _next(found: dict[int, list[float]], frequency: np.ndarray):
    counts = np.zeros((len(frequency), STATES))
    for i, row in found.items():
        if i >= 0:
            counts[i] = row
    moves = np.array([found.get(-1 - s, [0.0] * STATES) for s in range(STATES)]) + 1 / STATES
    begun = np.array(found.get(-1 - STATES, [0.0] * STATES)) + 1 / STATES
    used = counts.sum(axis=0)
    emit = (counts + SMOOTH * frequency[:, None]) / (used + SMOOTH)
    middle = (used + 1 / STATES) / (used + 1 / STATES).sum()
    return begun / begun.sum(), middle, moves / moves.sum(axis=1, keepdims=True), emit


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs`."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    held = docs.select("doc_id", "text", (keyed_crc() % 7 == 2).alias("held_out"))
    vocab = stage(_counted(held.where("not held_out")), "lm-counts")
    tail_class = F.pmod(F.crc32("word"), F.lit(TAIL))
    size = vocab.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = size["n"] or 0, size["v"]
    head = _head(vocab)
    known = spark.createDataFrame([(w,) for w in head], "word binary")
    # Tail classes: TAIL rows.
    rest = vocab.where(F.col("word") != F.lit(END)).join(F.broadcast(known), "word", "left_anti")
    classes = {r["k"]: (r["n"], r["v"]) for r in rest.groupBy(tail_class.alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    symbols = len(head) + 1 + TAIL
    frequency, base = np.zeros(symbols), np.zeros(len(head) + 1)
    wanted = {w: i + 1 for i, w in enumerate(head)} | {END: 0}
    for r in vocab.join(F.broadcast(known.union(spark.createDataFrame([(END,)], "word binary"))), "word").collect():  # HEAD + 1 rows at most
        frequency[wanted[bytes(r["word"])]] = r["c"]
    ends = frequency[0]
    base[:] = np.log10((frequency[: len(head) + 1] + 1) / (n + v + 1))
    for k in range(TAIL):
        frequency[len(head) + 1 + k] = classes.get(k, (0, 0))[0]
    frequency = (frequency + 1) / (frequency + 1).sum()

    encoded = stage(_encoded(held, head), "lm-symbols")
    model = _initial(frequency)
    for _ in range(STEPS if n else 0):
        model = _next(_step(encoded.where("not held_out"), model), frequency)
    shared = spark.sparkContext.broadcast((model, base, ends > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base, end_known = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            flat, starts, sizes, more = _sequences(b.column("seq"))
            logs, _, _ = forward(flat, starts, sizes, more[1].astype(bool), model, keep=False)
            out = np.empty(len(logs))
            out[more[0]] = logs / np.log(10)
            lengths = b.column("n_tokens").to_numpy()
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            inside = flat < len(base)
            head_sum = np.array([base[x[x < len(base)]].sum() for x in np.split(flat, bounds[1:-1])])
            n_head = np.add.reduceat(inside.astype(np.int64), bounds[:-1]) - (0 if end_known else 1)
            cols = [b.column(c) for c in ("row", "doc_id", "held_out", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out), pa.array(head_sum), pa.array(n_head)], names=["row", "doc_id", "held_out", "n_tokens", "hmm", "head", "n_head"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, hmm double, head double, n_head long"
    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "seq").mapInArrow(run, schema)
    # Words outside the head: (row, word, times), joined with the exact counts.
    loose = encoded.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "times")).alias("x"))
    loose = loose.select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    counted = loose.join(vocab, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    share = F.create_map(*[F.lit(x) for k in range(TAIL) for x in (k, float(np.log10(sum(classes.get(k, (0, 0))) + 1)))])
    per_row = counted.groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.col("c") + 1) - share[tail_class.cast("int")])).alias("within"),
        F.sum(F.col("times") * (F.log10(F.col("c") + 1) - float(np.log10(n + v + 1)))).alias("tail"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_tail"),
    ).withColumnRenamed("row", "_row")
    zero = F.lit(0.0)
    return scored.join(per_row, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("head") + F.coalesce("tail", zero)).alias("base_score"),
        (F.col("hmm") + F.coalesce("within", zero)).alias("score"),
    )
