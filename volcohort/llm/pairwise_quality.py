"""A quality classifier by Bradley-Terry pairwise ranking.

Features of the whole text are computed in DataFrame functions. Pairs of a better and a worse labelled document are
preferences; weights minimise the logistic loss on the difference of their features. The threshold is the quantile of the
training scores at the share of worse documents; a score of PREDICT_AT lies exactly there. All labelled rows count; pairs, sums
over them and the order of the scores are Spark's.

Nulls: a null text is an empty one, with all features zero; it gets a score too. Labels that are null or without a document
are left out. With labels of one kind only, every score is 1 if they are good and 0 if they are bad, and 0.5 with none.
Repeated rows get the same score, and a doc_id that repeats is learnt from once for each of its texts. Scores that tie with the threshold are PREDICT_AT or above it. Very long texts are measured whole; an empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import BROADCAST_BYTES, drop, size_of, stage
from volcohort.llm.text import keyed_crc, text_of, words

PAIRS_PER_ROW = 8
PREDICT_AT = 0.3
L2 = 1e-3

FEATURES = (
    "log_words", "short", "log_chars", "upper", "digits", "marks", "symbols", "far", "spaces", "distinct", "word_length", "dup_lines",
    "line_words", "log_lines", "end_marks", "log_repeats", "shouts", "pipes",
)


def with_features(docs: DataFrame) -> DataFrame:
    """Add `_f`, an array of doubles in the order of FEATURES, from the column `text` alone."""
    t = F.col("_t")
    cut = lambda pattern: (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("double")
    out = docs.withColumn("_t", text_of()).withColumn("_w", words(t)).withColumn("_l", F.array_remove(F.split(t, "\n"), ""))
    out = out.withColumns({
        "_n": F.greatest(F.length(t), F.lit(1)).cast("double"), "_nw": F.size("_w").cast("double"), "_nl": F.size("_l").cast("double"),
        "_u": F.size(F.array_distinct("_w")).cast("double"), "_ul": F.size(F.array_distinct("_l")).cast("double"),
        "_up": cut("[A-Z]+"), "_dg": cut("[0-9]+"), "_mk": cut(r"[!-/:-@\[-`{-~]+"), "_sy": cut(r"[#*$%&|<>]+"), "_fa": cut(r"[^\x00-\x7F]+"),
        "_en": cut(r"[.!?]+"), "_sh": cut(r"!+"), "_pi": cut(r"\|+"), "_wc": F.length(F.array_join("_w", "")).cast("double"),
    })
    n, nw, nl = F.col("_n"), F.greatest("_nw", F.lit(1.0)), F.greatest("_nl", F.lit(1.0))
    share: dict[str, Column] = {
        "log_words": F.log1p("_nw"), "short": (F.col("_nw") < 20).cast("double"), "log_chars": F.log1p("_n"), "upper": F.col("_up") / n,
        "digits": F.col("_dg") / n, "marks": F.col("_mk") / n, "symbols": F.col("_sy") / n, "far": F.col("_fa") / n,
        "spaces": (n - F.col("_wc")) / n, "distinct": F.col("_u") / nw, "word_length": F.col("_wc") / nw / 10,
        "dup_lines": (F.col("_nl") - F.col("_ul")) / nl, "line_words": F.log1p(F.col("_nw") / nl), "log_lines": F.log1p("_nl"),
        "end_marks": F.col("_en") / nw, "log_repeats": F.log(nw / F.greatest("_u", F.lit(1.0))), "shouts": F.col("_sh") / nw, "pipes": F.col("_pi") / nw,
    }
    held = F.array(*[F.when(F.length(t) > 0, share[k]).otherwise(0.0) for k in FEATURES])
    return out.withColumn("_f", held).drop("_t", "_w", "_l", "_n", "_nw", "_nl", "_u", "_ul", "_up", "_dg", "_mk", "_sy", "_fa", "_en", "_sh", "_pi", "_wc")


def ordered(rows: DataFrame, by: list[str], tag: str) -> DataFrame:
    """`rows`, written, with `_i`, their number from 0 in the order of `by`. Each task numbers a range; only counts of ranges are brought
    together."""
    held = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_m", 33)
    first, starts = 0, []
    for r in sorted(held.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        starts += [F.lit(r["p"]), F.lit(first)]
        first += r["n"]
    return held.withColumn("_i", (F.create_map(*starts)[part] + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).cast("long") if starts else F.lit(0).cast("long")).drop("_m")


def pairs_of(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """`_d`, the features of a better row less those of a worse one. Every row meets PAIRS_PER_ROW rows of the other label, spread evenly.
    rows: (quality, _f, _i), bad ones numbered from 0, good ones from n_bad."""
    good = rows.where("quality = 1").select((F.col("_i") - n_bad).alias("i"), F.col("_f").alias("_g"))
    bad = rows.where("quality = 0").select(F.col("_i").alias("j"), F.col("_f").alias("_b"))
    turn = F.explode(F.array(*[F.lit(102 * s) for s in range(PAIRS_PER_ROW)])).alias("_s")
    near = lambda d, n: F.broadcast(d) if 16 * len(FEATURES) * n <= BROADCAST_BYTES else d
    if n_good >= n_bad:
        step = 1 if n_good == n_bad else 7
        both = good.select("*", turn).withColumn("j", (F.col("i") * step + F.col("_s")) % n_bad).join(near(bad, n_bad), "j")
    else:
        both = bad.select("*", turn).withColumn("i", F.pmod(F.col("j") - F.col("_s"), F.lit(n_bad)) % n_good).join(near(good, n_good), "i")
    return stage(both.select(F.zip_with("_g", "_b", lambda x, y: x - y).alias("_d")), "quality-pairs")


def fit(rows: DataFrame, n_good: int, n_bad: int) -> np.ndarray:
    """Weights on raw features: Newton's steps on a convex loss, whose slope and curvature each task sums over its pairs."""
    n = len(FEATURES)
    spread = rows.agg(*[F.stddev_pop(F.get("_f", F.lit(i))).alias(f"s{i}") for i in range(n)]).first()
    scale = np.array([spread[f"s{i}"] for i in range(n)])
    scale[scale < 1e-12] = 1
    pairs, total = pairs_of(rows, n_good, n_bad), PAIRS_PER_ROW * max(n_good, n_bad)
    w = np.zeros(n)
    for _ in range(30):

        def sums(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            slope, curve = np.zeros(n), np.zeros((n, n))
            for b in batches:
                x = b.column(0).flatten().to_numpy().reshape(-1, n) / scale
                p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
                slope += x.T @ p
                curve += (x * (p * (1 - p))[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([slope, curve.ravel()]).tolist()], pa.list_(pa.float64()))], names=["s"])

        s = np.sum([r["s"] for r in pairs.mapInArrow(sums, "s array<double>").collect()], axis=0) / total  # a row for each task
        step = np.linalg.solve(s[n:].reshape(n, n) + L2 * np.eye(n), s[:n] - L2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    drop(pairs)
    return w / scale


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[float], float]:
    """Fit on all rows whose crc32(doc_id as text) mod 5 isn't 0; the threshold is the score at or below which as large a share of them
    lies as is worse."""
    held = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = stage(held.where(keyed_crc() % 5 != 0).select(F.col("doc_id").alias("_id"), "quality"), "quality-labels")
    kinds = {r["quality"] for r in held.select("quality").distinct().collect()}
    if len(kinds) < 2:
        return [0.0] * len(FEATURES), {(1,): -1e9, (0,): 1e9}.get(tuple(kinds), 0.0)
    same, put = F.col("doc_id") == F.col("_id"), ["doc_id", "quality", "_f"]
    if 4 * size_of(held) <= BROADCAST_BYTES:
        rows = with_features(docs.join(F.broadcast(held), same).select("doc_id", "text", "quality")).select(*put)
    else:  # features are far smaller than the texts
        rows = with_features(docs.where(keyed_crc() % 5 != 0).select("doc_id", "text")).select("doc_id", "_f").join(held, same).select(*put)
    rows = ordered(rows.distinct(), ["quality", "doc_id", "_f"], "quality-rows")  # a doc_id may come with several texts
    n = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return [0.0] * len(FEATURES), 0.0
    w = fit(rows, n[1], n[0]).tolist()
    scores = ordered(rows.select(_weighed(w).alias("_z")), ["_z"], "quality-scores")
    return w, float(scores.where(F.col("_i") == n[0] - 1).first()["_z"])


def _weighed(weights: list[float]) -> Column:
    return sum((F.get("_f", F.lit(i)) * w for i, w in enumerate(weights)), F.lit(0.0))


def score(docs: DataFrame, weights: list[float], threshold: float) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    raw = _weighed(weights) - threshold
    shift = float(np.log(PREDICT_AT / (1 - PREDICT_AT))) if any(weights) else 0.0
    out = with_features(docs.select("doc_id", "text")).select("doc_id", (keyed_crc() % 5 == 0).alias("held_out"), (raw + shift).alias("_z"))
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("_z")))
    out = out.withColumn("score", 1 / (1 + F.exp(-z))).drop("_z")
    return out.withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, *train(docs, labels))
