"""Cohort panels: cells with a least size, differences between groups, heaping, leave-one-out ranks, linear models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.functions.stats import ranked
from volcohort.operators.storage import staged


def cells(df: DataFrame, keys: list[str], value: str, least: int, fractions: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """keys, n, q0, q1, ...: index quantiles v[min(n-1, int(f n))] of cells of at least `least` values."""
    r = ranked(df.where(F.col(value).isNotNull()), keys, value)
    at = lambda f: F.max(F.when(F.col("_r") == F.least(F.col("_n") - 1, F.floor(F.lit(f) * F.col("_n"))), F.col(value)))
    return r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[at(f).alias(f"q{i}") for i, f in enumerate(fractions)]).where(F.col("n") >= least)


def difference(df: DataFrame, keys: list[str], side: str, a: str, b: str, value: str, least: int) -> DataFrame:
    """keys, n_a, n_b, median_a, median_b, difference between two sides of at least `least` values each."""
    of = lambda s: F.when(F.col(side) == s, F.col(value))
    g = df.groupBy(*keys).agg(F.count(of(a)).alias("n_a"), F.count(of(b)).alias("n_b"), F.median(of(a)).alias("median_a"), F.median(of(b)).alias("median_b"))
    return g.where((F.col("n_a") >= least) & (F.col("n_b") >= least)).withColumn("difference", F.col("median_a") - F.col("median_b"))


def heaping(df: DataFrame, age: str, low: int, high: int) -> DataFrame:
    """(n, share_of_zeros, index): ages that end in 0, in per cent, and five times the share of 0 and 5, in per cent."""
    x = df.where(F.col(age).between(low, high))
    n = F.count(F.lit(1))
    return x.agg(n.alias("n"), (100 * F.count_if(F.col(age) % 10 == 0) / n).alias("share_of_zeros"), (500 * F.count_if(F.col(age) % 5 == 0) / n).alias("index"))


def shares(df: DataFrame, keys: list[str], condition: Column, least: int) -> DataFrame:
    """keys, n, percent of the rows that meet a condition, in cells of at least `least` rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("k"))
    return g.where(F.col("n") >= least).select(*keys, "n", (100 * F.col("k") / F.col("n")).alias("percent"))


def hits_at(df: DataFrame, fold: list[str], score: str, positive: str, tie: str, k: int) -> DataFrame:
    """fold, positives, hits: positives among the k highest scores of each fold."""
    r = df.withColumn("_r", F.row_number().over(Window.partitionBy(*fold).orderBy(F.desc(score), tie)))
    return r.groupBy(*fold).agg(F.count_if(positive).alias("positives"), F.count_if(F.col(positive) & (F.col("_r") <= k)).alias("hits"))


def moments(df: DataFrame, features: list[str], label: str) -> dict[bool, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, means and scatter of each class: as many sums as pairs of features, whatever the rows."""
    sums = [F.sum(F.col(f).cast("double")).alias(f"s{i}") for i, f in enumerate(features)]
    cross = [F.sum(F.col(f).cast("double") * F.col(g)).alias(f"c{i}_{j}") for i, f in enumerate(features) for j, g in enumerate(features) if j >= i]
    out = {}
    for r in df.dropna(subset=[*features, label]).groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums, *cross).collect():
        n, k = r["n"], len(features)
        mean = np.array([r[f"s{i}"] / n for i in range(k)])
        raw = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] / n for j in range(k)] for i in range(k)])
        out[bool(r[label])] = (n, mean, raw - np.outer(mean, mean))
    return out


def fisher_direction(df: DataFrame, features: list[str], label: str, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the linear discriminant of two classes, on features scaled by the pooled deviation."""
    m = moments(df, features, label)
    if len(m) < 2:
        return np.zeros(len(features))
    (n0, mu0, s0), (n1, mu1, s1) = m[False], m[True]
    pooled = (n0 * s0 + n1 * s1) / (n0 + n1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
    cov = pooled / np.outer(scale, scale) + ridge * np.eye(len(features))
    return np.linalg.pinv(cov) @ ((mu1 - mu0) / scale) / scale


def project(df: DataFrame, features: list[str], weights: np.ndarray, out: str) -> DataFrame:
    return df.withColumn(out, sum((F.col(f) * float(w) for f, w in zip(features, weights, strict=True)), F.lit(0.0)))


def fit_logistic(df: DataFrame, features: list[str], label: str, steps: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by so many steps down the gradient from zero; the constant isn't shrunk.

    Each step is one aggregate of as many sums as features over the rows, which are written once and kept by the executors; no plan
    grows with the steps. Rows with a NULL are left out; no rows give zeros."""
    rows = staged(df.dropna(subset=[*features, label]).select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y")), "logistic").persist()
    w = np.zeros(len(features) + 1)
    x = [*[F.col(f"x{i}") for i in range(len(features))], F.lit(1.0)]
    try:
        for _ in range(steps):
            off = 1 / (1 + F.exp(-sum((F.lit(float(v)) * c for v, c in zip(w, x, strict=True)), F.lit(0.0)))) - F.col("y")
            got = rows.agg(F.count(F.lit(1)), *[F.sum(off * c) for c in x]).first()
            if not got[0]:
                break
            w = w - rate * (np.array(got[1:], float) / got[0] + ridge * np.append(w[:-1], 0.0))
    finally:
        rows.unpersist()
    return w
