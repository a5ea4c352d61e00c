"""Merging quality checks, re-calibrating a flag and ranking what needs review."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.functions.stats import nth


def last_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`, taken by a partial aggregate and not by a sort of the group."""
    rest = [c for c in df.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("_row")).select(*keys, "_row.*")


def merge_checks(keys: list[str], checks: dict[str, DataFrame]) -> DataFrame:
    """FULL OUTER JOIN of the checks on `keys`. A check has `flag` and `metric`; they come out as flag_<name> (0 if the check
    lacks the case) and metric_<name>, with n_flags and needs_review."""
    parts = [df.select(*keys, F.col("flag").alias(f"flag_{n}"), F.col("metric").alias(f"metric_{n}")) for n, df in checks.items()]
    out = reduce(lambda a, b: a.join(b, keys, "full_outer"), parts)
    out = out.withColumns({f"flag_{n}": F.coalesce(F.col(f"flag_{n}").cast("int"), F.lit(0)) for n in checks})
    out = out.withColumn("n_flags", reduce(Column.__add__, [F.col(f"flag_{n}") for n in checks]))
    return out.withColumn("needs_review", (F.col("n_flags") > 0).cast("int"))


def recalibrate(df: DataFrame, baseline: DataFrame, metric: str, share: float) -> DataFrame:
    """Set flag to metric > the baseline's percentile of it (exact, linear; infinite without a baseline); a missing metric isn't
    flagged. The percentile comes from counts by bins, so the baseline isn't ordered in one task."""
    bound, n = float("inf"), baseline.where(F.col(metric).isNotNull()).count()
    if n:
        place = (n - 1) * share
        low, high = math.floor(place), math.ceil(place)
        a, b = nth(baseline, metric, [low, high]) if high > low else nth(baseline, metric, [low]) * 2
        bound = a if a == b else (high - place) * a + (place - low) * b
    return df.withColumn("flag", F.coalesce((F.col(metric) > F.lit(bound)).cast("int"), F.lit(0)))


def triage(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Add flags (names joined by ;), n_flags and score: each rule is (condition, weight)."""
    hit = {n: F.coalesce(c, F.lit(False)) for n, (c, _) in rules.items()}
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in hit.items()]))
    score = reduce(Column.__add__, [F.when(hit[n], w).otherwise(0.0) for n, (_, w) in rules.items()])
    return df.withColumns({"flags": F.array_join(names, ";"), "n_flags": F.size(names), "score": F.round(score, 2)})


def out_of_range(df: DataFrame, keys: list[str], bounds: list[tuple[str, float, float]]) -> DataFrame:
    """keys, measure, value: the values of each row outside the bounds of the first pattern that fits the column's name."""
    fits = lambda c: next((b for b in bounds if b[0] in c), None)
    cols = [c for c in df.columns if c not in keys and fits(c)]
    held = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"), F.lit(float(fits(c)[1])).alias("lo"), F.lit(float(fits(c)[2])).alias("hi")) for c in cols]
    out = df.select(*keys, F.explode(F.array(*held)).alias("m")).select(*keys, "m.*")
    return out.where("value < lo or value > hi").select(*keys, "measure", "value")


#: Hexadecimal digits of a digest by which a stratum is cut into pieces, 16 to that power.
PIECES = 3


def _dealt(df: DataFrame, key: str, stratum: str, seed: int) -> DataFrame:
    """Add `_place`, from 0, within the stratum in the order of a digest. Places are counted within the pieces of the digest's first
    digits and added to the counts of the pieces before, so no task orders a whole stratum."""
    own = df.withColumn("_d", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))).withColumn("_p", F.substring("_d", 1, PIECES))
    counts = own.groupBy(F.col(stratum).alias("_s"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_s").orderBy("_q")) - F.col("_c")
    within = F.row_number().over(Window.partitionBy(stratum, "_p").orderBy("_d", key)) - 1
    held = own.withColumn("_r", within).join(counts.select("_s", "_q", before.alias("_before")), F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_q")))
    return held.withColumn("_place", F.col("_r") + F.col("_before")).drop("_d", "_p", "_s", "_q", "_r", "_before")


def stratified_folds(df: DataFrame, key: str, stratum: str, k: int, seed: int) -> DataFrame:
    """Add `fold`: round robin within the stratum in the order of a digest, so sizes differ by one at most."""
    return _dealt(df, key, stratum, seed).withColumn("fold", F.pmod("_place", F.lit(k))).drop("_place")


def stratified_sample(df: DataFrame, key: str, stratum: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows (or all), shared among the strata by the largest remainder, at least one of each while n allows."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("g"))
    every = Window.partitionBy(F.lit(0))  # one row for each stratum
    exact = F.lit(n) * F.col("g") / F.sum("g").over(every)
    sizes = sizes.withColumn("base", F.greatest(F.lit(1), F.floor(exact))).withColumn("rest", exact - F.floor(exact))
    nth = F.row_number().over(every.orderBy(F.desc("rest"), stratum))
    sizes = sizes.withColumn("take", F.least("g", F.col("base") + F.when(nth <= F.lit(n) - F.sum("base").over(every), 1).otherwise(0)))
    placed = _dealt(df, key, stratum, seed)
    return placed.join(F.broadcast(sizes.select(stratum, "take")), stratum).where("_place < take").drop("_place", "take")
