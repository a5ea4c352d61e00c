"""Operators on ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def gaps(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """keys, missing: numbers between the least and the greatest of a key that it lacks. A gap is a pair of neighbours, so the
    sequence made is no longer than what is missing."""
    w = Window.partitionBy(*keys).orderBy(number)
    pairs = df.select(*keys, number).distinct().withColumn("_next", F.lead(number).over(w)).where(F.col("_next") > F.col(number) + 1)
    return pairs.select(*keys, F.explode(F.sequence(F.col(number) + 1, F.col("_next") - 1)).alias("missing"))


def inversions(df: DataFrame, keys: list[str], number: str, position: str) -> DataFrame:
    """keys, number, step: rows whose position doesn't fall below that of the number before."""
    w = Window.partitionBy(*keys).orderBy(number)
    out = df.withColumn("step", F.col(position) - F.lag(position).over(w))
    return out.where("step >= 0").select(*keys, number, "step")


def pitch(df: DataFrame, keys: list[str], number: str, position: str, default: float, sides: list[str] | None = None) -> DataFrame:
    """keys, pitch: median distance of rows whose numbers are one apart, within each of the `sides`; the default without any."""
    w = Window.partitionBy(*keys, *(sides or [])).orderBy(number)
    near = F.col(number) - F.lag(number).over(w) == 1
    d = df.withColumn("_d", F.when(near, F.abs(F.col(position) - F.lag(position).over(w))))
    return d.groupBy(*keys).agg(F.coalesce(F.median("_d"), F.lit(default)).alias("pitch"))


def pitch_of_range(df: DataFrame, keys: list[str], number: str, position: str, default: float) -> DataFrame:
    """keys, pitch: the range of positions over the difference of the numbers at both ends; the default if there is no such
    difference or next to no pitch."""
    ends = df.groupBy(*keys).agg(F.min(F.struct(F.col(position).alias("z"), F.col(number).alias("n"))).alias("a"), F.max(F.struct(F.col(position).alias("z"), F.col(number).alias("n"))).alias("b"))
    p = F.abs((F.col("b.z") - F.col("a.z")) / F.nullif(F.col("b.n") - F.col("a.n"), F.lit(0)))
    return ends.select(*keys, F.when(p > 1e-3, p).otherwise(F.lit(default)).alias("pitch"))


def walk_from_anchor(df: DataFrame, keys: list[str], order: str, position: str, anchor: str) -> DataFrame:
    """Add `solved`: the anchor's number, stepped in both directions by round(distance / median distance), one at least.

    anchor is the number at the one anchored row of a key and NULL elsewhere; keys without it stay NULL."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumn("_d", F.abs(F.col(position) - F.lag(position).over(w)))
    mid = d.groupBy(*keys).agg(F.median("_d").alias("_m"))
    d = d.join(mid, keys)
    d = d.withColumn("_s", F.sum(F.when(F.col("_d").isNotNull() & (F.col("_m") > 0), F.greatest(F.lit(1), F.bround(F.col("_d") / F.col("_m")))).otherwise(0).cast("long")).over(w))
    every = Window.partitionBy(*keys)
    base = F.max(F.when(F.col(anchor).isNotNull(), F.col(anchor) - F.col("_s"))).over(every)
    return d.withColumn("solved", (base + F.col("_s")).cast("long")).drop("_d", "_m", "_s")


def paired_counts(df: DataFrame, case: str, number: str, side: str, cut: str) -> DataFrame:
    """case, n_left, n_right: things on each side, without numbers that are cut off on either."""
    bad = df.where(cut).select(case, number).distinct()
    kept = df.join(bad, [case, number], "left_anti")
    count = lambda s: F.count(F.when(F.col(side) == s, 1))
    return kept.groupBy(case).agg(count("L").alias("n_left"), count("R").alias("n_right"))
