"""Panels of a cohort's measures: by sex, by level, by decade, relative to the size of the skeleton."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.functions.stats import median_interval, middle


def sex_of(c: Column) -> Column:
    """female or male by the first letter; NULL for others."""
    first = F.upper(F.substring(F.trim(c), 1, 1))
    return F.when(first == "F", "female").when(first == "M", "male")


def by_sex(df: DataFrame, sex: str, measures: list[str], least: int = 20) -> DataFrame:
    """measure, n_female, n_male, female, male (medians), gap (female - male), for measures that both sexes have `least` values of.
    All measures take one pass."""
    long_ = df.select(sex_of(F.col(sex)).alias("sex"), F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures])))
    m = middle(long_.where("sex is not null"), ["measure", "sex"], "v").where(F.col("n") >= least)
    of = lambda s, c: F.max(F.when(F.col("sex") == s, F.col(c)))
    g = m.groupBy("measure").agg(of("female", "n").alias("n_female"), of("male", "n").alias("n_male"), of("female", "median").alias("female"), of("male", "median").alias("male"))
    return g.where("n_female is not null and n_male is not null").withColumn("gap", F.col("female") - F.col("male"))


def skeleton_size(widths: Column) -> Column:
    """The mean of the widths that there are; zeros don't count."""
    ok = F.filter(widths, lambda w: w.isNotNull() & (w != 0))
    return F.when(F.size(ok) > 0, F.aggregate(ok, F.lit(0.0), lambda s, w: s + w) / F.size(ok))


def with_relative(df: DataFrame, widths: list[str], measures: list[str]) -> DataFrame:
    """Add size and rel_<measure>, a measure over the size; NULL without either or for a measure of zero."""
    df = df.withColumn("size", skeleton_size(F.array(*[F.col(w).cast("double") for w in widths])))
    return df.withColumns({f"rel_{m}": F.when(F.col(m) != 0, F.col(m) / F.col("size")) for m in measures})


def gradient(df: DataFrame, levels: dict[str, str], least: int = 30, fewest: int = 3) -> DataFrame:
    """level, n, median of each level (name: column) with `least` values; no rows with fewer than `fewest` such levels."""
    long_ = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("level"), F.col(c).cast("double").alias("v")) for n, c in levels.items()])))
    m = middle(long_, ["level"], "v").where(F.col("n") >= least)
    enough = m.agg(F.count(F.lit(1)).alias("levels"))  # one row; as many levels as columns
    return m.join(F.broadcast(enough), F.col("levels") >= fewest).drop("levels")


def ridges(df: DataFrame, age: str, value: str, low: int = 40, high: int = 99, width: int = 10, least: int = 25) -> DataFrame:
    """decade, n, median, lo, hi of the values of each decade of age that has `least`, by the rule of `median_interval`."""
    own = df.where(F.col(age).between(low, high)).select((F.floor(F.floor(F.col(age)) / width) * width).cast("int").alias("decade"), F.col(value).alias("v"))
    m = median_interval(own, ["decade"], "v").where(F.col("n") >= least)
    return m.select("decade", "n", F.round("median", 1).alias("median"), "lo", "hi")
