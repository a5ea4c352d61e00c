"""Releases: merging reviews and overrides into a manifest, unfolding split documents, checking files against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_reviews(records: DataFrame, finals: DataFrame, key: str, label: str) -> DataFrame:
    """Records without those whose final decision is reject; corrected ones take the corrected label, with their provenance."""
    f = finals.select(key, "decision", F.col("corrected").alias("_label"))
    out = records.join(f, key, "left").where("coalesce(decision, '') <> 'reject'")
    changed = F.coalesce(F.col("decision") == "corrected", F.lit(False))
    return out.withColumns({
        label: F.when(changed, F.coalesce("_label", label)).otherwise(F.col(label)),
        "provenance": F.when(changed, "corrected").when(F.col("decision").isNotNull(), "reviewed").otherwise("source"),
    }).drop("_label", "decision")


def override(records: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Records with the patch's columns where it has the key, and `touched`; records it lacks pass through."""
    p = patch.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = records.join(p, key, "left").withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns})
    return out.withColumn("touched", F.coalesce("_hit", F.lit(False))).drop("_hit", *[f"_{c}" for c in columns])


def held_out(folds: DataFrame) -> DataFrame:
    """(token, fold): the fold that held a token out, of split documents (fold, val, val_tokens) in either spelling."""
    return folds.select("fold", F.explode(F.coalesce("val_tokens", "val")).alias("token")).groupBy("token").agg(F.min("fold").alias("fold"))


def expand(tokens: DataFrame, cases: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(token with each of its cases, tokens without any)."""
    return tokens.join(cases, key), tokens.join(cases, key, "left_anti")


def check_files(expected: DataFrame, files: DataFrame, path: str, size: str) -> DataFrame:
    """(path, state) of what doesn't fit: missing, empty, or a file that nothing names."""
    e, f = expected.select(path).distinct().withColumn("_e", F.lit(True)), files.select(path, size).withColumn("_f", F.lit(True))
    state = F.when(F.col("_f").isNull(), "missing").when(F.col("_e").isNull(), "unnamed").when(F.col(size) == 0, "empty")
    return e.join(f, path, "full_outer").select(path, state.alias("state")).where("state is not null")


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first record of each key by an ordinal."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def remap_plan(offsets: DataFrame, case: str, delta: str, matched: str, number: str, low: int, high: int) -> DataFrame:
    """(case, plan, reason): auto if all numbers of a case are off by one and the same delta, none matches, and the shifted
    numbers are distinct and in range."""
    moved = F.col(number) + F.col(delta)
    g = offsets.groupBy(case).agg(
        F.count_distinct(delta).alias("d"), F.count_if(matched).alias("m"), F.min(moved).alias("lo"), F.max(moved).alias("hi"),
        (F.count(F.lit(1)) - F.count_distinct(moved)).alias("same"),
    )
    reason = F.when(F.col("m") > 0, "has_matches").when(F.col("d") > 1, "several_deltas").when((F.col("lo") < low) | (F.col("hi") > high), "out_of_range").when(F.col("same") > 0, "duplicate_targets")
    return g.select(case, F.when(reason.isNull(), "auto").otherwise("manual").alias("plan"), F.coalesce(reason, F.lit("")).alias("reason"))


def misnumbered(offsets: DataFrame, case: str, delta: str, votes: int = 3) -> DataFrame:
    """(case, misnumbered, delta, n): whether one non-zero delta occurs `votes` times; ties go to the smaller."""
    c = offsets.where(F.col(delta) != 0).groupBy(case, delta).agg(F.count(F.lit(1)).alias("n"))
    top = c.groupBy(case).agg(F.max(F.struct("n", (-F.col(delta)).alias("d"))).alias("m"))
    return top.select(case, (F.col("m.n") >= votes).alias("misnumbered"), (-F.col("m.d")).alias(delta), F.col("m.n").alias("n"))


def membership(df: DataFrame, *groups: tuple[str, Column]) -> DataFrame:
    """A row for each group that a row is in; groups may overlap."""
    return df.withColumn("subgroup", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in groups]))))
