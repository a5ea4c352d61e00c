"""Matching across sources: candidate cascades, fusion, argmax, nearest neighbours, typed warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cascade(
    left: DataFrame, right: DataFrame, on: list[str], keys: list[str], tiers: list[Column], rank: list[Column], where: Column | None = None
) -> DataFrame:
    """Candidates of each row of `left`, told apart by `keys`: an equi-join (pairs that meet `where`, if given), then only those
    of the first tier that any of its candidates meets, ranked."""
    pairs = left.join(right, on)
    return ranked(pairs if where is None else pairs.where(where), keys, tiers, rank)


def ranked(pairs: DataFrame, keys: list[str], tiers: list[Column], rank: list[Column]) -> DataFrame:
    """`cascade` from its pairs."""
    out = pairs.withColumn("tier", _tier(tiers))
    out = out.withColumn("_best", F.min("tier").over(Window.partitionBy(*keys))).where("tier = _best").drop("_best")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*rank)))


def _tier(tiers: list[Column]) -> Column:
    return F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(tiers)], F.lit(len(tiers)))


def candidates(left: DataFrame, right: DataFrame, on: list[str], where: Column, tiers: list[Column], rank: list[Column], first: bool = False) -> DataFrame:
    """The pairs of an equi-join that meet `where`, without those that can't be kept by `cascade`: of each row of `left` the pairs of
    its first tier, if only the `first` candidate is wanted those of the least rank[0] (a number) in it.

    Pairs are made twice instead of sorted: the first time only numbers are kept of them, which Spark aggregates by hash in the
    tasks of the join. Equal rows of `left` are told apart by their number."""
    tier, own = _tier(tiers), left.columns
    # Dealt by the key of the join first, so that equal rows are counted where they are joined.
    rows = left.select("*", F.lit(1).alias("_copies")) if first else left.repartition(*on).groupBy(*own).agg(F.count(F.lit(1)).alias("_copies"))
    pairs = rows.join(right, on).where(where)
    least = [F.min(F.when(tier == t, rank[0])).alias(f"_{t}") for t in range(len(tiers) + 1)] if first else []
    best = pairs.groupBy(*own, "_copies").agg(F.min(tier).alias("_tier"), *least)
    kept = tier == F.col("_tier")
    if first:
        best = best.select(*own, "_copies", "_tier", F.coalesce(*[F.when(F.col("_tier") == t, F.col(f"_{t}")) for t in range(len(tiers) + 1)]).alias("_least"))
        kept = kept & (rank[0].isNull() | (rank[0] == F.col("_least")))
    out = best.hint("merge").join(right, on).where(where & kept)
    more = [c for c in right.columns if c not in on]
    return out.select(*own, *more) if first else out.select(*own, *more, F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")


def first_candidate(pairs: DataFrame, keys: list[str], tiers: list[Column], rank: list[Column], keep: list[str]) -> DataFrame:
    """keys, tier, keep: the row of `cascade` with rank 1, by a partial aggregate before the shuffle instead of windows."""
    order = F.struct(_tier(tiers).alias("tier"), *[c.alias(f"_{i}") for i, c in enumerate(rank)], *keep)
    return pairs.groupBy(*keys).agg(F.min(order).alias("_b")).select(*keys, "_b.tier", *[F.col("_b")[c].alias(c) for c in keep])


def best_by(df: DataFrame, keys: list[str], value: str, tie: str, keep: list[str]) -> DataFrame:
    """The row of the greatest value of each key; ties go to the smallest `tie` (numeric)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.struct(F.col(value), -F.col(tie))).alias("_b")).select(*keys, "_b.*")


def fusion(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """key, status: whether the best of both sides is the same (fused), another (separate), or there is one side only."""
    both = a.select(key, F.col(value).alias("_a")).join(b.select(key, F.col(value).alias("_b")), key, "full_outer")
    status = F.when(F.col("_a").isNull(), "b_only").when(F.col("_b").isNull(), "a_only").when(F.col("_a") == F.col("_b"), "fused").otherwise("separate")
    return both.select(key, status.alias("status"))


def warnings(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """keys, warning: a row for each rule that holds."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(*keys, F.explode(held).alias("warning"))


def nearest(a: DataFrame, b: DataFrame, case: str, a_id: str, b_id: str) -> DataFrame:
    """case, a_id, b_id, dist: for each thing of a the thing of b at the least distance of their points (x, y, z).

    The equi-join on the case bounds the pairs; the least distance of each pair is a partial aggregate."""
    p, q = a.select(case, a_id, *[F.col(c).alias(f"a{c}") for c in "xyz"]), b.select(case, b_id, *[F.col(c).alias(f"b{c}") for c in "xyz"])
    far = F.sqrt(sum(((F.col(f"a{c}") - F.col(f"b{c}")) * (F.col(f"a{c}") - F.col(f"b{c}")) for c in "xyz"), F.lit(0.0)))
    pairs = p.join(q, case).groupBy(case, a_id, b_id).agg(F.round(F.min(far), 6).alias("dist"))
    return pairs.groupBy(case, a_id).agg(F.min(F.struct("dist", b_id)).alias("m")).select(case, a_id, f"m.{b_id}", "m.dist")


def incidence(near: DataFrame, a_number: Column, b_number: Column, anchor: float, first_other: int) -> DataFrame:
    """Add bucket: match, offset, lumbar (the neighbour's number is `first_other` or more), or no_contact beyond the anchor."""
    bucket = F.when(F.col("dist") > anchor, "no_contact").when(b_number >= first_other, "lumbar").when(a_number == b_number, "match").otherwise("offset")
    return near.withColumn("bucket", bucket)
