"""Numbering ribs from vertebrae: votes, extrapolation, grouping, invariants of order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def votes(distances: DataFrame, ratio: float = 2.5) -> DataFrame:
    """(case, side, delta, votes, agreed): a vertebra votes by its nearest rib if the next one is over `ratio` times as far; all
    votes must agree. distances: (case, side, vertebra, rib, dist)."""
    w = Window.partitionBy("case", "side", "vertebra").orderBy("dist", "rib")
    r = distances.withColumn("_r", F.row_number().over(w)).withColumn("_next", F.lead("dist").over(w)).where("_r = 1")
    v = r.where(F.col("_next").isNull() | (F.col("_next") > ratio * F.col("dist"))).withColumn("delta", F.col("vertebra") - F.col("rib"))
    g = v.groupBy("case", "side").agg(F.min("delta").alias("delta"), F.count(F.lit(1)).alias("votes"), (F.count_distinct("delta") == 1).alias("agreed"))
    return g.withColumn("delta", F.when(F.col("agreed"), F.col("delta")))


def extrapolate(loose: DataFrame, anchored: DataFrame, spacing: DataFrame, default: float = 20.0) -> DataFrame:
    """(case, side, piece, number): the number of the anchored rib of the side that is nearest in z, moved by the rounded number
    of spacings, within 1 to 12. loose: (case, side, piece, z); anchored: (case, side, rib, rz); spacing: (case, step)."""
    pairs = loose.join(anchored, ["case", "side"]).groupBy("case", "side", "piece", "z").agg(F.min(F.struct(F.abs(F.col("z") - F.col("rz")).alias("d"), "rib", "rz")).alias("m"))
    step = F.coalesce("step", F.lit(default))
    moved = F.col("m.rib") + F.bround((F.col("m.rz") - F.col("z")) / step)
    return pairs.join(spacing, "case", "left").select("case", "side", "piece", F.greatest(F.lit(1), F.least(F.lit(12), moved)).cast("int").alias("number"))


def order_faults(rows: DataFrame, number: str, z: str, widest: float = 1.8) -> DataFrame:
    """(case, side, number, fault): numbers that don't fall in z (order), or by over `widest` pitches for each (span)."""
    w = Window.partitionBy("case", "side").orderBy(number)
    d = rows.withColumn("_dz", F.lag(z).over(w) - F.col(z)).withColumn("_dn", F.col(number) - F.lag(number).over(w))
    pitch = F.median(F.when(F.col("_dz") > 0, F.col("_dz") / F.col("_dn"))).over(Window.partitionBy("case", "side"))
    fault = F.when(F.col("_dz") <= 0, "order").when(F.col("_dz") > widest * pitch * F.col("_dn"), "span")
    return d.withColumn("fault", fault).where("fault is not null").select("case", "side", number, "fault")


def group_pieces(pieces: DataFrame, gap: float) -> DataFrame:
    """(case, side, group, n, z): pieces from high z to low, a new group where one lies more than `gap` under the running mean of
    the last. The fold runs over the pieces of one side, a few dozen."""
    first = F.element_at("zs", 1)
    start = F.struct(F.array(F.struct(first.alias("mean"), F.lit(1).alias("n"))).alias("groups"))

    def fold(acc, z):
        last = F.element_at(acc["groups"], -1)
        near = (last["mean"] - z) <= gap
        grown = F.struct(((last["mean"] * last["n"] + z) / (last["n"] + 1)).alias("mean"), (last["n"] + 1).alias("n"))
        return F.struct(F.when(near, F.concat(F.slice(acc["groups"], 1, F.size(acc["groups"]) - 1), F.array(grown))).otherwise(F.concat(acc["groups"], F.array(F.struct(z.alias("mean"), F.lit(1).alias("n"))))).alias("groups"))

    g = pieces.groupBy("case", "side").agg(F.sort_array(F.collect_list(F.col("z").cast("double")), asc=False).alias("zs"))
    folded = g.select("case", "side", F.aggregate(F.slice("zs", 2, F.greatest(F.lit(1), F.size("zs"))), start, fold)["groups"].alias("groups"))
    return folded.select("case", "side", F.posexplode("groups").alias("group", "g")).select("case", "side", "group", "g.n", F.round("g.mean", 6).alias("z"))


def side_difference(rows: DataFrame, number: str) -> DataFrame:
    """(case, only_left, only_right, unequal): numbers on one side only; unequal if they are more than two."""
    g = rows.groupBy("case").agg(F.array_sort(F.collect_set(F.when(F.col("side") == "L", F.col(number)))).alias("l"), F.array_sort(F.collect_set(F.when(F.col("side") == "R", F.col(number)))).alias("r"))
    out = g.select("case", F.array_except("l", "r").alias("only_left"), F.array_except("r", "l").alias("only_right"))
    return out.withColumn("unequal", F.size("only_left") + F.size("only_right") > 2)


def structure(rows: DataFrame, number: str) -> DataFrame:
    """(case, n, gap, doubled): numbers missing between the first and last, and numbers that occur twice."""
    g = rows.groupBy("case").agg(F.count_distinct(number).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.count(F.lit(1)).alias("all"))
    return g.select("case", "n", (F.col("hi") - F.col("lo") + 1 - F.col("n")).alias("gap"), (F.col("all") - F.col("n")).alias("doubled"))
