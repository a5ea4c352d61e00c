"""Labels moved onto another grid: by affines, by mirrors, by turns of the axes.

An affine (16 numbers, row by row) leads from the place (i, j, k) of a voxel to its place in space. grids: (case_id, affine, ni, nj,
nk). Labels go to the nearest voxel; what comes from outside is background and has no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.functions.geometry import inverse, world
from volcohort.operators.storage import dealt
from volcohort.operators.voxel import AT, remap

#: Voxels by which rounding may move the end of a box.
ROOM = 1e-3


def _rounded(c: Column) -> Column:
    """To the nearest whole number, halves up."""
    return F.floor(c + 0.5).cast("int")


def _mapped(places: DataFrame, through: Column) -> DataFrame:
    """`places` with (ti, tj, tk), their place under an affine."""
    p = places.withColumn("_p", world(through, F.col("i"), F.col("j"), F.col("k")))
    return p.select("*", *[F.get("_p", F.lit(n)).alias(f"t{c}") for n, c in enumerate("ijk")]).drop("_p")


def resampled(moving: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """`moving` (case_id, k, j, i, label) on the grid of `target`. Only target voxels whose middle lies in the labelled box of a case are
    tried: the corners of its voxels, mapped, bound them, with room for rounding; each looks up one source voxel in an equi-join."""
    held = moving.where("label <> 0").select(*AT, "label")
    own = source.select("case_id", F.col("affine").alias("_s")).join(target.select("case_id", F.col("affine").alias("_t"), "ni", "nj", "nk").hint("merge"), "case_id")
    own = own.select("case_id", "ni", "nj", "nk", inverse(F.col("_s")).alias("_to"), "_t", inverse(F.col("_t")).alias("_back"), "_s").hint("merge")
    box = held.groupBy("case_id").agg(*[f for c in "ijk" for f in ((F.min(c) - 0.5).alias(f"{c}0"), (F.max(c) + 0.5).alias(f"{c}1"))])
    corners = box.select("case_id", *[F.explode(F.array("i0", "i1")).alias("i")], "j0", "j1", "k0", "k1").select("case_id", "i", F.explode(F.array("j0", "j1")).alias("j"), "k0", "k1")
    corners = corners.select("case_id", "i", "j", F.explode(F.array("k0", "k1")).alias("k")).join(own, "case_id")
    out = _mapped(_mapped(corners, F.col("_s")).select("case_id", F.col("ti").alias("i"), F.col("tj").alias("j"), F.col("tk").alias("k"), "_back"), F.col("_back"))
    ends = out.groupBy("case_id").agg(*[f for c in "ijk" for f in (F.ceil(F.min(f"t{c}") - ROOM).alias(f"{c}0"), F.floor(F.max(f"t{c}") + ROOM).alias(f"{c}1"))]).join(own, "case_id")
    ends = dealt(ends, "case_id", "i0")  # few rows, exploded to many; dealt by the case alone they would stay where they are
    for c in "kji":
        low, high = F.greatest(F.lit(0).cast("long"), F.col(f"{c}0")), F.least(F.col(f"n{c}").cast("long") - 1, F.col(f"{c}1"))
        ends = ends.withColumn(c, F.explode(F.when(low <= high, F.sequence(low, high)))).withColumn(c, F.col(c).cast("int"))
    places = _mapped(ends.select(*AT, "_t", "_to"), F.col("_t")).select(*[F.col(c).alias(f"_{c}") for c in "kji"], "case_id", "_to", F.col("ti").alias("i"), F.col("tj").alias("j"), F.col("tk").alias("k"))
    found = _mapped(places, F.col("_to")).select("case_id", "_k", "_j", "_i", *[_rounded(F.col(f"t{c}")).alias(c) for c in "kji"])
    return found.join(held, AT).select("case_id", *[F.col(f"_{c}").alias(c) for c in "kji"], "label")


def resampled_runs(moving: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Runs (case_id, k, j, i0, i1, label) on the grid of `target`, for affines without turns or shears: each axis has its own table
    of target and source places, so that a run is looked up by its line and cut along i by arithmetic."""
    of = lambda g, p: g.select("case_id", *[F.get("affine", F.lit(5 * n)).alias(f"{p}m{c}") for n, c in enumerate("ijk")], *[F.get("affine", F.lit(4 * n + 3)).alias(f"{p}o{c}") for n, c in enumerate("ijk")])
    both = of(source, "s").join(of(target, "t").join(target.select("case_id", "ni", "nj", "nk"), "case_id"), "case_id")
    # The source place of target place x is rate * x + shift.
    axes = both.select("case_id", "ni", *[e for c in "ijk" for e in ((F.col(f"tm{c}") / F.col(f"sm{c}")).alias(f"r{c}"), ((F.col(f"to{c}") - F.col(f"so{c}")) / F.col(f"sm{c}")).alias(f"h{c}"))], "nj", "nk")
    r = moving.where("label <> 0")
    for c in "kj":
        steps = axes.select("case_id", f"r{c}", f"h{c}", F.explode(F.sequence(F.lit(0), F.col(f"n{c}") - 1)).alias(f"_t{c}"))
        r = r.join(steps.select("case_id", f"_t{c}", _rounded(F.col(f"r{c}") * F.col(f"_t{c}") + F.col(f"h{c}")).alias(c)), ["case_id", c])
    r = r.join(axes.select("case_id", "ni", "ri", "hi"), "case_id")
    # floor(rate * x + shift + 0.5) lies in [i0, i1]; a negative rate turns the run.
    a, b = (F.col("i0") - 0.5 - F.col("hi")) / F.col("ri"), (F.col("i1") + 0.5 - F.col("hi")) / F.col("ri")
    low = F.when(F.col("ri") > 0, F.ceil(a)).otherwise(F.floor(b) + 1)
    high = F.when(F.col("ri") > 0, F.ceil(b) - 1).otherwise(F.floor(a))
    r = r.select("case_id", F.col("_tk").alias("k"), F.col("_tj").alias("j"), F.greatest(low, F.lit(0)).cast("int").alias("i0"), F.least(high, F.col("ni") - 1).cast("int").alias("i1"), "label")
    return r.where("i0 <= i1")


def resampled_and_remapped(moving: DataFrame, source: DataFrame, target: DataFrame, table: dict[int, int]) -> DataFrame:
    """A prediction on the grid of its reference, in the reference's classes; labels that aren't in the table are background."""
    return remap(resampled(moving, source, target), table, F.lit(0)).where("label <> 0")


def mirrored(voxels: DataFrame, grids: DataFrame, axis: int, plane: Column) -> DataFrame:
    """Labels mirrored in space at the plane where axis (0 x, 1 y, 2 z) is `plane`, a column of grids, on their own grid."""
    turn = lambda a: F.transform(a, lambda x, n: F.when(F.floor(n / 4) == axis, F.when(n % 4 == 3, 2 * plane - x).otherwise(-x)).otherwise(x))
    return resampled(voxels, grids.withColumn("affine", turn(F.col("affine"))), grids)


# Letters of the directions of space, as (axis, sign).
LETTERS = {"R": (0, 1), "L": (0, -1), "A": (1, 1), "P": (1, -1), "S": (2, 1), "I": (2, -1)}


def reoriented(voxels: DataFrame, grids: DataFrame, codes: str = "PIR") -> tuple[DataFrame, DataFrame]:
    """(voxels, grids) with array axes i, j, k in the directions of three letters: axes are swapped and turned, nothing is resampled.
    An array axis belongs to the direction of space along which it is longest, the axis of the greatest cosine first."""
    axis = lambda c: [F.get("affine", F.lit(4 * r + c)) for r in range(3)]
    cosine = lambda r, c: F.abs(axis(c)[r]) / F.sqrt(sum((x * x for x in axis(c)), F.lit(0.0)))
    orders = [(a, b, 3 - a - b) for a in range(3) for b in range(3) if a != b]
    # Of the six ways to give each array axis its own direction, that of the greatest cosines.
    best = F.array_max(F.array(*[F.struct(F.round(sum((cosine(p[c], c) for c in range(3)), F.lit(0.0)), 9).alias("s"), F.lit(-n).alias("n"), F.array(*[F.lit(x) for x in p]).alias("p")) for n, p in enumerate(orders)]))
    g = grids.withColumn("_p", best["p"]).withColumn("_n", F.array("ni", "nj", "nk"))
    put, shape, columns, origin = {}, [], [[], [], []], [F.get("affine", F.lit(4 * r + 3)) for r in range(3)]
    for n, (space, sign) in enumerate(LETTERS[x] for x in codes):
        c = F.array_position("_p", space).cast("int") - 1  # the array axis that runs along it
        along = F.get("affine", (F.lit(4 * space) + c).cast("int")) * sign > 0
        size = F.get("_n", c)
        put["ijk"[n]] = (c, along, size)
        shape.append(size)
        for r in range(3):
            x = F.get("affine", (F.lit(4 * r) + c).cast("int"))
            columns[r].append(F.when(along, x).otherwise(-x))
            origin[r] = origin[r] + F.when(along, 0.0).otherwise(x * (size - 1))
    affine = F.array(*[x for r in range(3) for x in (*columns[r], origin[r])], *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])
    moves = g.select("case_id", *[e for k, (c, along, size) in put.items() for e in (c.alias(f"_c{k}"), along.alias(f"_a{k}"), size.alias(f"_n{k}"))])
    out = voxels.join(moves, "case_id")
    own = F.array("i", "j", "k")
    new = [F.when(F.col(f"_a{k}"), F.get(own, F.col(f"_c{k}"))).otherwise(F.col(f"_n{k}") - 1 - F.get(own, F.col(f"_c{k}"))).cast("int").alias(k) for k in "kji"]
    return out.select("case_id", *new, "label"), g.select("case_id", affine.alias("affine"), *[s.alias(f"n{c}") for c, s in zip("ijk", shape, strict=True)])
