"""Morphology of voxel rows: growing, shrinking, filling, principal axes, moves between labels and points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.operators.storage import dealt
from volcohort.operators.voxel import AT, FACES, box, components, with_neighbours


def dilate(voxels: DataFrame, steps: int = 1, reach: list[tuple[int, int, int]] = FACES) -> DataFrame:
    """Labels grown into the background; where two meet, the smaller wins. Own voxels stay."""
    cur = voxels.where("label <> 0").select(*AT, "label")
    for _ in range(steps):
        own = F.min(F.when(F.col("_own"), F.col("label")))
        cur = with_neighbours(cur, reach).groupBy(*AT).agg(F.coalesce(own, F.min("label")).alias("label"))
    return cur


def erode(voxels: DataFrame, steps: int = 1, reach: list[tuple[int, int, int]] = FACES) -> DataFrame:
    """Voxels all of whose neighbours have their label."""
    cur = voxels.where("label <> 0").select(*AT, "label")
    for _ in range(steps):
        n = with_neighbours(cur, reach).groupBy(*AT, "label").agg(F.bool_or("_own").alias("_own"), F.count(F.lit(1)).alias("_n"))
        cur = n.where(F.col("_own") & (F.col("_n") == len(reach) + 1)).select(*AT, "label")
    return cur


def fill_slices(voxels: DataFrame, axis: str = "k") -> DataFrame:
    """Holes of each slice along `axis`: background of a label's box that doesn't reach the box's rim. (case_id, k, j, i, label).

    Before the first voxel of a line and after its last the background reaches the rim, so holes lie in gaps between two voxels of a
    line, and a gap is open where a line beside it doesn't reach as far. Only gaps are exploded to places, never whole boxes."""
    along = "j" if axis == "i" else "i"
    across = next(n for n in "kj" if n not in (axis, along))
    line = ("case_id", "label", axis, across)
    v = voxels.where("label <> 0").where("k is not null and j is not null and i is not null")
    case = F.struct("case_id", "label").alias("case_id")  # equal to itself in joins, also if the case is missing

    after = F.lead(along).over(Window.partitionBy(*line).orderBy(along))
    gaps = v.select(*line, along, after.alias("_after")).where(F.col("_after") - F.col(along) > 1)
    gaps = gaps.select(case, axis, across, (F.col(along) + 1).alias("_from"), (F.col("_after") - 1).alias("_to"))
    # Few rows, exploded to many: dealt by what components needs together, so that the places aren't shuffled again.
    empty = dealt(gaps, "case_id", "k").withColumn(along, F.explode(F.sequence("_from", "_to"))).withColumn("label", F.lit(1))
    flat = [t for t in FACES if t["kji".index(axis)] == 0]
    parts = components(empty.select(*AT, "label"), flat)

    # Lines with one on either side, and how far both reach.
    lo, hi, w = f"{along}0", f"{along}1", Window.partitionBy("case_id", "label", axis).orderBy(across)
    lines = box(v, 0, line).select(*line, lo, hi, *[f(c).over(w).alias(f"{n}_{c}") for n, f in (("before", F.lag), ("after", F.lead)) for c in (across, lo, hi)])
    lines = lines.where((F.col(f"before_{across}") == F.col(across) - 1) & (F.col(f"after_{across}") == F.col(across) + 1) & (F.col(axis) >= 0) & (F.col(across) >= 0))
    lines = lines.select(case, axis, across, F.greatest(f"before_{lo}", f"after_{lo}").alias("_lo"), F.least(f"before_{hi}", f"after_{hi}").alias("_hi"))

    # Joins lose the hint of their tables.
    inside = parts.join(lines.hint("merge"), ["case_id", axis, across], "left").withColumn("_in", F.coalesce(F.col(along).between(F.col("_lo"), F.col("_hi")), F.lit(False)))
    shut = inside.groupBy("case_id", "component").agg(F.bool_and("_in").alias("_shut")).where("_shut").hint("merge")
    holes = parts.join(shut, ["case_id", "component"], "left_semi")
    return holes.select(F.col("case_id.case_id").alias("case_id"), "k", "j", "i", F.col("case_id.label").alias("label"))


AXES = "case_id int, label int, voxels long, length double, width double, depth double, elongation double"


def principal_axes(voxels: DataFrame) -> DataFrame:
    """Extents (standard deviations along the principal axes, longest first) of each label. The moments are sums in Spark; only
    3 x 3 matrices reach Python."""
    names = "kji"
    sums = [F.sum(F.col(c).cast("double")).alias(f"s{c}") for c in names]
    cross = [F.sum(F.col(a).cast("double") * F.col(b)).alias(f"c{a}{b}") for n, a in enumerate(names) for b in names[n:]]
    m = voxels.where("label <> 0").groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("voxels"), *sums, *cross)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows = []
            for r in d.to_dict("records"):
                mean = np.array([r[f"s{c}"] for c in names]) / r["voxels"]
                cov = np.array([[r[f"c{min(a, b, key=names.index)}{max(a, b, key=names.index)}"] for b in names] for a in names]) / r["voxels"] - np.outer(mean, mean)
                x = np.sqrt(np.clip(np.linalg.eigvalsh(cov)[::-1], 0, None))
                rows.append((r["case_id"], r["label"], r["voxels"], *x, x[0] / x[1] if x[1] > 0 else None))
            yield pd.DataFrame(rows, columns=["case_id", "label", "voxels", "length", "width", "depth", "elongation"])

    return m.mapInPandas(run, AXES)


def centroids(voxels: DataFrame) -> DataFrame:
    """(case_id, label, k, j, i): means over the voxels of each label."""
    return voxels.where("label <> 0").groupBy("case_id", "label").agg(*[F.avg(c).alias(c) for c in "kji"])


def clipped(voxels: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(case_id, label) of labels that touch the first or last slice."""
    return voxels.where("label <> 0").where((F.col("k") == 0) | (F.col("k") == shape[0] - 1)).select("case_id", "label").distinct()


def most_overlap(parts: DataFrame, grown: DataFrame) -> DataFrame:
    """(case_id, component, label, n): the grown label that covers most of each component; ties go to the smaller."""
    c = parts.select(*AT, "component").join(grown.select(*AT, F.col("label").alias("_l")), AT)
    n = c.groupBy("case_id", "component", "_l").agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy("case_id", "component").agg(F.max(F.struct("n", (-F.col("_l")).alias("l"))).alias("m"))
    return top.select("case_id", "component", (-F.col("m.l")).alias("label"), F.col("m.n").alias("n"))


def stray_parts(parts: DataFrame, least: int, share: float) -> DataFrame:
    """(case_id, label, component, voxels): components under the greater of `least` and `share` of their label's largest."""
    s = parts.groupBy("case_id", "label", "component").agg(F.count(F.lit(1)).alias("voxels"))
    top = s.groupBy("case_id", "label").agg(F.max("voxels").alias("_m"))
    return s.join(top, ["case_id", "label"]).where(F.col("voxels") < F.greatest(F.lit(least), share * F.col("_m"))).drop("_m")


def thin(voxels: DataFrame, stride: int) -> DataFrame:
    """Every stride-th voxel along each axis, on the coarser grid."""
    on = (F.col("k") % stride == 0) & (F.col("j") % stride == 0) & (F.col("i") % stride == 0)
    return voxels.where(on).select("case_id", *[(F.col(c) / stride).cast("int").alias(c) for c in "kji"], "label")


def lateralize(voxels: DataFrame, label: int, right: int, midline: Column) -> DataFrame:
    """The voxels of a label beyond the midline become those of the right one."""
    return voxels.withColumn("label", F.when((F.col("label") == label) & (F.col("i") > midline), right).otherwise(F.col("label")))
