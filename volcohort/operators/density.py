"""Labels against density (case_id, k, j, i, hu), shapes fitted to labels, and errors near surfaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.operators.morphology import dilate, erode
from volcohort.operators.storage import dealt, staged
from volcohort.operators.voxel import AT, beside, component_sizes, components

BONE = 200


def bone_percent(voxels: DataFrame, hu: DataFrame, bone: int = BONE) -> DataFrame:
    """(case_id, label, voxels, percent) of a label's voxels above a density."""
    v = voxels.where("label <> 0").join(hu, AT)
    return v.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("voxels"), F.round(100 * F.count_if(F.col("hu") > bone) / F.count(F.lit(1)), 1).alias("percent"))


def leaks(voxels: DataFrame, hu: DataFrame, bone: int = BONE, soft: int = -50) -> DataFrame:
    """(case_id, off_bone, background, missed): shares of labelled voxels under bone density and under that of soft tissue, and of
    bone that no label covers."""
    v = hu.join(voxels.where("label <> 0").select(*AT, F.lit(True).alias("_in")), AT, "left")
    inside = F.col("_in").isNotNull()
    n, b = F.count_if(inside), F.count_if(F.col("hu") > bone)
    return v.groupBy("case_id").agg(
        F.round(F.count_if(inside & (F.col("hu") <= bone)) / F.nullif(n, F.lit(0)), 9).alias("off_bone"), F.round(F.count_if(inside & (F.col("hu") < soft)) / F.nullif(n, F.lit(0)), 9).alias("background"),
        F.round(F.count_if(~inside & (F.col("hu") > bone)) / F.nullif(b, F.lit(0)), 9).alias("missed"),
    )


def calibrated(voxels: DataFrame, hu: DataFrame, share: float = 0.10) -> DataFrame:
    """(case_id, threshold): a percentile of the density under the mask shrunk by one; under the whole mask where nothing is left.
    Each density counts as often as its place is in the mask; a window by place finds that, without a shuffle if volumes lie by case."""
    mask = voxels.where("label <> 0").withColumn("label", F.lit(1))
    row = lambda d, hu, **n: d.where(" and ".join(f"{c} is not null" for c in AT)).select(*AT, hu.alias("hu"), *[F.lit(n.get(c, 0)).alias(c) for c in ("_hu", "_all", "_core")])
    none = F.lit(None).cast(hu.schema["hu"].dataType)
    rows = row(hu, F.col("hu"), _hu=1).union(row(mask, none, _all=1)).union(row(erode(mask), none, _core=1))
    w = Window.partitionBy(*AT)
    rows = rows.select("case_id", "hu", "_hu", *[F.sum(c).over(w).alias(c) for c in ("_all", "_core")]).where("_hu = 1 and _all > 0")
    of = lambda n: F.percentile("hu", F.lit(share), F.col(n))
    return rows.groupBy("case_id").agg(F.coalesce(of("_core"), of("_all")).alias("threshold"))


def profile(voxels: DataFrame) -> DataFrame:
    """(case_id, label, k0, k1, slices)."""
    return voxels.where("label <> 0").groupBy("case_id", "label").agg(F.min("k").alias("k0"), F.max("k").alias("k1"), F.count_distinct("k").alias("slices"))


def boundary_share(truth: DataFrame, pred: DataFrame, label: int, band: int = 1) -> DataFrame:
    """(case_id, errors, near, share): voxels of a label that differ, and those within `band` steps of the truth's surface."""
    t = truth.where(F.col("label") == label).select(*AT, "label")
    one = lambda d, name: d.select(*AT, F.lit(True).alias(name))
    m = beside(one(t, "_t"), one(pred.where(F.col("label") == label), "_p"), one(dilate(t, band), "_d"), one(erode(t, band), "_e"))
    near = F.col("_d").isNotNull() & F.col("_e").isNull()
    e = m.where(F.col("_t").isNull() != F.col("_p").isNull()).groupBy("case_id")
    return e.agg(F.count(F.lit(1)).alias("errors"), F.count_if(near).alias("near"), F.round(F.count_if(near) / F.count(F.lit(1)), 9).alias("share"))


def bright_objects(voxels: DataFrame, hu: DataFrame, bright: int = 1800, reach: int = 2, least: int = 40) -> DataFrame:
    """(case_id, component, voxels, touched): parts brighter than bone within `reach` steps of a label, and the labels there."""
    near = staged(dilate(voxels, reach).select(*AT, F.col("label").alias("_l")), "near")  # read twice
    lit = hu.where(F.col("hu") > bright).join(near, AT).withColumn("label", F.lit(1))
    parts = components(lit.select(*AT, "label"))
    big = component_sizes(parts).where(F.col("voxels") >= least).drop("label").hint("merge")
    labels = parts.join(near, AT).groupBy("case_id", "component").agg(F.array_sort(F.collect_set("_l")).alias("touched"))
    return big.join(labels, ["case_id", "component"])


SPHERE = "case_id int, label int, k double, j double, i double, radius double, points int"


def fit_spheres(points: DataFrame, rounds: int = 5, keep: float = 0.9) -> DataFrame:
    """A sphere for each label's surface voxels (case_id, label, k, j, i), least squares with the worst tenth left out again and
    again. A label's surface is what one task holds."""

    def solve(x: np.ndarray) -> tuple[np.ndarray, float]:
        a = np.column_stack([2 * x, np.ones(len(x))])
        s, *_ = np.linalg.lstsq(a, (x * x).sum(axis=1), rcond=None)
        return s[:3], float(np.sqrt(max(0.0, s[3] + s[:3] @ s[:3])))

    def run(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values(["k", "j", "i"])
        x = d[["k", "j", "i"]].to_numpy(float)
        if len(x) < 8:
            return pd.DataFrame([], columns=["case_id", "label", "k", "j", "i", "radius", "points"])
        mid, r = solve(x)
        for _ in range(rounds):
            off = np.abs(np.linalg.norm(x - mid, axis=1) - r)
            used = off <= np.quantile(off, keep)
            mid, r = solve(x[used])
        return pd.DataFrame([(d["case_id"].iloc[0], d["label"].iloc[0], *mid, r, int(used.sum()))], columns=["case_id", "label", "k", "j", "i", "radius", "points"])

    return dealt(points, "case_id", "label").groupBy("case_id", "label").applyInPandas(run, SPHERE)


def planes(points: DataFrame) -> DataFrame:
    """(case_id, label, centre, normal): the plane of least squares through each label's points. Moments are summed in Spark; the
    normal is the axis of least spread, turned so that its first number isn't negative."""
    names = "kji"
    sums = [F.sum(F.col(c).cast("double")).alias(f"s{c}") for c in names]
    cross = [F.sum(F.col(a).cast("double") * F.col(b)).alias(f"c{a}{b}") for n, a in enumerate(names) for b in names[n:]]
    m = points.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("n"), *sums, *cross)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows = []
            for r in d.to_dict("records"):
                mean = np.array([r[f"s{c}"] for c in names]) / r["n"]
                raw = np.array([[r[f"c{min(a, b, key=names.index)}{max(a, b, key=names.index)}"] for b in names] for a in names]) / r["n"]
                normal = np.linalg.eigh(raw - np.outer(mean, mean))[1][:, 0]
                first = normal[np.flatnonzero(np.abs(normal) > 1e-9)[0]]
                rows.append((r["case_id"], r["label"], mean.tolist(), (normal * np.sign(first)).tolist()))
            yield pd.DataFrame(rows, columns=["case_id", "label", "centre", "normal"])

    return m.mapInPandas(run, "case_id int, label int, centre array<double>, normal array<double>")


def longest_extent(voxels: DataFrame, sample: int = 300) -> DataFrame:
    """(case_id, label, extent): the greatest distance among every n-th voxel of a label, at most 2 * sample of them."""
    w = Window.partitionBy("case_id", "label")
    v = voxels.where("label <> 0").withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_r", F.row_number().over(w.orderBy("k", "j", "i")) - 1)
    p = v.where(F.col("_r") % F.greatest(F.lit(1), F.floor(F.col("_n") / sample)) == 0).select("case_id", "label", "k", "j", "i", "_r")
    q = p.select("case_id", "label", *[F.col(c).alias(f"q{c}") for c in "kji"], F.col("_r").alias("_q"))
    far = sum((F.pow(F.col(c) - F.col(f"q{c}"), F.lit(2)) for c in "kji"), F.lit(0.0))
    return p.join(q, ["case_id", "label"]).where("_r <= _q").groupBy("case_id", "label").agg(F.round(F.sqrt(F.max(far)), 6).alias("extent"))
