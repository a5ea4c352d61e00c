"""Predicted labels refined by density: bone near a prediction is kept, grown into or shared out by connected parts.

v1 is the label made by hand, v2 the one a model completed, both voxels (case_id, k, j, i, label); hu (case_id, k, j, i, hu) is the
density on the whole grid. Classes are 1 to 9, what was made by hand is the guide for the threshold of bone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.operators.density import calibrated
from volcohort.operators.distance import nearest
from volcohort.operators.morphology import fill_slices
from volcohort.operators.storage import staged
from volcohort.operators.voxel import AT, FACES, _moved, components

# The classes that may be refined.
CLASSES = (1, 9)


def spread(seed: DataFrame, mask: DataFrame, steps: int) -> DataFrame:
    """`seed` (AT, label) grown through the places of `mask` along faces, each label by itself: a place may get several. Only the
    front of each step is moved; it is written, so plans don't grow with the steps."""
    cur = front = seed.select(*AT, "label").distinct()
    where = mask.select(*AT).distinct()
    for _ in range(steps):
        front = staged(_moved(front, FACES, "label").distinct().join(where, AT, "left_semi").join(cur.hint("merge"), [*AT, "label"], "left_anti"), "refine")
        cur = cur.union(front)
    return cur


def solid(voxels: DataFrame) -> DataFrame:
    """Labels with the holes of their slices filled, along k, then j, then i; a place may get several labels. Each step reads the
    one before several times, so it is written."""
    cur = staged(voxels.select(*AT, "label"), "refine")
    for axis in "kji":
        cur = staged(cur.union(fill_slices(cur, axis).select(*AT, "label")).distinct(), "refine")
    return cur


def nearest_class(places: DataFrame, labels: DataFrame, grids: DataFrame | None = None) -> DataFrame:
    """`places` (AT) with the label of the nearest voxel of `labels` in the case; of labels equally far the smallest."""
    classes = labels.select("case_id", "label").distinct()
    every = places.select(*AT).distinct().join(classes, "case_id")
    if grids is None:
        grids = classes.select("case_id", *[F.lit(1.0).alias(f"s{c}") for c in "kji"]).limit(0)
    far = nearest(every, labels.select("case_id", "label", "k", "j", "i"), grids, ["case_id", "label"])
    return far.groupBy(*AT).agg(F.min(F.struct(F.round("distance", 9).alias("d"), "label")).alias("_m")).select(*AT, F.col("_m.label").alias("label"))


def compete(pred: DataFrame, bone: DataFrame, purity: float = 0.15, bleed: int = 50, grow: int = 0, fill: bool = True) -> tuple[DataFrame, DataFrame]:
    """(labels, flags). A connected part of bone whose predicted voxels are of one class but for a share of `purity`, or `bleed`
    voxels, goes to that class (of equal ones the smallest) wherever it was predicted, and `grow` steps beyond within the part.
    Other parts keep the prediction and are flagged: (case_id, dominant, classes, minority, voxels, k, j, i), classes as (label, n)."""
    parts = components(bone.select(*AT, F.lit(1).alias("label")), FACES).select(*AT, "component")
    both = staged(parts.join(pred.select(*AT, "label"), AT), "refine")
    n = both.groupBy("case_id", "component", "label").agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy("case_id", "component").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("m"), F.sum("n").alias("voxels"), F.array_sort(F.collect_list(F.struct("label", "n"))).alias("classes"))
    minor = F.col("voxels") - F.col("m.n")
    top = staged(top.select("case_id", "component", (-F.col("m.l")).alias("dominant"), "voxels", "classes", (minor / F.col("voxels")).alias("share"), minor.alias("minor")), "refine")
    sure = (F.col("share") <= purity) | (F.col("minor") <= bleed)
    certain, open_ = top.where(sure).select("case_id", "component", "dominant"), top.where(~sure)
    seed = both.join(certain, ["case_id", "component"]).select(*AT, F.col("dominant").alias("label"))
    won = spread(seed, parts.join(certain, ["case_id", "component"], "left_semi"), grow)
    out = won.union(both.join(open_, ["case_id", "component"], "left_semi").select(*AT, "label"))
    if fill:
        holes = solid(out).join(out.select(*AT), AT, "left_anti").groupBy(*AT).agg(F.min("label").alias("label"))
        out = out.union(holes)
    mid = parts.join(open_, ["case_id", "component"], "left_semi").groupBy("case_id", "component").agg(*[F.bround(F.avg(c), 0).cast("int").alias(c) for c in "kji"])
    flags = open_.join(mid, ["case_id", "component"]).select("case_id", "dominant", "classes", F.round("share", 3).alias("minority"), "voxels", "k", "j", "i")
    return out, flags


def _cells(hand: DataFrame, v2: DataFrame, hu: DataFrame, thr: DataFrame) -> DataFrame:
    """(AT, label, threshold, _pred, _bone, _rest): predicted voxels of cases with a threshold and places of bone, both outside of what
    was made by hand, and the other voxels of v2. A window by place tells what else is there, without a shuffle if volumes lie by
    case; a missing place is at no other."""
    of = lambda d, kind, label, density: d.select(*AT, label.cast(v2.schema["label"].dataType).alias("label"), density.cast(hu.schema["hu"].dataType).alias("hu"), F.lit(kind).alias("_kind"))
    none, label, kind = F.lit(None), F.col("label"), F.col("_kind")
    rows = of(hand, "hand", none, none).union(of(v2.where("label <> 0"), "v2", label, none)).union(of(hu, "hu", none, F.col("hu")))
    known, w = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in AT]), Window.partitionBy(*AT)
    in_class = (kind == "v2") & label.between(*CLASSES)
    rows = rows.select("*", (known & F.bool_or(kind == "hand").over(w)).alias("_hand"), (known & F.bool_or(in_class).over(w)).alias("_class"))
    rows = rows.where((kind == "v2") | ((kind == "hu") & ~F.col("_hand")))
    predicted = v2.where(label.between(*CLASSES)).select("case_id").distinct().hint("merge")
    held = rows.join(thr.join(predicted, "case_id", "left_semi").hint("merge"), "case_id", "left")
    free = ~F.col("_hand") & F.col("threshold").isNotNull()
    bone = (kind == "hu") & F.coalesce(F.col("hu") >= F.col("threshold"), F.lit(False))
    out = held.select(*AT, "label", "threshold", (in_class & free).alias("_pred"), bone.alias("_bone"), ((kind == "v2") & ~(F.col("_class") & free)).alias("_rest"))
    return out.where("_pred or _bone or _rest")


def refined(
    v1: DataFrame, v2: DataFrame, hu: DataFrame, mode: str = "clip", percentile: float = 10.0, fill: bool = True, grow: int = 0, purity: float = 0.15, bleed: int = 50, floor: float = 0.0,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(voxels, thresholds, flags). The threshold of bone is a percentile of the density inside what was made by hand, `floor` at
    least; cases without any, or without a prediction, keep v2 and have no threshold. What was made by hand stays.

    mode clip keeps predicted bone, and `grow` steps through bone around it; resegment all connected bone that a prediction meets,
    named by the nearest one; compete shares out connected bone (see `compete`, which alone makes flags). fill: with the holes."""
    hand = v1.where(F.col("label").between(*CLASSES)).select(*AT, "label")
    thr = calibrated(hand, hu, percentile / 100).where("threshold is not null")
    thr = thr.select("case_id", F.greatest("threshold", F.lit(float(floor))).alias("threshold")) if floor else thr
    cells = staged(_cells(hand, v2, hu, staged(thr, "refine")), "refine")
    pred, bone = cells.where("_pred").select(*AT, "label"), cells.where("_bone").select(*AT)
    thr = cells.where("_pred").select("case_id", "threshold").distinct()
    flags = None
    if mode == "compete":
        new, flags = compete(pred, bone, purity, bleed, grow, fill)
    elif mode == "clip" and grow > 0:
        reach = spread(pred.join(bone, AT, "left_semi"), bone, grow)
        reach = solid(reach).join(hand.select(*AT), AT, "left_anti") if fill else reach
        new = nearest_class(reach, pred)
    elif mode == "clip":
        new = pred.join(bone, AT, "left_semi")
        new = solid(new).join(pred, [*AT, "label"], "left_semi") if fill else new
    elif mode == "resegment":
        parts = components(bone.select(*AT, F.lit(1).alias("label")), FACES)
        met = parts.join(pred.select(*AT), AT).select("case_id", "component").distinct()
        kept = parts.join(met, ["case_id", "component"], "left_semi").select(*AT, "label")
        kept = solid(kept).join(hand.select(*AT), AT, "left_anti") if fill else kept
        new = nearest_class(kept, pred)
    else:
        raise ValueError(f"no such mode: {mode}")
    new = staged(new.select(*AT, "label"), "refine")
    rest = cells.where("_rest").select(*AT, "label").join(new.select(*AT), AT, "left_anti")
    return rest.union(new.select(*AT, "label")), thr, flags
