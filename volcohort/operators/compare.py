"""Two labelings of one volume: agreement, conflicts, edits that are allowed, and the border between two regions.

All measures come from one table of (case, label of a, label of b, voxels), which is small however large the volumes are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.operators.storage import staged
from volcohort.operators.voxel import AT, FACES, beside, component_sizes, components, merged_beside, settle_conflicts, three_way, without_specks

IGNORE = 255
# Fixed values of the label scheme: bones of spine, pelvis and legs; thoracic vertebrae; ribs; the classes at the border of lumbar spine and sacrum.
BONES, THORACIC, RIBS = (1, 33), (8, 19), (34, 57)
L5, L6, SACRUM = 5, 6, 7
BORDER = (L5, L6, SACRUM)


def side_by_side(a: DataFrame, b: DataFrame, *more: DataFrame) -> DataFrame:
    """(case, k, j, i, a, b, ...): labels at each place, background (0) where a table has no row. Later ones are c, d."""
    out = beside(*[v.select(*AT, F.col("label").alias(name)) for name, v in zip("abcd", (a, b, *more), strict=False)])
    return out.fillna(0, [c for c in out.columns if c not in AT])


def cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """(case_id, a, b, n)."""
    return side_by_side(a, b).groupBy("case_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def overlaps(cell: DataFrame) -> DataFrame:
    """(case_id, label, na, nb, both, only_a, only_b): voxels of each label; only_a are those of a where b is background."""
    each = cell.select("*", F.explode(F.array_distinct(F.array("a", "b"))).alias("label")).where(~F.col("label").isin(0, IGNORE))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    is_a, is_b = F.col("a") == F.col("label"), F.col("b") == F.col("label")
    return each.groupBy("case_id", "label").agg(
        total(is_a).alias("na"), total(is_b).alias("nb"), total(is_a & is_b).alias("both"), total(is_a & (F.col("b") == 0)).alias("only_a"), total(is_b & (F.col("a") == 0)).alias("only_b")
    )


def classes_present(*volumes: DataFrame) -> DataFrame:
    """(case_id, label) in any of the volumes, without background and what is to be ignored."""
    out = None
    for v in volumes:
        part = v.select("case_id", "label")
        out = part if out is None else out.union(part)
    return out.where(~F.col("label").isin(0, IGNORE)).distinct()


def agreement(a: DataFrame, b: DataFrame, tau: float, overall: bool = False) -> DataFrame:
    """(case_id, metric, worst, agree): agreement of two reviewers by the worst Dice of a class, or by that of the whole
    foreground; 1 if neither has any."""
    return agreement_of_cells(staged(cells(a, b), "cells"), tau, overall)


def agreement_of_cells(cell: DataFrame, tau: float, overall: bool = False) -> DataFrame:
    """`agreement` from the table of `cells`, which it reads twice."""
    worst = overlaps(cell).groupBy("case_id").agg(F.min(2 * F.col("both") / (F.col("na") + F.col("nb"))).alias("worst"))
    fore = lambda c: (F.col(c) > 0) & (F.col(c) != IGNORE)
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    whole = cell.groupBy("case_id").agg(total(fore("a")).alias("na"), total(fore("b")).alias("nb"), total(fore("a") & fore("b")).alias("both"))
    out = whole.join(worst, "case_id", "left").withColumn("worst", F.coalesce("worst", F.lit(1.0)))
    all_ = F.coalesce(2 * F.col("both") / F.nullif(F.col("na") + F.col("nb"), F.lit(0)), F.lit(1.0))
    out = out.withColumn("metric", all_ if overall else F.col("worst"))
    return out.select("case_id", "metric", "worst", (F.col("metric") >= tau).alias("agree"))


def disjoint_classes(cell: DataFrame, low: int = RIBS[0], high: int = RIBS[1]) -> DataFrame:
    """(case_id, label, kind): classes that one side has where the other hasn't any voxel of it. MISSING: at seven in ten of
    the voxels of the side that has more (of a, if equal) the other has background; else the number differs, RENUMBER."""
    o = overlaps(cell).where(F.col("label").between(low, high) & (F.col("both") == 0))
    empty = F.when(F.col("na") >= F.col("nb"), F.col("only_a") / F.col("na")).otherwise(F.col("only_b") / F.col("nb"))
    return o.select("case_id", "label", F.when(empty >= 0.7, "MISSING").otherwise("RENUMBER").alias("kind"))


def completeness(v: DataFrame) -> DataFrame:
    """(case_id, structures, voxels)."""
    return v.where("label > 0").groupBy("case_id").agg(F.count_distinct("label").alias("structures"), F.count(F.lit(1)).alias("voxels"))


def resolve_classes(merged: DataFrame, a: DataFrame, b: DataFrame, weights: DataFrame, gap: float = 1.5, also: tuple[str, ...] = ()) -> DataFrame:
    """`merged` (place, label, state), where open conflicts between two classes go to the side that is `gap` times as reliable.

    weights: (case_id, wa, wb), one where they are missing; other conflicts stay open (label NULL). also: other columns of `merged`
    that stay."""
    x, y = a.select(*AT, F.col("label").alias("_x")), b.select(*AT, F.col("label").alias("_y"))
    m = merged_beside(merged, also, x, y)
    m = m.join(weights.hint("merge"), "case_id", "left").fillna(0, ["_x", "_y"]).fillna(1.0, ["wa", "wb"])
    open_ = (F.col("state") == "conflict") & F.col("label").isNull() & (F.col("_x") != 0) & (F.col("_y") != 0)
    ratio = F.when(F.col("wb") != 0, F.col("wa") / F.col("wb")).otherwise(F.lit(float("inf")))
    sure = (ratio >= gap) | ((F.col("wa") != 0) & (ratio <= 1 / gap))
    winner = F.when(F.col("wa") >= F.col("wb"), F.col("_x")).otherwise(F.col("_y"))
    return m.select(*AT, F.when(open_ & F.coalesce(sure, F.lit(False)), winner).otherwise(F.col("label")).alias("label"), "state", *also)


def adjudicated(base: DataFrame, a: DataFrame, b: DataFrame, hu: DataFrame, checks: DataFrame, weights: DataFrame | None = None, specks: int = 40) -> tuple[DataFrame, DataFrame]:
    """(final, decisions): the layers of an automatic adjudication. The three-way merge comes first, then density decides between a
    label and background, weights (if any) between two classes, and small parts go. Open places keep the base's label.
    decisions: (case_id, open, qc_ok, decision); a case is finalized if nothing is open and its check (case_id, ok) passed."""
    merged = settle_conflicts(three_way(base, a, b), a, b, hu)
    merged = resolve_classes(merged, a, b, weights) if weights is not None else merged
    left = merged.where("label is null")
    held = merged.join(base.select(*AT, F.col("label").alias("_o")), AT, "left").select(*AT, F.coalesce("label", "_o", F.lit(0)).alias("label"))
    kept = without_specks(components(held, FACES), specks)
    cases = base.select("case_id").union(a.select("case_id")).union(b.select("case_id")).distinct()
    out = cases.join(left.groupBy("case_id").agg(F.count(F.lit(1)).alias("open")), "case_id", "left").join(checks.select("case_id", F.col("ok").alias("qc_ok")), "case_id", "left")
    out = out.fillna(0, ["open"]).withColumn("qc_ok", F.coalesce("qc_ok", F.lit(False)))
    return kept, out.withColumn("decision", F.when((F.col("open") == 0) & F.col("qc_ok"), "auto_finalize").otherwise("needs_manual"))


def untouched(given: DataFrame, edited: DataFrame, tolerance: int = 5000, split: DataFrame | None = None) -> DataFrame:
    """(case_id, changed, added, removed, ok): voxels of bones that an edit of ribs changed, and the labels it brought or took.
    A few at the edges are allowed; so is any change in a case (case_id) of `split`, whose given label was in doubt."""
    cell = cells(given, edited)
    bone = lambda c: F.col(c).between(*BONES)
    labels = lambda c: F.sort_array(F.collect_set(F.when(bone(c), F.col(c))))
    g = cell.groupBy("case_id").agg(F.sum(F.when((F.col("a") != F.col("b")) & (bone("a") | bone("b")), F.col("n")).otherwise(0)).alias("changed"), labels("a").alias("x"), labels("b").alias("y"))
    fine = F.col("changed") <= tolerance
    if split is not None:
        g = g.join(split.select("case_id", F.lit(True).alias("_s")).distinct(), "case_id", "left")
        fine = fine | F.coalesce("_s", F.lit(False))
    return g.select("case_id", "changed", F.array_except("y", "x").alias("added"), F.array_except("x", "y").alias("removed"), fine.alias("ok"))


def _forced(given: DataFrame, edited: DataFrame, label: Column) -> DataFrame:
    return side_by_side(given, edited).select(*AT, label.alias("label")).where("label <> 0")


def with_ribs_of(given: DataFrame, edited: DataFrame) -> DataFrame:
    """An edit of ribs on the given label: its own ribs go, those of the edit come where nothing else is."""
    rib = lambda c: F.col(c).between(*RIBS)
    under = F.when(rib("a"), 0).otherwise(F.col("a"))
    return _forced(given, edited, F.when((under == 0) & rib("b"), F.col("b")).otherwise(under))


def with_vertebrae_of(given: DataFrame, edited: DataFrame) -> DataFrame:
    """An edit that may only add thoracic vertebrae where the given label has nothing."""
    return _forced(given, edited, F.when((F.col("a") == 0) & F.col("b").between(*THORACIC), F.col("b")).otherwise(F.col("a")))


def with_bones_of(given: DataFrame, edited: DataFrame) -> DataFrame:
    """An edit of bones: ribs and soft tissue stay those of the given label."""
    soft = RIBS[0]
    return _forced(given, edited, F.when((F.col("a") >= soft) | (F.col("b") >= soft), F.col("a")).otherwise(F.col("b")))


def paste(full: DataFrame, crop: DataFrame, origin: DataFrame) -> DataFrame:
    """`full` with a crop written over it. crop: places within the crop, background included; origin: (case_id, k0, j0, i0)."""
    at = crop.join(origin, "case_id").select("case_id", *[(F.col(c) + F.col(f"{c}0")).alias(c) for c in "kji"], F.col("label").alias("_new"))
    return beside(full.select(*AT, "label"), at).select(*AT, F.coalesce("_new", "label").alias("label"))


def busiest_slices(a: DataFrame, b: DataFrame, axis: str = "k") -> DataFrame:
    """(case_id, axis, removed, added, relabelled): changes of each slice that has any, to be ordered by their sum."""
    m = side_by_side(a, b).where("a <> b")
    kind = F.when(F.col("b") == 0, 1).when(F.col("a") == 0, 2).otherwise(3)
    return m.groupBy("case_id", axis).agg(*[F.count_if(kind == n).alias(c) for n, c in ((1, "removed"), (2, "added"), (3, "relabelled"))])


def _border_window(truth: DataFrame, grids: DataFrame, window: float) -> DataFrame:
    """(case_id, centre, lo, hi): slices lo up to hi around the mean slice of L5, else around the last slice of the sacrum."""
    where = truth.groupBy("case_id").agg(F.bround(F.avg(F.when(F.col("label") == L5, F.col("k"))), 0).alias("m"), F.max(F.when(F.col("label") == SACRUM, F.col("k"))).alias("s"))
    centre = F.coalesce("m", "s").cast("int")
    half = F.ceil(F.lit(window / 2) / F.greatest(F.col("spacing").cast("double"), F.lit(0.1))).cast("int")
    held = where.where(centre.isNotNull()).join(grids.select("case_id", "spacing", "slices"), "case_id")
    return held.select("case_id", centre.alias("centre"), F.greatest(F.lit(0), centre - half).alias("lo"), F.least(F.col("slices").cast("int"), centre + half).alias("hi"))


def _border_cells(pred: DataFrame, truth: DataFrame, where: DataFrame) -> DataFrame:
    """(case_id, a, b, n): voxels by label of the truth and of the prediction within the window."""
    m = side_by_side(truth, pred).join(where, "case_id").where((F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi")))
    return m.groupBy("case_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def border_confusion(pred: DataFrame, truth: DataFrame, grids: DataFrame, window: float = 40.0) -> DataFrame:
    """(case_id, truth, pred, n): what the voxels of each class at the border became, background included."""
    cell = _border_cells(pred, truth, _border_window(truth, grids, window))
    return cell.where(F.col("a").isin(*BORDER)).select("case_id", F.col("a").alias("truth"), F.col("b").alias("pred"), "n")


def border(pred: DataFrame, truth: DataFrame, grids: DataFrame, window: float = 40.0) -> DataFrame:
    """(case_id, centre, lo, hi, voxels, dsc, error, l5_as_sacrum, sacrum_as_l5, has_l6): labels around the last lumbar vertebra.

    grids: (case_id, spacing of the slices, number of slices); cases that aren't in it, or have neither class in the truth, are
    left out. dsc is the mean over the classes of BORDER that either side has."""
    where = _border_window(truth, grids, window)
    cell = _border_cells(pred, truth, where)
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    a, b = F.col("a"), F.col("b")
    sums = {"voxels": total(a.isin(*BORDER)), "wrong": total(a.isin(*BORDER) & (a != b)), "l5": total(a == L5), "l5s": total((a == L5) & (b == SACRUM)), "s": total(a == SACRUM), "sl5": total((a == SACRUM) & (b == L5)), "l6": total(b == L6)}
    for c in BORDER:
        sums |= {f"x{c}": total(a == c), f"y{c}": total(b == c), f"z{c}": total((a == c) & (b == c))}
    g = cell.groupBy("case_id").agg(*[v.alias(k) for k, v in sums.items()])
    share = lambda x, y: F.round(F.col(x) / F.nullif(F.col(y), F.lit(0)), 4)
    dice = F.array_compact(F.array(*[2 * F.col(f"z{c}") / F.nullif(F.col(f"x{c}") + F.col(f"y{c}"), F.lit(0)) for c in BORDER]))
    dsc = F.when(F.size(dice) > 0, F.aggregate(dice, F.lit(0.0), lambda s, x: s + x) / F.size(dice))
    return where.join(g, "case_id").select(
        "case_id", "centre", "lo", "hi", "voxels", F.round(dsc, 4).alias("dsc"), share("wrong", "voxels").alias("error"),
        share("l5s", "l5").alias("l5_as_sacrum"), share("sl5", "s").alias("sacrum_as_l5"), (F.col("l6") > 0).alias("has_l6"),
    )


def border_summary(rows: DataFrame) -> DataFrame:
    """One row: means of `border` over the cases that have each measure."""
    mean = lambda c: F.round(F.avg(c), 4).alias(c)
    return rows.agg(F.count(F.lit(1)).alias("n"), *[mean(c) for c in ("dsc", "error", "l5_as_sacrum", "sacrum_as_l5")], F.count_if("has_l6").alias("with_l6"))


def doubled_ribs(parts: DataFrame, absolute: int, share: float, least: int = 1) -> DataFrame:
    """(case_id, label, pieces): ribs with a second large part, of `absolute` voxels and this share of the largest at least. parts:
    as of `components`; parts under `least` voxels don't count."""
    s = component_sizes(parts).where(F.col("label").between(*RIBS) & (F.col("voxels") >= least))
    top = s.groupBy("case_id", "label").agg(F.max("voxels").alias("_top"))
    big = s.join(top, ["case_id", "label"]).where((F.col("voxels") == F.col("_top")) | (F.col("voxels") >= F.greatest(F.lit(absolute), share * F.col("_top"))))
    return big.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1")
