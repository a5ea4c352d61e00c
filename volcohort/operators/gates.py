"""The checks that a submitted label must pass.

Volumes are voxels (case_id, k, j, i, label); slices k rise or fall along the body. grids: (case_id, nk, nj, ni, sk, sj, si, up), the
number of voxels and the spacing along each axis, up = 1 where a greater k lies nearer to the head, else -1. Each check returns
faults (case_id, label, fault, value, blocks): what blocks makes a case fail; the rest, such as a bone that the edge of the scan cuts
off, is told and passes. Thresholds in voxels are those of full volumes times `scale`, for volumes thinned by a stride."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.operators.compare import untouched
from volcohort.operators.distance import nearest
from volcohort.operators.morphology import dilate, erode, thin
from volcohort.operators.storage import staged
from volcohort.operators.voxel import ALL_26, AT, component_sizes, components

# Fixed values of the label scheme and of the checks: voxels, shares and millimetres.
VERTEBRAE, SOLID, SPINE, COLUMN = (1, 26), (1, 33), (1, 29), (1, 25)
RIBS, LEFT, RIGHT, THORACIC_AT = (34, 57), 33, 45, 7
EXTRA_LUMBAR, ADDED, RENUMBERED = 25, (8, 19), (18, 25)
COLUMN_TOP = (*range(1, 26), 28)
EDGE_SLICES = 3
STRUCTURE_LEAST, STRUCTURE_SHARE = 3000, 0.85
MIX_SHARE, MIX_LEAST, MIX_LABEL_LEAST = 0.15, 50, 250
BODIES_LEAST, BODY_LEAST, BODY_SHARE, BODY_STEPS = 8000, 5000, 0.35, 3
ADDED_LEAST = 800
CONTACT_MM, VERTEBRA_LEAST = 3.0, 6000
DETACHED_MM, TOP_MM, BAND_MM, LEVEL_LEAST, HALO_MOST = 15.0, 15.0, 20.0, 1000, 2000

FAULT = ["case_id", "label", "fault", "value", "blocks"]
Ids = tuple[int, int]


def _held(v: DataFrame | None) -> DataFrame | None:
    """The labelled voxels, written, for checks that read them many times."""
    return None if v is None else staged(v.where("label <> 0").select(*AT, "label"), "gate")


def _within(v: DataFrame, ids: Ids) -> DataFrame:
    return v.where(F.col("label").between(*ids)).select(*AT, "label")


def _told(rows: DataFrame, fault: str | Column, value: Column | None = None, blocks: Column | None = None) -> DataFrame:
    what = F.lit(fault) if isinstance(fault, str) else fault
    return rows.select("case_id", F.col("label").cast("int").alias("label"), what.alias("fault"), (F.lit(None) if value is None else value).cast("double").alias("value"), (F.lit(True) if blocks is None else blocks).alias("blocks"))


def cut_off(voxels: DataFrame, grids: DataFrame, slices: int = EDGE_SLICES) -> DataFrame:
    """(case_id, label) of labels in the first or last few slices: the edge of the scan cuts them off."""
    v = voxels.where("label <> 0").select("case_id", "label", "k").distinct().hint("merge").join(grids.select("case_id", "nk"), "case_id")
    return v.where((F.col("k") < slices) | (F.col("k") >= F.col("nk") - slices)).select("case_id", "label").distinct()


def _cut(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Rows with `_cut`, whether the label is cut off."""
    return rows.join(cut.withColumn("_cut", F.lit(True)).hint("merge"), ["case_id", "label"], "left").withColumn("_cut", F.coalesce("_cut", F.lit(False)))


def pieces(voxels: DataFrame) -> DataFrame:
    """(case_id, label, voxels, pieces, first, second): the sizes of a label's two largest parts, each with 26 neighbours."""
    s = component_sizes(components(voxels)).withColumn("_r", F.row_number().over(Window.partitionBy("case_id", "label").orderBy(F.desc("voxels"))))
    of = lambda r: F.coalesce(F.max(F.when(F.col("_r") == r, F.col("voxels"))), F.lit(0))
    return s.groupBy("case_id", "label").agg(F.sum("voxels").alias("voxels"), F.count(F.lit(1)).alias("pieces"), of(1).alias("first"), of(2).alias("second"))


def structure(parts: DataFrame, cut: DataFrame, scale: float = 1.0) -> DataFrame:
    """Solid bones in pieces: the largest holds too little of the bone. parts: as of `pieces`; value: its share."""
    bad = parts.where(F.col("label").between(*SOLID) & (F.col("voxels") >= STRUCTURE_LEAST * scale) & (F.col("pieces") > 1) & (F.col("first") < STRUCTURE_SHARE * F.col("voxels")))
    return _told(_cut(bad, cut), "split", F.col("first") / F.col("voxels"), ~F.col("_cut"))


def _gaps(parts: DataFrame) -> DataFrame:
    """Levels missing between the first and the last vertebra; the extra lumbar one may be."""
    g = parts.where(F.col("label").between(*VERTEBRAE)).groupBy("case_id").agg(F.collect_set("label").alias("_l"))
    missing = F.array_except(F.sequence(F.array_min("_l"), F.array_max("_l")), F.concat("_l", F.array(F.lit(EXTRA_LUMBAR).cast(g.schema["_l"].dataType.elementType))))
    return _told(g.select("case_id", F.explode(missing).alias("label")), "gap")


def _order(voxels: DataFrame, grids: DataFrame, cut: DataFrame) -> DataFrame:
    """Vertebrae whose centroid doesn't lie below that of the number before; value: by how many millimetres."""
    mid = _within(voxels, VERTEBRAE).groupBy("case_id", "label").agg(F.avg("k").alias("_k")).join(grids.select("case_id", "sk", "up"), "case_id")
    z = _cut(mid.select("case_id", "label", (F.col("_k") * F.col("sk") * F.col("up")).alias("_z")), cut)
    w = Window.partitionBy("case_id").orderBy("label")
    z = z.withColumn("_rise", F.col("_z") - F.lag("_z").over(w)).withColumn("_free", F.col("_cut") | F.lag("_cut").over(w))
    return _told(z.where("_rise >= 0"), "order", F.col("_rise"), ~F.col("_free"))


def column(voxels: DataFrame, grids: DataFrame, parts: DataFrame, cut: DataFrame, scale: float = 1.0) -> DataFrame:
    """The column of vertebrae: each in one piece, none missing, in order."""
    mixed = parts.where(F.col("label").between(*VERTEBRAE) & (F.col("pieces") > 1) & (F.col("second") >= MIX_SHARE * F.col("voxels")) & (F.col("second") >= MIX_LEAST * scale))
    mixed = _told(_cut(mixed, cut), "pieces", F.col("second") / F.col("voxels"), ~F.col("_cut"))
    return mixed.union(_gaps(parts)).union(_order(voxels, grids, cut))


def two_bodies(voxels: DataFrame, cut: DataFrame, scale: float = 1.0, stride: int = 1) -> DataFrame:
    """Vertebrae that are two bodies under one label: worn down by some steps they fall into two parts of like size. value: the
    second part's share of the first. What the edge of the scan cuts off is left out."""
    v = _within(voxels, COLUMN).join(cut.hint("merge"), ["case_id", "label"], "left_anti")
    large = v.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= BODIES_LEAST * scale)
    worn = erode(v.join(large.hint("merge"), ["case_id", "label"], "left_semi"), max(1, round(BODY_STEPS / stride)), ALL_26)
    p = pieces(worn).where((F.col("second") >= BODY_LEAST * scale) & (F.col("second") >= BODY_SHARE * F.col("first")))
    return _told(p, "two bodies", F.col("second") / F.col("first"))


def kept_bodies(voxels: DataFrame, given: DataFrame, scale: float = 1.0) -> DataFrame:
    """Bones of the given label whose largest part became background (deleted) or mostly another bone (renumbered, which the
    lower column may be). value: that bone."""
    parts = staged(components(_within(given, SOLID)), "gate-parts")
    s = component_sizes(parts)
    total = s.groupBy("case_id", "label").agg(F.sum("voxels").alias("_t")).where(F.col("_t") >= STRUCTURE_LEAST * scale)
    rank = F.row_number().over(Window.partitionBy("case_id", "label").orderBy(F.desc("voxels"), "component"))
    body = s.join(total, ["case_id", "label"], "left_semi").withColumn("_r", rank).where("_r = 1").select("case_id", "label", "component")
    now = voxels.where("label > 0").select(*AT, F.col("label").alias("_now"))
    n = parts.join(body, ["case_id", "label", "component"]).join(now, AT, "left").groupBy("case_id", "label", "_now").agg(F.count(F.lit(1)).alias("_n"))
    most = n.groupBy("case_id", "label").agg(F.max(F.when(F.col("_now").isNotNull(), F.struct("_n", (-F.col("_now")).alias("_m")))).alias("_x"))
    became = -F.col("_x._m")
    fault = F.when(F.col("_x").isNull(), "deleted").when(~F.col("label").between(*RENUMBERED) & (became != F.col("label")), "renumbered")
    return _told(most.withColumn("_f", fault).where("_f is not null"), F.col("_f"), became)


def class_mixing(voxels: DataFrame, grids: DataFrame, given: DataFrame | None = None, cut: DataFrame | None = None, scale: float = 1.0, stride: int = 1) -> DataFrame:
    """Faults of an edit that joins split bones: structure, column, two bodies under one label, and bodies that went."""
    voxels, given = _held(voxels), _held(given)
    cut = staged(cut_off(voxels, grids) if cut is None else cut, "gate-cut")
    parts = staged(pieces(_within(voxels, SOLID)), "gate-pieces")
    out = structure(parts, cut, scale).union(column(voxels, grids, parts, cut, scale)).union(two_bodies(voxels, cut, scale, stride))
    return out if given is None else out.union(kept_bodies(voxels, given, scale))


def spine_extension(voxels: DataFrame, grids: DataFrame, given: DataFrame | None = None, cut: DataFrame | None = None, scale: float = 1.0, stride: int = 1) -> DataFrame:
    """Faults of an edit that adds thoracic vertebrae: gaps, order, two bodies; an added one that is small, in pieces, or floats."""
    voxels, given = _held(voxels), _held(given)
    cut = staged(cut_off(voxels, grids) if cut is None else cut, "gate-cut")
    v = _within(voxels, VERTEBRAE)
    parts = staged(pieces(v), "gate-pieces")
    out = _gaps(parts).union(_order(voxels, grids, cut)).union(two_bodies(voxels, cut, scale, stride))
    if given is None:
        return out
    before = given.where("label <> 0").select(*AT)
    added = staged(_cut(_within(voxels, ADDED).join(before, AT, "left_anti").select("case_id", "label").distinct(), cut), "gate-added")
    out = out.union(_told(added.where("_cut"), "cut off", None, F.lit(False)))
    p = added.where("not _cut").join(parts, ["case_id", "label"])
    small = F.col("voxels") < ADDED_LEAST * scale
    out = out.union(_told(p.where(small), "small", F.col("voxels")))
    p = p.where(~small)
    out = out.union(_told(p.where((F.col("pieces") > 1) & (F.col("second") >= MIX_LEAST * scale)), "pieces", F.col("second") / F.col("voxels")))
    # A label grown by itself: as a case of its own, so that labels don't hinder each other.
    own = v.join(p.select("case_id", "label").hint("merge"), ["case_id", "label"], "left_semi").withColumn("case_id", F.struct("case_id", F.col("label").alias("l")))
    grown = dilate(own, max(1, round(2 / stride))).select(F.col("case_id.case_id").alias("case_id"), "k", "j", "i", F.col("case_id.l").alias("label"))
    touch = grown.hint("merge").join(v.withColumnRenamed("label", "_o"), AT).where("label <> _o").select("case_id", "label").distinct().hint("merge")
    others = v.groupBy("case_id").agg(F.count_distinct("label").alias("_n")).where("_n > 1").hint("merge")
    return out.union(_told(p.join(touch, ["case_id", "label"], "left_anti").join(others, "case_id", "left_semi"), "floating"))


def mixed_ribs(voxels: DataFrame, least: int = MIX_LABEL_LEAST) -> DataFrame:
    """Ribs that share one bone with another: all ribs worn down by a step, a part with `least` voxels of several numbers. A row for
    each number."""
    ribs = _within(voxels, RIBS)
    bone = components(erode(ribs.withColumn("label", F.lit(1)), 1, ALL_26)).select(*AT, "component")
    n = bone.join(ribs, AT).groupBy("case_id", "component", "label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    many = n.groupBy("case_id", "component").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    return _told(n.join(many, ["case_id", "component"], "left_semi").groupBy("case_id", "label").agg(F.sum("_n").alias("_n")), "mixed", F.col("_n"))


def mixed_vertebrae(voxels: DataFrame, least: int = MIX_LABEL_LEAST) -> DataFrame:
    """(case_id) where one bone of the spine, worn down by a step along faces, carries two numbers: a level left in doubt."""
    from volcohort.operators.voxel import FACES

    spine = _within(voxels, SPINE)
    bone = components(erode(spine.withColumn("label", F.lit(1)), 1, FACES)).select(*AT, "component")
    n = bone.join(spine, AT).groupBy("case_id", "component", "label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return n.groupBy("case_id", "component").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("case_id").distinct()


def rib_numbers(voxels: DataFrame, least: int = MIX_LEAST) -> DataFrame:
    """Ribs in several large pieces, and numbers missing between the first and the last of a side. None of it blocks."""
    ribs = _within(voxels, RIBS)
    s = component_sizes(components(ribs)).where(F.col("voxels") >= least)
    split = s.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    side = ribs.groupBy("case_id", (F.col("label") > RIGHT).alias("_right")).agg(F.collect_set("label").alias("_l"))
    gone = side.select("case_id", F.explode(F.array_except(F.sequence(F.array_min("_l"), F.array_max("_l")), "_l")).alias("label"))
    return _told(split, "pieces", F.col("_n"), F.lit(False)).union(_told(gone, "gap", None, F.lit(False)))


def rib_contact(voxels: DataFrame, grids: DataFrame, contact: float = CONTACT_MM, least: int = VERTEBRA_LEAST) -> DataFrame:
    """Ribs farther than `contact` from the thoracic vertebra of their number (apart; value: the distance), ribs without that vertebra
    (no vertebra), and vertebrae of `least` voxels without a rib on a side (no rib, under the rib's number)."""
    number = lambda c: F.when(c > RIGHT, c - RIGHT).otherwise(c - LEFT)
    voxels = _held(voxels)
    ribs = _within(voxels, RIBS).withColumn("n", number(F.col("label")))
    bones = voxels.where(F.col("label").between(THORACIC_AT + 1, THORACIC_AT + 12)).select(*AT, (F.col("label") - THORACIC_AT).alias("n"))
    far = nearest(ribs, bones.select("case_id", "n", "k", "j", "i"), grids, ["case_id", "n"]).groupBy("case_id", "label").agg(F.min("distance").alias("_d"))
    far = staged(far, "gate-far")  # read twice
    out = _told(far.where(F.col("_d").isNull()), "no vertebra").union(_told(far.where(F.col("_d") > contact), "apart", F.col("_d")))
    large = bones.groupBy("case_id", "n").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= least)
    both = large.select("case_id", F.explode(F.array(F.col("n") + LEFT, F.col("n") + RIGHT)).alias("label"))
    return out.union(_told(both.join(ribs.select("case_id", "label").distinct().hint("merge"), ["case_id", "label"], "left_anti"), "no rib"))


def rib_gaps(voxels: DataFrame, grids: DataFrame, stride: int = 2) -> DataFrame:
    """(case_id, label, gap): millimetres from each rib to the nearest bone of the spine, on every stride-th voxel from the corner of
    their common box, so on all voxels with a stride of 1; ribs without a voxel there, and cases without a spine, are left out."""
    coarse = staged(voxels.where(F.col("label").between(*SPINE) | F.col("label").between(*RIBS)).select(*AT, "label"), "gate")
    if stride > 1:
        corner = coarse.groupBy("case_id").agg(*[F.min(c).alias(f"_{c}") for c in "kji"])
        on = [(F.col(c) - F.col(f"_{c}")) % stride == 0 for c in "kji"]
        coarse = coarse.join(corner, "case_id").where(on[0] & on[1] & on[2]).select("case_id", *[((F.col(c) - F.col(f"_{c}")) / stride).cast("int").alias(c) for c in "kji"], "label")
        coarse = staged(coarse, "gate-coarse")
    wide = grids.select("case_id", *[(F.col(f"s{c}") * stride).alias(f"s{c}") for c in "kji"])
    far = nearest(_within(coarse, RIBS), _within(coarse, SPINE).drop("label"), wide, ["case_id"])
    return far.where("distance is not null").groupBy("case_id", "label").agg(F.min("distance").alias("gap"))


def halo_specks(voxels: DataFrame, most: int = HALO_MOST, steps: int = 2) -> DataFrame:
    """(case_id, label) of ribs under `most` voxels that touch the rib of the next number on their side, itself no speck: what is
    left of an old number on a rib that got a new one."""
    ribs = _within(voxels, RIBS)
    size = ribs.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("_n"))
    small = ribs.join(size.where(F.col("_n") < most).hint("merge"), ["case_id", "label"], "left_semi").withColumn("case_id", F.struct("case_id", F.col("label").alias("l")))
    grown = dilate(small, steps).select(F.col("case_id.case_id").alias("case_id"), "k", "j", "i", F.col("case_id.l").alias("label"))
    large = size.where(F.col("_n") >= most).select("case_id", F.col("label").alias("_o"))
    meets = grown.hint("merge").join(ribs.withColumnRenamed("label", "_o"), AT).select("case_id", "label", "_o").distinct().join(large, ["case_id", "_o"])
    near = (F.abs(F.col("label") - F.col("_o")) == 1) & ((F.col("label") > RIGHT) == (F.col("_o") > RIGHT))
    return meets.where(near).select("case_id", "label").distinct()


def rib_spine_gap(voxels: DataFrame, grids: DataFrame, detached: float = DETACHED_MM, level: int = LEVEL_LEAST, halo: int = HALO_MOST) -> DataFrame:
    """Ribs farther than `detached` from the spine, all voxels compared; value: the distance. It blocks where the rib lies inside the scan and a bone of
    the spine is there at the level of its head. Else the fault says why not: cut off at a face of the scan; its head enters from
    above; a halo speck; above the column, so its own vertebra isn't labelled; no vertebra at its level."""
    voxels = _held(voxels)
    far = rib_gaps(voxels, grids, 1).where(F.col("gap") > detached).hint("merge")
    ends = _within(voxels, RIBS).groupBy("case_id", "label").agg(*[f(c).alias(f"{c}{e}") for c in "kji" for f, e in ((F.min, 0), (F.max, 1))])
    spine = _within(voxels, SPINE).groupBy("case_id", "k").agg(F.count(F.lit(1)).alias("_n"))
    r = far.join(ends, ["case_id", "label"]).join(grids, "case_id")
    r = r.withColumn("_head", F.when(F.col("up") > 0, F.col("k1")).otherwise(F.col("k0"))).withColumn("_face", F.when(F.col("up") > 0, F.col("nk") - 1).otherwise(0))
    band = F.bround(F.lit(BAND_MM) / F.col("sk"), 0)
    s = spine.select(F.col("case_id").alias("_c"), F.col("k").alias("_k"), "_n")
    at = r.join(s, (F.col("case_id") == F.col("_c")) & (F.abs(F.col("_k") - F.col("_head")) <= band)).groupBy("case_id", "label").agg(F.sum("_n").alias("_level"))
    top = voxels.where(F.col("label").isin(*COLUMN_TOP)).groupBy("case_id").agg(F.max("k").alias("_hi"), F.min("k").alias("_lo"))
    r = r.join(at, ["case_id", "label"], "left").join(top, "case_id", "left").join(halo_specks(voxels, halo).withColumn("_speck", F.lit(True)).hint("merge"), ["case_id", "label"], "left")
    clipped = reduce(lambda a, b: a | b, [(F.col(f"{c}0") == 0) | (F.col(f"{c}1") == F.col(f"n{c}") - 1) for c in "kji"])
    above = F.coalesce(F.when(F.col("up") > 0, F.col("_head") > F.col("_hi")).otherwise(F.col("_head") < F.col("_lo")), F.lit(False))
    fault = (
        F.when(clipped, "cut off").when(F.abs(F.col("_head") - F.col("_face")) <= F.bround(F.lit(TOP_MM) / F.col("sk"), 0), "from above")
        .when(F.coalesce("_level", F.lit(0)) < level, "no vertebra").when(F.col("_speck"), "halo").when(above, "above column").otherwise("detached")
    )
    return _told(r.withColumn("_f", fault), F.col("_f"), F.col("gap"), F.col("_f") == "detached")


def altered_spine(voxels: DataFrame, given: DataFrame) -> DataFrame:
    """Cases where an edit of ribs changed the spine, unless the given spine left a level in doubt; value: voxels changed."""
    u = untouched(given, voxels, split=mixed_vertebrae(given)).where("not ok")
    return _told(u.withColumn("label", F.lit(0)), "spine altered", F.col("changed"))


def faults(check: str, voxels: DataFrame, grids: DataFrame, given: DataFrame | None = None, stride: int = 1, advice: bool = True) -> DataFrame:
    """Faults with `check`, the one that found them. check: spine_extend, class_mixing (both on every stride-th voxel, what is cut
    off told from all), spine, ribs or both. advice: also those checks that never block."""
    if check in ("spine_extend", "class_mixing"):
        cut = cut_off(voxels, grids)
        if stride > 1:
            voxels, given = thin(voxels, stride), None if given is None else thin(given, stride)
            grids = grids.select("case_id", *[F.ceil(F.col(f"n{c}") / stride).cast("int").alias(f"n{c}") for c in "kji"], *[(F.col(f"s{c}") * stride).alias(f"s{c}") for c in "kji"], "up")
        work = spine_extension if check == "spine_extend" else class_mixing
        return work(voxels, grids, given, cut, stride**-3, stride).withColumn("check", F.lit(check))
    voxels, found = _held(voxels), []
    put = lambda d, name, blocks=True: found.append((d if blocks else d.withColumn("blocks", F.lit(False))).withColumn("check", F.lit(name)))
    parts = []

    def solid() -> DataFrame:
        if not parts:
            parts.append(staged(pieces(_within(voxels, SOLID)), "gate-pieces"))
        return parts[0]

    edge = staged(cut_off(voxels, grids, 1), "gate-cut")
    if check in ("spine", "both"):
        put(column(voxels, grids, solid(), edge), "column")
        put(structure(solid(), edge), "structure")
    if check in ("ribs", "both"):
        put(mixed_ribs(voxels), "rib labels")
        put(rib_spine_gap(voxels, grids), "rib gap")
        if advice:
            put(rib_numbers(voxels), "rib numbers", False)
    if check == "ribs" and advice:
        put(structure(solid(), edge), "structure", False)
    if check == "ribs" and given is not None:
        put(altered_spine(voxels, given), "spine")
    return reduce(DataFrame.unionByName, found)


def verdicts(cases: DataFrame, found: DataFrame) -> DataFrame:
    """(case_id, ok, messages) of each case: ok if nothing blocks. A message that blocks begins with X, others with note; their
    order is that of check, label and fault. The ledger's gate takes this."""
    told = F.concat_ws(" ", F.when(F.col("blocks"), "X").otherwise("note"), F.concat("check", F.lit(":")), F.col("fault"), F.when(F.col("label") > 0, F.col("label")), F.when(F.col("value").isNotNull(), F.concat(F.lit("("), F.format_string("%.2f", "value"), F.lit(")"))))
    g = found.groupBy("case_id").agg(F.count_if("blocks").alias("_b"), F.array_sort(F.collect_list(F.struct("check", "label", "fault", told.alias("m")))).alias("_m"))
    out = cases.select("case_id").distinct().join(g, "case_id", "left")
    return out.select("case_id", (F.coalesce("_b", F.lit(0)) == 0).alias("ok"), F.coalesce(F.col("_m.m"), F.array().cast("array<string>")).alias("messages"))
