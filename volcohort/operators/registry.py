"""Cases of a manifest: their transition class, their files, which series a mask lies in, and sides that two labelings swap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.functions import geometry
from volcohort.functions.coerce import lookup

# Numbers of the transition classes; what a kind of case needs and what it says of itself.
CLASSES = {
    "NORMAL": 0, "LUMBARIZATION": 1, "SEMI_SACRAL": 2, "SEMI_SACRALIZATION": 2, "SACRALIZATION": 3, "UNKNOWN": 0, "AMBIGUOUS": 0, "INCOMPLETE_SCAN": 0,
    "EXCLUDED": 0,
}
KINDS = {
    "fused": {"needs": ("spine_label", "pelvic_mask"), "dataset": "spine", "role": "spineimg"},
    "spine_only": {"needs": ("spine_label",), "dataset": "spine", "role": "spineimg"},
    "pelvic_only": {"needs": ("pelvic_mask",), "dataset": "pelvic", "role": "pelvimg"},
}


def transition_class(pelvic: Column, vertebral: Column) -> tuple[Column, Column]:
    """(class, source): the name of the pelvic mask decides if it tells of a transition; else the count of vertebrae, unless the
    name has a word of its own that isn't a class."""
    upper = lambda c: F.upper(F.coalesce(c, F.lit("")))
    number = lambda c: F.coalesce(lookup(upper(c), CLASSES), F.lit(0))
    p, v = number(pelvic), number(vertebral)
    open_ = (upper(pelvic) == "") | upper(pelvic).isin([k for k, n in CLASSES.items() if n == 0])
    by_count = (p == 0) & open_ & (v > 0)
    source = F.when(p > 0, F.concat(F.lit("pelvic_filename:"), pelvic)).when(by_count, F.concat(F.lit("vertebral_scan:"), vertebral)).otherwise("default_normal")
    return F.when(p > 0, p).when(by_count, v).otherwise(0), source


# Where images and placed labels of the spine come from, and what a case says of the pelvis's source.
IMAGE_SOURCE, PLACED_SOURCE, ALONE, SEPARATE = "dcm2niix", "placed_dcm2niix", "pelvic_only", "pelvic_native"
#: What a case may bring besides: NULL where it doesn't.
EXTRAS = {
    "series_agreement": "boolean", "lstv_agreement": "boolean", "lstv_confusion_zone": "boolean", "spine_bone_pct": "double", "pelvic_bone_pct": "double", "pelvic_series_dir": "string",
    "warnings": "array<string>",
}


def entries(cases: DataFrame, files: DataFrame, kind: str, image_dir: str, spine_dir: str, pelvis_dirs: list[str], tag: str = ALONE) -> tuple[DataFrame, DataFrame]:
    """(entries, missing) of the cases of a kind. cases: patient_token, spine_series, spine_placed, pelvic_series, pelvic_placed,
    pelvic_stem, lstv_pelvic, lstv_vertebral and any of EXTRAS; files: (path) there are; tag: the source told of pelvic_only entries.
    Entries have the columns of all kinds, NULL where a kind hasn't any.

    image is that of the spine's series, or of the pelvis's for pelvic_only. The spine's label lies in spine_dir by its series, else
    where it was placed. The pelvic mask lies where it was placed if that is there, else in the first of pelvis_dirs that has it by its
    stem, else it is said to lie where it was placed. A case that lacks a file it needs goes to missing, with what it lacks."""
    rule = KINDS[kind]
    place = lambda folder, name, ending: F.concat(F.lit(f"{folder}/"), F.col(name), F.lit(ending))
    asked = {"image": place(image_dir, "pelvic_series" if kind == "pelvic_only" else "spine_series", ".nii.gz"), "spine_0": place(spine_dir, "spine_series", "_seg_placed.nii.gz"), "pelvic_0": F.col("pelvic_placed")}
    asked |= {f"pelvic_{i}": place(d, "pelvic_stem", "_pelvic_placed.nii.gz") for i, d in enumerate(pelvis_dirs, 1)}
    listed = F.array(*[F.struct(F.lit(name).alias("_what"), path.alias("path")) for name, path in asked.items()])
    there = cases.select("patient_token", F.inline(listed)).where("path is not null").join(files.select("path").distinct(), "path", "left_semi")
    got = there.groupBy("patient_token").agg(F.map_from_entries(F.collect_set(F.struct("_what", "path"))).alias("_got"))  # as many as places, at most
    out = cases.join(got, "patient_token", "left")
    held = lambda name: F.col("_got")[name]
    out = out.withColumns({
        "image": held("image"), "spine_label": F.coalesce(held("spine_0"), F.col("spine_placed")),
        "pelvic_mask": F.coalesce(*[held(n) for n in asked if n.startswith("pelvic_")], F.col("pelvic_placed")),
    })
    needed = ["image", *rule["needs"]]
    lacking = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in needed]))
    out = out.withColumn("_lacking", lacking)
    number, source = transition_class(F.col("lstv_pelvic"), F.col("lstv_vertebral"))
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in EXTRAS.items() if c not in cases.columns})
    spine, pelvic = "spine_label" in rule["needs"], "pelvic_mask" in rule["needs"]
    alone = kind == "pelvic_only"
    only = lambda c, of, t="string": (F.col(c) if isinstance(c, str) else c).cast(t) if of else F.lit(None).cast(t)
    own = lambda c: only(c, c in rule["needs"])
    series = F.col("pelvic_series" if kind == "pelvic_only" else "spine_series")
    made = out.where(F.size("_lacking") == 0).select(
        "patient_token", F.lit(kind).alias("match_type"), F.lit(rule["dataset"]).alias("dataset"), F.lit(rule["role"]).alias("label_role"), "image",
        own("spine_label").alias("spine_label"), own("pelvic_mask").alias("pelvic_mask"), number.alias("lstv_class"), source.alias("lstv_source"), series.alias("series_uid"),
        only("series_agreement", kind == "fused", "boolean").alias("series_match"), F.lit(IMAGE_SOURCE).alias("image_source"), only(F.lit(PLACED_SOURCE), spine).alias("seg_source"),
        "lstv_pelvic", "lstv_vertebral", "lstv_agreement", F.coalesce("lstv_confusion_zone", F.lit(False)).alias("lstv_confusion_zone"), only("spine_bone_pct", spine, "double").alias("bone_pct_spine"),
        only("pelvic_bone_pct", pelvic, "double").alias("bone_pct_pelvic"), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"), only("image", alone).alias("pelvic_image"),
        only("pelvic_series_dir", alone).alias("series_dir"), only(F.lit(tag), alone).alias("source"),
    )
    return made, out.where(F.size("_lacking") > 0).select("patient_token", F.array_join("_lacking", ",").alias("lacking"))


def manifest(cases: DataFrame, patients: DataFrame, files: DataFrame, image_dir: str, spine_dir: str, mask_dir: str, native_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, missing, totals) of all cases, each with its match_type. What a case doesn't say of the transition comes from its
    patient (patient_token, lstv_pelvic, lstv_vertebral, lstv_agreement), once each. A case whose spine and pelvis are separate makes an
    entry of either. missing: (patient_token, match_type, lacking); totals: one row, n_missing_files counting files that entries name
    and that aren't there."""
    names = {c: F.col(c) for c in ("lstv_pelvic", "lstv_vertebral")} | ({"lstv_agreement": F.col("lstv_agreement")} if "lstv_agreement" in cases.columns else {})
    known = patients.select("patient_token", *[F.col(c).alias(f"_{c}") for c in ("lstv_pelvic", "lstv_vertebral", "lstv_agreement")])
    told = cases.join(known, "patient_token", "left")
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c)).alias(c)
    flag = F.when(F.coalesce(names.get("lstv_agreement", F.lit(None).cast("boolean")), F.lit(False)) | F.coalesce("_lstv_agreement", F.lit(False)), True).otherwise(names.get("lstv_agreement", F.lit(None).cast("boolean")))
    told = told.select(*[c for c in cases.columns if c not in names and c != "lstv_agreement"], text("lstv_pelvic"), text("lstv_vertebral"), flag.alias("lstv_agreement"))
    made, lost = [], []
    for given, kind, tag in (("fused", "fused", ALONE), ("spine_only", "spine_only", ALONE), ("separate", "spine_only", ALONE), ("pelvic_only", "pelvic_only", ALONE), ("separate", "pelvic_only", SEPARATE)):
        got, lacking = entries(told.where(F.col("match_type") == given).drop("match_type"), files, kind, image_dir, spine_dir, [mask_dir] if kind == "fused" else [native_dir, mask_dir], tag)
        made.append(got.withColumn("_separate", F.lit(given == "separate")))
        lost.append(lacking.select("patient_token", F.lit(kind).alias("match_type"), "lacking"))
    every = reduce(DataFrame.unionByName, made)
    named = every.select(F.explode(F.array("image", "spine_label", "pelvic_mask")).alias("path")).where("path <> ''")
    absent = named.join(files.select("path").distinct(), "path", "left_anti").agg(F.count(F.lit(1)).alias("n_missing_files"))
    of = lambda kind: F.col("match_type") == kind
    sums = {"n_fused": of("fused"), "n_spine_only": of("spine_only"), "n_spine_from_separate": of("spine_only") & F.col("_separate"), "n_pelvic_only": of("pelvic_only"), "n_pelvic_from_separate": of("pelvic_only") & F.col("_separate")}
    classes = {f"n_class_{n}": F.col("lstv_class") == n for n in sorted(set(CLASSES.values()))}
    totals = every.agg(*[F.count_if(c).alias(n) for n, c in (sums | classes).items()]).crossJoin(absent)  # a row each
    return every.drop("_separate"), reduce(DataFrame.unionByName, lost), totals


def world_box(affine: Column, shape: Column) -> tuple[list[Column], list[Column]]:
    """Least and greatest coordinates of the centres of the corner voxels: each axis adds its way where that leads down or up."""
    lows, highs = [], []
    for r in range(3):
        ways = [F.get(affine, F.lit(4 * r + c)) * (F.get(shape, F.lit(c)) - 1) for c in range(3)]
        start = F.get(affine, F.lit(4 * r + 3))
        lows.append(start + sum((F.least(w, F.lit(0.0)) for w in ways), F.lit(0.0)))
        highs.append(start + sum((F.greatest(w, F.lit(0.0)) for w in ways), F.lit(0.0)))
    return lows, highs


def box_share(affine: Column, shape: Column, ref_affine: Column, ref_shape: Column) -> Column:
    """The share of a volume's box that lies in the box of a reference; boxes below one unit count as one."""
    (a, b), (p, q) = world_box(affine, shape), world_box(ref_affine, ref_shape)
    common = [F.greatest(F.lit(0.0), F.least(b[i], q[i]) - F.greatest(a[i], p[i])) for i in range(3)]
    size = [b[i] - a[i] for i in range(3)]
    return reduce(Column.__mul__, common) / F.greatest(F.lit(1.0), reduce(Column.__mul__, size))


def candidate_series(masks: DataFrame, series: DataFrame, on: str) -> DataFrame:
    """mask_id, series_uid, share: the series of a mask's patient (`on`) by the share of the mask's box in that of the series;
    scouts, volumes without three axes and broken affines are left out. Both sides: affine, shape."""
    s = series.select(on, "series_uid", F.col("affine").alias("_ra"), F.col("shape").alias("_rs"))
    s = s.where(geometry.valid_affine(F.col("_ra")) & geometry.valid_shape(F.col("_rs")))
    m = masks.where(geometry.valid_affine(F.col("affine")) & geometry.valid_shape(F.col("shape")))
    # Grids made from few columns outgrow Spark's estimate, which would broadcast every series.
    return m.join(s.hint("merge"), on).select("mask_id", "series_uid", box_share(F.col("affine"), F.col("shape"), F.col("_ra"), F.col("_rs")).alias("share"))


def best_series(masks: DataFrame, series: DataFrame, on: str) -> DataFrame:
    """mask_id, series_uid, share of the series with the greatest share, the first by uid of those that tie."""
    best = F.min(F.struct((-F.col("share")).alias("s"), "series_uid"))
    return candidate_series(masks, series, on).groupBy("mask_id").agg(best.alias("b")).select("mask_id", "b.series_uid", (-F.col("b.s")).alias("share"))


def side_audit(cell: DataFrame, left: tuple[int, int], right: tuple[int, int]) -> DataFrame:
    """case_id, straight, swapped (mean Dice of both sides, as they are and crosswise) and verdict: OK, FLIPPED, MIXED, or SKIP where
    no side has a voxel in any labeling. cell: (case_id, x, y, n), voxels by both labels; left and right: (label in x, label in y)."""
    pairs = {"nl": left, "nr": right, "sl": (left[0], right[1]), "sr": (right[0], left[1])}
    hit = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    x, y = F.col("x"), F.col("y")
    g = cell.groupBy("case_id").agg(*[v.alias(f"{k}_{i}") for k, (a, b) in pairs.items() for i, v in (("z", hit((x == a) & (y == b))), ("s", hit(x == a) + hit(y == b)))])
    dice = {k: F.when(F.col(f"{k}_s") > 0, 2 * F.col(f"{k}_z") / F.col(f"{k}_s")) for k in pairs}
    none = reduce(Column.__and__, [d.isNull() for d in dice.values()])
    mean = lambda a, b: (F.coalesce(dice[a], F.lit(0.0)) + F.coalesce(dice[b], F.lit(0.0))) / 2
    straight, swapped = mean("nl", "nr"), mean("sl", "sr")
    verdict = F.when(none, "SKIP").when((straight > 0.5) & (swapped < 0.1), "OK").when((swapped > 0.5) & (straight < 0.1), "FLIPPED").otherwise("MIXED")
    return g.select("case_id", F.when(~none, F.round(straight, 4)).alias("straight"), F.when(~none, F.round(swapped, 4)).alias("swapped"), verdict.alias("verdict"))
