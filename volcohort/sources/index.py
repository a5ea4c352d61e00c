"""Indexes of what a source holds: series by their slices, masks by their names, visits of patients, and whether a stored index
still stands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.functions import geometry
from volcohort.functions.codes import qualifiers
from volcohort.functions.coerce import canonical_uid, lookup, patient_token
from volcohort.operators.storage import dealt

# Parts of the descriptions of scouts, the fewest slices of a scan, names of lumbar labels, patterns of file names.
SCOUT_PARTS = ("scout", "topogram", "localizer", "surview", "scoutview", "scanogram", "survey", "loc ", "loc_")
FEWEST_SLICES = 50
LUMBAR = {20: "L1", 21: "L2", 22: "L3", 23: "L4", 24: "L5", 25: "L6"}
SPINE_NAME = r"(?i)^(?:(1\.3\.6\.1\.4\.1\.9328\.50\.4\.\d+)|(CTC-\d+))_seg\.nii\.gz$"
PELVIS_NAME = r"(?i)^dataset2_(1\.3\.6\.1\.4\.1\.9328\.50\.4\.\d+)_(\d+)_(\d+)((?:_[A-Za-z0-9]+)*)_mask_4label(?:\.nii\.gz|\.nii)?$"
POSITIONS = {"HFP": "PRONE", "FFP": "PRONE", "HFS": "SUPINE", "FFS": "SUPINE", "PRONE": "PRONE", "SUPINE": "SUPINE"}
IMAGE_FOLDERS = ("volumes/COLONOG/", "volumes/", "")
IMAGE_ENDINGS = ("", "_ct")


def is_scout(description: Column) -> Column:
    low = F.lower(F.coalesce(description, F.lit("")))
    return reduce(Column.__or__, [low.contains(p) for p in SCOUT_PARTS])


def series(slices: DataFrame) -> DataFrame:
    """One row for each series directory that names a patient and a series, by its middle slice (the n // 2nd by file name).

    slices: series_dir, file, patient_id, series_uid, study_uid, series_number, patient_position, description, origin (3), cosines (6),
    pixel (2), between, thickness. Out: patient_uid, patient_token, series_uid, study_uid, series_dir, series_number,
    patient_position, n_slices, is_scout, is_ct, origin, spacing, direction: these three are NULL for scouts and for slices
    without a direction or a distance. The distance is that to the next slice along the normal, else the one that the slice states.
    Slices get their place by a window over a series, whose size the scanner bounds."""
    by = Window.partitionBy("series_dir")
    placed = slices.withColumn("_r", F.row_number().over(by.orderBy("file")) - 1).withColumn("_n", F.count(F.lit(1)).over(by))
    middle = F.floor(F.col("_n") / 2)
    row = F.struct(*[c for c in slices.columns if c != "series_dir"])
    at = lambda place: F.max(F.when(F.col("_r") == place, row))
    s = placed.groupBy("series_dir").agg(F.max("_n").alias("n_slices"), at(middle).alias("m"), at((middle + 1) % F.col("_n")).alias("next"))
    text = lambda c: F.trim(F.coalesce(F.col(f"m.{c}"), F.lit("")))
    s = s.where((text("patient_id") != "") & (text("series_uid") != "")).withColumn("is_scout", is_scout(F.col("m.description")))
    # Behind a generator: the struct is made once, not once for each of its fields.
    s = s.withColumn("geometry", F.explode(F.array(F.when(~F.col("is_scout"), _geometry(F.col("m"), F.col("next.origin"), F.col("n_slices"))))))
    known = F.coalesce(lookup(F.upper(text("patient_position")), POSITIONS), F.lit("UNKNOWN"))
    return s.select(
        canonical_uid(text("patient_id")).alias("patient_uid"), patient_token(text("patient_id")).alias("patient_token"), canonical_uid(text("series_uid")).alias("series_uid"),
        text("study_uid").alias("study_uid"), "series_dir", F.coalesce(F.col("m.series_number"), F.lit(0)).alias("series_number"), known.alias("patient_position"),
        "n_slices", "is_scout", ((F.col("n_slices") >= FEWEST_SLICES) & ~F.col("is_scout")).alias("is_ct"), "geometry.*",
    )


def _let(value: Column, use) -> Column:
    """use(value) with the value worked out once: the optimiser copies an expression to each place it is used in, but for lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _geometry(m: Column, next_origin: Column, n: Column) -> Column:
    """(origin, spacing, direction) with the first two axes turned round, or NULL."""
    rows, cols = F.slice(m["cosines"], 1, 3), F.slice(m["cosines"], 4, 3)
    across = lambda a, b: F.array(*[F.get(a, F.lit(i)) * F.get(b, F.lit(j)) - F.get(a, F.lit(j)) * F.get(b, F.lit(i)) for i, j in ((1, 2), (2, 0), (0, 1))])
    scaled = lambda v, k: F.transform(v, lambda x: x * k)
    unit = lambda v: _let(geometry.length(v), lambda size: F.when(size >= 1e-9, F.transform(v, lambda x: x / size)))
    positive = lambda x: F.when(x > 1e-9, x)
    turned = lambda v: F.transform(v, lambda x, i: F.when(i < 2, F.lit(0.0) - x).otherwise(x))

    def made(normal: Column) -> Column:
        step = F.abs(geometry.dot(geometry.minus(next_origin, m["origin"]), normal))
        gap = F.coalesce(F.when(n >= 2, positive(step)), positive(m["between"]), positive(m["thickness"]))
        axes = F.array(scaled(rows, F.get(m["pixel"], F.lit(1))), scaled(cols, F.get(m["pixel"], F.lit(0))), _let(gap, lambda g: scaled(normal, g)))
        return _let(axes, lambda v: F.struct(turned(m["origin"]).alias("origin"), F.transform(v, geometry.length).alias("spacing"), F.transform(v, lambda x: turned(unit(x))).alias("axes")))

    out = _let(_let(across(rows, cols), unit), made)
    flat = lambda axes: F.array(*[F.get(F.get(axes, F.lit(j)), F.lit(i)) for i in range(3) for j in range(3)])
    done = lambda g: F.when(F.forall(g["spacing"], lambda x: F.coalesce(x >= 1e-9, F.lit(False))), F.struct(g["origin"].alias("origin"), g["spacing"].alias("spacing"), flat(g["axes"]).alias("direction")))
    return _let(out, done)


def visits(found: DataFrame) -> DataFrame:
    """patient_uid, study_uid, visit_index (from 1, by the least series number of the study), n_series, n_ct, n_scouts, has_prone,
    has_supine, has_unknown, n_extra, composition: what the series of a visit are."""
    ct = F.col("is_ct")
    at = lambda p: F.count_if(ct & (F.col("patient_position") == p))
    g = found.groupBy("patient_uid", "study_uid").agg(
        F.min(F.struct("series_number", "n_slices")).alias("_first"), F.count(F.lit(1)).alias("n_series"), F.count_if(ct).alias("n_ct"),
        F.count_if("is_scout").alias("n_scouts"), (at("PRONE") > 0).alias("has_prone"), (at("SUPINE") > 0).alias("has_supine"), at("UNKNOWN").alias("_unknown"),
    )
    g = g.withColumn("has_unknown", F.col("_unknown") > 0)
    kinds = sum((F.col(c).cast("int") for c in ("has_prone", "has_supine", "has_unknown")), F.lit(0))
    g = g.withColumn("n_extra", F.greatest(F.lit(0), F.col("n_ct") - kinds))
    counted = lambda c, name: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f"×{name}")))
    parts = F.array_compact(F.array(
        F.when(F.col("has_prone"), "prone"), F.when(F.col("has_supine"), "supine"), counted("_unknown", "unknown-pos"), counted("n_scouts", "scout"), counted("n_extra", "extra-kernel"),
    ))
    g = g.withColumn("composition", F.when(F.size(parts) > 0, F.array_join(parts, "+")).otherwise("empty"))
    g = g.withColumn("visit_index", F.row_number().over(Window.partitionBy("patient_uid").orderBy("_first", "study_uid")))
    return g.select("patient_uid", "study_uid", "visit_index", "n_series", "n_ct", "n_scouts", "has_prone", "has_supine", "has_unknown", "n_extra", "composition")


def index_counts(found: DataFrame, visit: DataFrame) -> DataFrame:
    """(kind, value, n): patients by their number of visits, visits by composition, series by kind; a short one that isn't called a
    scout is `other`."""
    per = visit.groupBy("patient_uid").agg(F.count(F.lit(1)).alias("v")).groupBy(F.col("v").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    made = visit.groupBy(F.col("composition").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("is_ct"), F.concat(F.lit("ct "), F.col("patient_position"))).when(F.col("is_scout"), "scout").otherwise("other")
    kinds = found.groupBy(kind.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    named = lambda df, k: df.select(F.lit(k).alias("kind"), "value", "n")
    return named(per, "visits").union(named(made, "composition")).union(named(kinds, "series"))


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def spine_masks(files: DataFrame) -> DataFrame:
    """mask_file, patient_uid, patient_token of the paths (`path`) whose names are those of spine masks; others are left out."""
    name = _file_name(F.col("path"))
    uid, ctc = F.regexp_extract(name, SPINE_NAME, 1), F.upper(F.regexp_extract(name, SPINE_NAME, 2))
    own = files.where(name.rlike(SPINE_NAME)).select(F.col("path").alias("mask_file"), F.when(ctc != "", ctc).otherwise(canonical_uid(uid)).alias("patient_uid"))
    return own.withColumn("patient_token", patient_token(F.col("patient_uid")))


def pelvis_masks(files: DataFrame) -> DataFrame:
    """mask_file, patient_uid, patient_token, series_number, n_slices, position, label, qualifiers and flags, all from the names."""
    name = _file_name(F.col("path"))
    part = lambda i: F.regexp_extract(name, PELVIS_NAME, i)
    block = F.regexp_replace(part(4), "^_+|_+$", "")
    flags, label, where = qualifiers(block)
    return files.where(name.rlike(PELVIS_NAME)).select(
        F.col("path").alias("mask_file"), canonical_uid(part(1)).alias("patient_uid"), patient_token(part(1)).alias("patient_token"), part(2).try_cast("long").alias("series_number"),
        part(3).try_cast("long").alias("n_slices"), where.alias("position"), label.alias("label"), block.alias("qualifiers"), flags.alias("flags"),
    )


def with_image(masks: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Add image_file, the first that is there of the places where the image of a mask may lie: near the mask, then under `root`.
    One join for all places; NULL without any. Paths take a few bytes in a file and many in memory, so all joins shuffle, and masks
    are dealt before their places are made."""
    masks = dealt(masks, "mask_file")
    stem = F.replace(_file_name(F.col("mask_file")), F.lit("_seg.nii.gz"), F.lit(""))
    near = F.regexp_replace("mask_file", r"/[^/]+/[^/]+/[^/]+$", "/")
    tops = [near, *[F.lit(f"{root}/{d}") for d in ("raw_data/", "rawdata/", "")]]
    spots = [F.concat(top, F.lit(folder), stem, F.lit(f"{ending}.nii.gz")) for top in tops for folder in IMAGE_FOLDERS for ending in IMAGE_ENDINGS]
    asked = masks.select("mask_file", F.posexplode(F.array(*spots)).alias("_nth", "_path"))
    there = files.select(F.col("path").alias("_path")).distinct().hint("merge")
    first = asked.join(there, "_path").groupBy("mask_file").agg(F.min_by("_path", "_nth").alias("image_file"))
    return masks.join(first.hint("merge"), "mask_file", "left")


def first_folder(files: DataFrame, folders: list[str], ending: str) -> DataFrame:
    """The files with this ending under the first of the folders that holds any."""
    rank = F.coalesce(*[F.when(F.startswith("path", F.lit(f.rstrip("/") + "/")), F.lit(i)) for i, f in enumerate(folders)])
    ranked = files.where(F.endswith("path", F.lit(ending))).withColumn("_rank", rank)
    best = ranked.agg(F.min("_rank").alias("b")).first()["b"]
    return ranked.where(F.col("_rank") == best).drop("_rank") if best is not None else ranked.limit(0).drop("_rank")


def lumbar_count(labels: Column) -> tuple[Column, Column, Column]:
    """(label, n, names) from the labels that a volume has: what the number of lumbar vertebrae says; NULL is unknown."""
    names = F.array_compact(F.array(*[F.when(F.array_contains(labels, code), F.lit(name)) for code, name in LUMBAR.items()]))
    n = F.size(names)
    label = F.when(labels.isNull(), "UNKNOWN").when(n == 0, "AMBIGUOUS").when(n <= 3, "INCOMPLETE_SCAN").when(n == 4, "SACRALIZATION").when(n == 5, "NORMAL").otherwise("LUMBARIZATION")
    known = labels.isNotNull()
    return label, F.when(known, n).otherwise(0), F.when(known, names).otherwise(F.array().cast("array<string>"))


def stale(files: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, fresh): whether the stored index of each source is no older than its newest file; one that isn't stored is stale, one
    without files is fresh. files: (key, modified); stored: (key, written), once each."""
    newest = files.groupBy(key).agg(F.max("modified").alias("_newest"))
    out = newest.join(stored, key, "full_outer")
    fresh = F.col("written").isNotNull() & F.coalesce(F.col("_newest") <= F.col("written"), F.lit(True))
    return out.select(key, fresh.alias("fresh"))
