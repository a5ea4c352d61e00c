"""Reports on a release: figures to fill in, contested structures, corrections, finals, strata of splits, shifts of numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.functions.calls import stratum
from volcohort.functions.review import is_flag
from volcohort.functions.stats import wilson
from volcohort.operators.compare import overlaps

# What stands where a figure can't be made, and the kinds of matches.
NO_MANIFEST, NO_SCAN = "NEEDS_MANIFEST", "NEEDS_NIFTI"
MATCHES = ("fused", "separate", "spine_only", "pelvic_only")
CRESTS, GROUPS = ("L3", "L4", "L5"), (5, 4, 6)
THORACIC = (1, 12)


def fillsheet(cases: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """(key, value): the figures of a cohort as texts, in one pass. cases: (match_type, spine, pelvic, lstv_pelvic); spine is
    (bone_pct, method), pelvic (bone_pct), NULL where there is none. totals: one row with the totals that the manifest itself states
    (n_cases, n_fused, ..., any of them); a stated one goes before what is counted. Figures are rounded half up, parts of the split half to even."""
    low = F.lower(F.coalesce("lstv_pelvic", F.lit("")))
    method = F.when(F.col("spine").isNotNull(), F.lower(F.coalesce("spine.method", F.lit(""))))
    held = cases.select("match_type", F.col("spine.bone_pct").cast("double").alias("s"), F.col("pelvic.bone_pct").cast("double").alias("p"), low.alias("l"), method.alias("m"))
    many = F.count_if
    has = lambda c, *t: F.greatest(*[F.col(c).contains(x) for x in t]) if len(t) > 1 else F.col(c).contains(t[0])
    sums = [F.count(F.lit(1)).alias("n_dataset"), *[many(F.col("match_type") == m).alias(f"n_{m}") for m in MATCHES]]
    for name, c in (("spine", "s"), ("pelv", "p")):
        sums += [f(c).alias(f"{name}_{n}") for n, f in (("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("n", F.count))]
    sums += [many(has("m", "world_space") | (F.col("m") == "")).alias("affine"), many(has("m", "xcorr", "phase")).alias("xcorr"), many(has("m", "anchor", "nifti")).alias("anchor")]
    sums += [
        many(F.col("l").isin("", "normal")).alias("normal"), many(has("l", "sacral") & ~has("l", "semi")).alias("sacral"), many(has("l", "lumbar")).alias("lumbar"),
        many(has("l", "semi")).alias("semi"),
    ]
    t = held.agg(*sums)
    stated = {c: "n_dataset" if c == "n_cases" else c for c in ("n_cases", *[f"n_{m}" for m in MATCHES]) if totals is not None and c in totals.columns}
    if stated:
        t = t.join(F.broadcast(totals.limit(1).select(*[F.col(c).cast("long").alias(f"_{n}") for c, n in stated.items()])), F.lit(True), "left")
        t = t.withColumns({n: F.coalesce(f"_{n}", n) for n in stated.values()}).drop(*[f"_{n}" for n in stated.values()])
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    tenth = lambda c: F.format_string("%.1f", c)
    rows: dict[str, Column] = {"n_dataset": text("n_dataset")} | {f"n_{m}": text(f"n_{m}") for m in MATCHES}
    for name in ("spine", "pelv"):
        some = F.col(f"{name}_n") > 0
        put = {
            f"{name}_bone_pct_mean": tenth(F.col(f"{name}_mean")), f"{name}_bone_pct_sd": tenth(F.coalesce(f"{name}_sd", F.lit(0.0))),
            f"{name}_bone_pct_min": tenth(F.col(f"{name}_min")), f"n_{name}_placed": text(f"{name}_n"),
        }
        rows |= {k: F.when(some, v).otherwise(NO_MANIFEST) for k, v in put.items()}
    rows |= {f"n_{m}_placed": F.when(F.col(m) > 0, text(m)).otherwise(NO_SCAN) for m in ("affine", "xcorr", "anchor")}
    rows |= {"n_lstv_total": text(F.col("sacral") + F.col("lumbar") + F.col("semi")), "n_sacralization": text("sacral"), "n_lumbarization": text("lumbar"), "n_semi_sacralization": text("semi"), "n_normal_cases": text("normal")}
    rows |= {"n_fused_training": text("n_fused"), "n_spine_native": text(F.col("n_fused") + F.col("n_spine_only")), "n_pelvic_native": text(F.col("n_fused") + F.col("n_pelvic_only"))}
    rows |= {f"n_fused_{part}": text(F.bround(F.col("n_fused") * share, 0).cast("long")) for part, share in (("train", 0.7), ("val", 0.15), ("test", 0.15))}
    return t.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in rows.items()])))


def crest_levels(df: DataFrame, count: str, level: str, least: int = 15) -> DataFrame:
    """(rib_free, n, level, count, pct, lo, hi): how often the iliac crest reaches each lumbar level, by the number of vertebrae
    without ribs, with score intervals. Groups under `least` are left out; n counts thoracic levels too. No rows unless two groups
    are left."""
    at = F.trim(level)
    own = df.select(F.floor(F.col(count).cast("double")).cast("int").alias("rib_free"), at.alias("level"))
    own = own.where(F.col("rib_free").isin(*GROUPS) & (at != "") & (at != "n/a"))
    t = own.groupBy("rib_free").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("level") == c).alias(c) for c in CRESTS])  # three rows at most
    all_ = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumns({f"any_{c}": F.max(c).over(all_) > 0 for c in CRESTS}).where(F.col("n") >= least).withColumn("groups", F.count(F.lit(1)).over(all_))
    cells = F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("count"), F.col(f"any_{c}").alias("seen")) for c in CRESTS])
    out = t.where("groups >= 2").select("rib_free", "n", F.inline(cells)).where("seen")
    lo, hi = wilson(F.col("count"), F.col("n"))
    return out.select("rib_free", "n", "level", "count", (100 * F.col("count") / F.col("n")).alias("pct"), F.round(lo, 2).alias("lo"), F.round(hi, 2).alias("hi"))


def contested(cell: DataFrame, low: int, high: int, least: float = 0.999) -> DataFrame:
    """(case_id, label, na, nb, dice, missing, nth): structures on which two labelings differ, the worst of a case first. missing:
    one side hasn't any of it."""
    o = overlaps(cell).where(F.col("label").between(low, high)).withColumn("dice", 2 * F.col("both") / (F.col("na") + F.col("nb")))
    nth = F.row_number().over(Window.partitionBy("case_id").orderBy("dice", "label"))  # a scheme's labels at most
    return o.where(F.col("dice") < least).select("case_id", "label", "na", "nb", "dice", ((F.col("na") == 0) | (F.col("nb") == 0)).alias("missing"), nth.alias("nth"))


def shift_by_vertebra(near: DataFrame, least: int = 6000, margin: float = 2.5) -> DataFrame:
    """(case_id, side, shift, problem): by how much rib numbers are off, asked from each thoracic vertebra with `least` voxels: its
    nearest rib votes for the difference if the runner-up is over `margin` times as far; all votes must agree.

    near: (case_id, side, level, voxels, rib, distance) for each vertebra and each rib of the side."""
    ok = F.col("level").between(*THORACIC) & (F.col("voxels") >= least)
    two = F.slice(F.array_sort(F.collect_list(F.when(ok, F.struct("distance", "rib")))), 1, 2)  # of a side's twelve ribs
    v = near.groupBy("case_id", "side", "level").agg(two.alias("two"))
    best, second = F.get("two", F.lit(0)), F.get("two", F.lit(1))
    clear = best.isNotNull() & (second.isNull() | (second["distance"] > margin * best["distance"]))
    g = v.groupBy("case_id", "side").agg(F.collect_set(F.when(clear, F.col("level") - best["rib"])).alias("votes"))
    n = F.size("votes")
    return g.select("case_id", "side", F.when(n == 1, F.get("votes", F.lit(0))).alias("shift"), F.when(n == 0, "no clear vertebra").when(n > 1, "vertebrae disagree").alias("problem"))


def rib_twelve(rows: DataFrame) -> DataFrame:
    """(case_id, told): what the twelfth rib of each side is nearest to. rows: (case_id, side, rib, nearest, nth); the first counts."""
    at = lambda s: F.min_by(F.when((F.col("side") == s) & (F.col("rib") == 12), F.col("nearest")), F.when((F.col("side") == s) & (F.col("rib") == 12), F.col("nth")))
    told = [F.concat(F.lit(f"{s[0]}12->"), F.coalesce(at(s), F.lit("absent"))) for s in ("left", "right")]
    return rows.groupBy("case_id").agg(F.concat_ws(" ", *told).alias("told"))


def separation(df: DataFrame, keys: list[str], apart: Column, value: str) -> DataFrame:
    """keys, n0, mean0, sd0, n1, mean1, sd1, separation, separable: two groups by the distance of means over the sum of deviations
    (of populations); over 1.5 they can be told apart. apart: whether a row is of the second group."""
    v = F.col(value)
    parts = [f(F.when(c, v)).alias(f"{n}{i}") for i, c in enumerate((~apart, apart)) for n, f in (("n", F.count), ("mean", F.avg), ("sd", F.stddev_pop))]
    s = F.abs(F.col("mean0") - F.col("mean1")) / (F.col("sd0") + F.col("sd1") + 1e-9)
    return df.groupBy(*keys).agg(*parts).withColumn("separation", s).withColumn("separable", s > 1.5)


def finals_by_token(finals: DataFrame) -> DataFrame:
    """(token, decisions): configuration and decision of each final of a patient, in their order (nth). finals: (case_id, decision,
    nth); a case's id is the token and the configuration, apart by two underscores."""
    token = F.substring_index("case_id", "__", 1)
    config = F.substr("case_id", F.length(token) + 3)
    one = F.struct("nth", config.alias("config"), F.coalesce("decision", F.lit("?")).alias("decision"))
    g = finals.groupBy(token.alias("token")).agg(F.array_sort(F.collect_list(one)).alias("_d"))
    return g.select("token", F.transform("_d", lambda d: F.struct(d["config"], d["decision"])).alias("decisions"))


def final_labels(finals: DataFrame) -> DataFrame:
    """(case_id, label) of the finals that weren't rejected and have a label; of several the last (nth)."""
    own = finals.where(F.coalesce(F.col("decision") != "reject", F.lit(True)) & (F.col("label") != ""))
    return own.groupBy("case_id").agg(F.max_by("label", "nth").alias("label"))


def fix_list(rows: DataFrame, only_flagged: bool = True) -> DataFrame:
    """Rows of a merged check that need review, in their order if that is kept in a column."""
    flags = [is_flag(F.col(c).cast("string")) for c in ("needs_review", "mixing_flag", "leak_flag", "struct_flag")]
    return rows.where(F.greatest(*flags)) if only_flagged else rows


def corrections(rows: DataFrame) -> DataFrame:
    """(source, error, n, cases): corrections and the cases they are of, by source and error; error is NULL in the row of a source."""
    return rows.groupingSets([["source", "error"], ["source"]], "source", "error").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("case").alias("cases"))


def split_strata(cases: DataFrame, seed: int = 42) -> DataFrame:
    """`cases` (token, config, lstv_label, ok) that are ok with `stratum` and `split`: of each stratum 15 % each, one at least, for
    test and validation. A stratum of one is for training, of two for training and validation.

    Cases are dealt by a digest of seed, token and configuration. Ranks are counted within the first byte of the digest and added
    to the counts of lesser bytes, so no task orders a whole stratum."""
    own = cases.where("ok").withColumn("stratum", stratum(F.col("lstv_label"), F.col("config")))
    own = own.withColumn("_d", F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("token"), F.col("config")).cast("binary"))).withColumn("_b", F.substring("_d", 1, 2))
    counts = own.groupBy("stratum", "_b").agg(F.count(F.lit(1)).alias("_c"))  # 256 for each of six strata at most
    w = Window.partitionBy("stratum").orderBy("_b")
    counts = counts.select("stratum", "_b", (F.sum("_c").over(w) - F.col("_c")).alias("_before"), F.sum("_c").over(Window.partitionBy("stratum")).alias("_n"))
    r = F.row_number().over(Window.partitionBy("stratum", "_b").orderBy("_d", "token", "config")) - 1
    held = own.withColumn("_r", r).join(F.broadcast(counts), ["stratum", "_b"]).withColumn("_r", F.col("_r") + F.col("_before"))
    n, part = F.col("_n"), F.greatest(F.lit(1), F.bround(F.col("_n") * 0.15, 0)).cast("long")
    split = F.when(n == 1, "train").when(n == 2, F.when(F.col("_r") == 0, "train").otherwise("val")).when(F.col("_r") < part, "test").when(F.col("_r") < 2 * part, "val").otherwise("train")
    return held.withColumn("split", split).drop("_d", "_b", "_r", "_before", "_n")


def split_counts(split: DataFrame) -> DataFrame:
    """(stratum, n_total, n_train, n_val, n_test)."""
    return split.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_total"), *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")])
