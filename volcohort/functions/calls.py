"""Calls about one row: what to look for in it, whether it is let through, and which stratum, series or numbering it has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from volcohort.functions.review import is_flag

# Columns of a checked row that a hint reads.
HINT_COLUMNS = (
    "mixing_flag", "off_main_frac", "n_order_inversions", "leak_flag", "off_bone_frac", "struct_flag", "lr_swap", "vertebra_gap",
    "pelvis_incomplete", "duplication_flag",
)


def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("?"))


def flag_hint() -> Column:
    """What a reviewer should look for, from the text columns HINT_COLUMNS; "(flagged)" if none of the checks says so."""
    yes = lambda c: is_flag(F.col(c).cast("string"))
    gap = ~F.coalesce(F.trim(F.col("vertebra_gap").cast("string")), F.lit("0")).isin("", "0", "0.0")
    parts = F.array_compact(F.array(
        F.when(yes("lr_swap"), "L/R HIP SWAP"), F.when(gap, "missing level"), F.when(yes("pelvis_incomplete"), "pelvis incomplete"),
        F.when(yes("duplication_flag"), "duplicated structure"),
    ))
    found = F.array_compact(F.array(
        F.when(yes("mixing_flag"), F.concat(F.lit("vertebra MIXING (off_main="), _known("off_main_frac"), F.lit(", order-inv="), _known("n_order_inversions"), F.lit(")"))),
        F.when(yes("leak_flag"), F.concat(F.lit("OFF-BONE leak (off_bone="), _known("off_bone_frac"), F.lit(")"))),
        F.when(yes("struct_flag"), F.concat(F.lit("structure: "), F.when(F.size(parts) > 0, F.array_join(parts, ", ")).otherwise("issue"))),
    ))
    return F.when(F.size(found) > 0, F.array_join(found, "  |  ")).otherwise("(flagged)")


def resume_action(n_changed: Column, accepted: Column) -> Column:
    """What becomes of a saved claim: submit if a voxel changed or it was accepted on purpose, else skip."""
    return F.when((n_changed > 0) | F.coalesce(accepted, F.lit(False)), "submit").otherwise("skip")


def gate(bones: Column, min_fit: float, max_bad: float, low: float, high: float) -> tuple[Column, Column]:
    """(accept, reasons) of an array of (name, n_warped, n_source, bone_fit, jac_bad, vol_ratio): every bone that is there must
    fit, keep its shape and its volume. What wasn't measured (NULL, NaN) doesn't count against it. Figures of the reasons are
    rounded half up."""
    some = lambda b, c: F.coalesce(b[c] > 0, F.lit(False))
    present = F.filter(bones, lambda b: some(b, "n_warped") | some(b, "n_source"))

    def against(b: Column) -> Column:
        told = lambda v, what, bad: F.when(~F.isnan(v) & bad, F.concat(b["name"], F.lit(what), F.format_string("%.2f", v)))
        fit, bent, ratio = b["bone_fit"], b["jac_bad"], b["vol_ratio"]
        return F.array(told(fit, "_lowfit=", fit < min_fit), told(bent, "_bonewarp=", bent > max_bad), told(ratio, "_volratio=", ~ratio.between(low, high)))

    none = F.coalesce(F.size(present), F.lit(0)) <= 0
    reasons = F.when(none, F.array(F.lit("no_bone_warped"))).otherwise(F.array_compact(F.flatten(F.transform(present, against))))
    return F.size(reasons) == 0, reasons


def worst_extent(a: Column, b: Column) -> Column:
    """The greatest difference in per cent of b over extents in the same order; those that are missing, NaN or zero in b are left
    out, NULL if all are."""
    share = F.zip_with(a, b, lambda x, y: F.when(y != 0, F.abs(100 * (x - y) / y)))
    return F.array_max(F.filter(share, lambda p: p.isNotNull() & ~F.isnan(p)))


def shift_by_order(lumbar: Column, present: Column) -> tuple[Column, Column]:
    """(shift, problem): by how much the numbers of a side's ribs are off, from their order alone. The one rib on the first lumbar
    vertebra must be the lowest, and the rib above it, which is there too, then belongs to the twelfth thoracic one."""
    n, last = F.get(lumbar, F.lit(0)), F.array_max(present)
    problem = (
        F.when(F.coalesce(F.size(lumbar), F.lit(0)) != 1, "not one lumbar rib").when(~n.eqNullSafe(last), "not the lowest rib")
        .when(~F.array_contains(present, n - 1), "no rib above")
    )
    return F.when(problem.isNull(), 13 - n), problem


def series_verdict(same_uid: Column, flipped: Column, overlap: Column, origin_mm: Column) -> Column:
    """Whether a mask lies on the series it was drawn on. The distance of origins (none: 0) decides only if the series isn't known."""
    over = F.coalesce(overlap, F.lit(0.0))
    return (
        F.when(same_uid, "SAME_SERIES").when(~same_uid & F.coalesce(flipped, F.lit(False)) & (over > 50), "PRONE_SUPINE_MISMATCH").when(~same_uid, "DIFFERENT_SERIES")
        .when(F.coalesce(origin_mm, F.lit(0.0)) < 5, "LIKELY_SAME_SERIES").otherwise("UNCERTAIN")
    )


def stratum(label: Column, config: Column) -> Column:
    """The stratum of a release: what kind of transition, and whether both regions lie in one scan."""
    own = F.upper(F.coalesce(F.nullif(label, F.lit("")), F.lit("NORMAL")))
    kind = F.when(own == "LUMBARIZATION", "lumbarization").when(own.isin("SACRALIZATION", "SEMI_SACRALIZATION"), "sacralization")
    fused = F.coalesce(config == "fused", F.lit(False))
    place = F.when(fused, "_fused").otherwise("_separate")
    return F.when(kind.isNotNull(), F.concat(kind, place)).when(fused, "fused_normal").otherwise("nonfused_normal")
