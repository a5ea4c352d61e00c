"""Codes of structures, qualifiers of names, and decisions on single rows of measures."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the label scheme: ribs 1 to 12 of a side follow its offset.
RIB_OFFSETS = {"left": 33, "right": 45}
# Offsets of ribs in intermediate volumes.
RIB_OFFSETS_RAW = {"left": 100, "right": 200}
# Qualifiers in names of masks.
QUALIFIERS = ("semisacralization", "sacralization", "hard", "veryhard", "lowdose", "metal", "crop", "dqjoint", "ydjoint", "intestinalcalculus", "rl", "supine", "prone")


def rib_code(side: Column, number: Column, offsets: dict[str, int] = RIB_OFFSETS) -> Column:
    """The label of a rib; the right side is any that isn't left."""
    return F.when(side == "left", F.lit(offsets["left"])).otherwise(F.lit(offsets["right"])) + number


def rib_from_sequence(k: Column) -> Column:
    """The label of a rib counted 1 to 12 on the right, 13 to 24 on the left; NULL for any other number."""
    return F.when(k.between(1, 12), rib_code(F.lit("right"), k)).when(k.between(13, 24), rib_code(F.lit("left"), k - 12))


def adjacent_ribs(label: Column) -> Column:
    """The labels of the ribs above and below on the same side."""
    off = F.when(label <= RIB_OFFSETS["left"] + 12, RIB_OFFSETS["left"]).otherwise(RIB_OFFSETS["right"])
    n = label - off
    return F.filter(F.array(label - 1, label + 1), lambda x: (x - label + n).between(1, 12))


def mask_stem(path: Column) -> Column:
    """The file's name without the ending of a volume, wherever in the name that stands."""
    return F.replace(F.replace(F.element_at(F.split(path, "/"), -1), F.lit(".nii.gz"), F.lit("")), F.lit(".nii"), F.lit(""))


def qualifiers(block: Column) -> tuple[Column, Column, Column]:
    """(flags, label, position) of a block of qualifiers between underscores: a flag is set by a whole qualifier only, the semi
    form stands before the full one, and a position may also be part of a longer qualifier."""
    parts = F.split(F.lower(block), "_")
    flag = {q: F.array_contains(parts, q) for q in QUALIFIERS}
    flags = F.create_map(*[x for q, c in flag.items() for x in (F.lit(q), c)])
    label = F.when(flag["semisacralization"], "SEMI_SACRAL").when(flag["sacralization"], "SACRALIZATION").otherwise("NORMAL")
    up = F.upper(block)
    position = F.when(flag["prone"], "PRONE").when(flag["supine"], "SUPINE").when(up.contains("PRONE"), "PRONE").when(up.contains("SUPINE"), "SUPINE").otherwise("UNKNOWN")
    return flags, label, position


def plausible_minimum(values: Column, low: float, high: float, digits: int) -> tuple[Column, Column, Column]:
    """(minimum, levels, dropped) of the values within the bounds; NULL without any."""
    ok = F.filter(values, lambda v: v.between(low, high))
    any_ = F.size(ok) > 0
    return F.when(any_, F.round(F.array_min(ok), digits)), F.when(any_, F.size(ok)), F.when(any_ & (F.size(ok) < F.size(values)), F.size(values) - F.size(ok))


def sacral_segments(left: Column, right: Column) -> Column:
    """Segments from the numbers of openings on both sides: one more than the smaller number, or than that of the only side."""
    pairs = F.when((left > 0) & (right > 0), F.least(left, right)).otherwise(F.greatest(left, right))
    return F.when(pairs > 0, pairs + 1)


def spectrum(n_lumbar: Column, n_sacral: Column, joint_l: Column, joint_r: Column, fused_l: Column, fused_r: Column) -> tuple[Column, Column]:
    """(family, grade) of the border between lumbar and sacral segments, from counts, joints and fusions of both sides."""
    no = F.lit(None).cast("string")
    eq = lambda c, v: F.coalesce(c == v, F.lit(False))
    joint, joints = joint_l | joint_r, joint_l & joint_r
    fused, fusions = fused_l | fused_r, fused_l & fused_r
    normal = eq(n_lumbar, 5) & eq(n_sacral, 5) & ~joint & ~fused
    more, fewer = eq(n_lumbar, 6), eq(n_lumbar, 4) | (eq(n_lumbar, 5) & joint)
    sacral = fewer & (eq(n_sacral, 6) | (eq(n_sacral, 5) & eq(n_lumbar, 5)))
    family = F.when(normal, "normal").when(more, "lumbarization").when(sacral, "sacralization").otherwise("indeterminate")
    grown = F.when(eq(n_sacral, 4) & joints & ~fused, "C").when(eq(n_sacral, 4) & ~joint & ~fused, "D").when(eq(n_sacral, 5), "B").otherwise(no)
    lost = F.when(eq(n_sacral, 6), F.when(fusions, "E").when(fused, "D").otherwise(no)).otherwise(F.when(joints, "C").when(joint, "B").otherwise(no))
    return family, F.when(normal, "A").when(more, grown).when(sacral, lost).otherwise(no)


def upper_border(top: Column, bottom_l: Column, bottom_r: Column, upper_l: Column, upper_r: Column) -> Column:
    """Where a joint surface begins against the first segment: II above it, I in its upper half, III below; NULL if unknown."""
    bottom = (bottom_l + bottom_r) / 2
    z = F.when(upper_l.isNotNull() & upper_r.isNotNull(), (upper_l + upper_r) / 2).otherwise(F.coalesce(upper_l, upper_r))
    return F.when(top.isNull() | bottom.isNull() | z.isNull(), F.lit(None).cast("string")).when(z > top, "II").when(z >= (top + bottom) / 2, "I").otherwise("III")


def change_kind(before: Column, after: Column) -> Column:
    """0 none, 1 removed, 2 added, 3 relabelled."""
    return F.when(before == after, 0).when(after == 0, 1).when(before == 0, 2).otherwise(3)


def density_band(density: Column, n: Column, bandwidth: Column) -> tuple[Column, Column]:
    """The pointwise interval of a Gaussian kernel estimate: density +- 1.96 sqrt(density R / (n h)), not below zero."""
    half = 1.96 * F.sqrt(F.greatest(density, F.lit(0.0)) / (2 * math.sqrt(math.pi)) / (n * bandwidth))
    return F.round(F.greatest(F.lit(0.0), density - half), 5), F.round(density + half, 5)


def swap_pairs(pairs: Column) -> Column:
    """Pairs of labels to swap, from an array of pairs or a flat array of one pair; NULL if a pair isn't two different numbers."""
    good = F.forall(pairs, lambda p: (F.size(p) == 2) & (F.get(p, F.lit(0)) != F.get(p, F.lit(1))))
    return F.when(F.size(pairs) < 1, pairs).when(good, pairs)


def scored_classes(config: Column, with_fused: bool, parts: dict[str, list[int]], whole: list[int]) -> Column:
    """The classes that a configuration has truth for: those of its part, all for the fused one if asked for, else NULL."""
    out = F.when(F.lit(with_fused) & (config == "fused"), F.array(*[F.lit(c) for c in whole]))
    for name, classes in parts.items():
        out = F.when(config == name, F.array(*[F.lit(c) for c in classes])).otherwise(out)
    return out
