"""Decision tables on single rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def transition(n_lumbar: Column) -> Column:
    """The call from the number of rib-free vertebrae."""
    return (
        F.when(n_lumbar.isNull() | (n_lumbar <= 2), "unscreenable").when(n_lumbar == 3, "possible_lumbarization")
        .when(n_lumbar == 4, "normal").otherwise("possible_sacralization")
    )


def side_grade(fused: Column, joint: Column, height: Column) -> Column:
    """A side's grade: III fused, II jointed, I for a process of 19 mm or more, else NULL."""
    return F.when(fused, "III").when(joint, "II").when(height >= 19, "I")


def both_sides(left: Column, right: Column) -> Column:
    """The grade of a pair of sides: equal ones are b, one alone is a, II with III is IV, any other pair is atypical, with its sides."""
    none = left.isNull() & right.isNull()
    return (
        F.when(none, F.lit(None).cast("string")).when(left == right, F.concat(left, F.lit("b")))
        .when(left.isNull() | right.isNull(), F.concat(F.coalesce(left, right), F.lit("a")))
        .when(left.isin("II", "III") & right.isin("II", "III"), "IV")
        .otherwise(F.concat(F.lit("atypical:"), left, F.lit("_left/"), right, F.lit("_right")))
    )


def three_valued_agreement(a: Column, b: Column) -> Column:
    """Equality of two calls; NULL if one says nothing."""
    informative = lambda c: c.isNotNull() & (c != "")
    return F.when(informative(a) & informative(b), a == b)


def subtype(pelvic: Column, vertebral: Column, label: Column, n_lumbar: Column, extra: Column) -> Column:
    """The six-way subtype; the first rule that holds decides."""
    lumb = lambda c: F.coalesce(c == "LUMBARIZATION", F.lit(False))
    semi = lambda c: F.coalesce(c.isin("SEMI_SACRAL", "SEMI_SACRALIZATION"), F.lit(False))
    sacr = lambda c: semi(c) | F.coalesce(c == "SACRALIZATION", F.lit(False))
    either = lambda f: f(pelvic) | f(vertebral) | f(label)
    against = lumb(vertebral) & sacr(pelvic) | sacr(vertebral) & lumb(pelvic)
    return (
        F.when(against | F.coalesce(label == "AMBIGUOUS", F.lit(False)), "ambiguous").when((n_lumbar == 6) | extra, "lumb")
        .when(either(semi), "semisacralization").when(sacr(vertebral) & (n_lumbar == 4), "sacr_count")
        .when(either(sacr), "sacralization").otherwise("normal")
    )
