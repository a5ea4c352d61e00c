"""Access to a data set's cases: filters, splits and selections, all as predicates that reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How sure a match is.
CONFIDENCE = {"certain": 1.0, "high": 0.9, "medium": 0.75, "low": 0.55, "ambiguous": 0.3, "unresolved": 0.0}


def has_annotation(kind: str) -> Column:
    """Whether a case has annotations of a kind; a kind that isn't listed is one it lacks."""
    return F.coalesce(F.col("annotations")[kind], F.lit(False))


def aligned() -> Column:
    return F.coalesce(F.col("alignment_ok"), F.lit(False))


def select(
    cases: DataFrame, config: str | None = None, match_type: str | None = None, label: str | None = None, split: str | None = None, annotation: str | None = None,
    aligned_only: bool = False, files: DataFrame | None = None, tokens: list[str] | None = None,
) -> DataFrame:
    """The cases that meet every condition given; labels regardless of case. files: (path) there are now: both files of a case
    must be among them. tokens: blank ones are left out, and an empty list asks for nothing in particular."""
    for value, column in ((config, "config"), (match_type, "match_type"), (split, "split")):
        cases = cases.where(F.col(column) == value) if value else cases
    cases = cases.where(F.lower("label") == label.lower()) if label is not None else cases
    cases = cases.where(has_annotation(annotation)) if annotation else cases
    cases = cases.where(aligned()) if aligned_only else cases
    wanted = [t.strip() for t in tokens or [] if t.strip()]
    cases = cases.where(F.col("token").isin(wanted)) if wanted else cases
    if files is not None:
        for column in ("ct_file", "label_file"):
            cases = cases.join(files.select(F.col("path").alias(column)).distinct(), column, "left_semi")
    return cases


def test_set(cases: DataFrame) -> DataFrame:
    return cases.where("split = 'test'")


def trainval(cases: DataFrame) -> DataFrame:
    return cases.where("split = 'trainval'")


def get(cases: DataFrame, token: str, config: str) -> DataFrame:
    """The case of a patient and a configuration; the last one if it is listed again (by `nth`)."""
    return cases.where((F.col("token") == token) & (F.col("config") == config)).orderBy(F.desc("nth")).limit(1)


def fold(cases: DataFrame, folds: DataFrame, nth: int) -> DataFrame:
    """Cases of one fold with `part`, train or val. folds: (fold, part, token). A fold that isn't there is an error."""
    own = folds.where(F.col("fold") == nth).select("token", "part").distinct()
    if own.isEmpty():
        raise IndexError(f"fold {nth} is not there")
    return cases.join(own, "token")


def patients_by_regions(patients: DataFrame, spine: bool, pelvis: bool) -> DataFrame:
    """Patients with exactly these regions: both, or one without the other."""
    return patients.where((F.col("has_spine") == spine) & (F.col("has_pelvis") == pelvis))


def by_token(patients: DataFrame) -> DataFrame:
    """One row for each token: the last (by `nth`) of those that share it."""
    return patients.groupBy("token").agg(F.max_by(F.struct(*[c for c in patients.columns if c != "token"]), "nth").alias("p")).select("token", "p.*")


def surely_complete(patients: DataFrame, masks: DataFrame, least: str = "high") -> DataFrame:
    """Patients with both regions, each with a mask matched with this confidence at least. masks: (token, region, confidence)."""
    table = F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv])
    good = masks.where(F.coalesce(table[F.col("confidence")], F.lit(0.0)) >= CONFIDENCE[least]).groupBy("token").agg(F.count_if(F.col("region") == "spine").alias("s"), F.count_if(F.col("region") == "pelvis").alias("p"))
    return patients_by_regions(patients, True, True).join(good.where("s > 0 and p > 0").select("token"), "token", "left_semi")
