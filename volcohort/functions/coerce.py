"""Typed coercion under one rule for missing values: empty text and NaN become NULL at the door."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of positions in the scanner, of sexes, and the greatest age that is told apart.
POSITIONS = {"HFS": "supine", "FFS": "supine", "HFP": "prone", "FFP": "prone"}
SEXES = {"M": "male", "F": "female", "O": "other"}
OLDEST = 89


def optional_text(c: Column) -> Column:
    return F.when(c != "", c)


def optional_double(c: Column) -> Column:
    """Text to double; what isn't a number, and NaN, is NULL."""
    x = optional_text(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(x), x)


def optional_boolean(c: Column) -> Column:
    return optional_text(F.lower(F.trim(c.cast("string")))).try_cast("boolean")


def canonical_uid(c: Column) -> Column:
    """The last dotted part without zero padding; ids of the form CTC-... pass through."""
    t = F.trim(c)
    return F.when(t.startswith("CTC-"), t).otherwise(F.regexp_replace(t, r"\.0+(\d+)$", r".$1"))


def patient_token(c: Column) -> Column:
    t = canonical_uid(c)
    return F.when(t.startswith("CTC-"), t).otherwise(F.element_at(F.split(t, r"\."), -1))


def safe_id(c: Column) -> Column:
    """Other characters than letters, digits, dot, dash become underscores, none at the ends; what is left without any is unknown."""
    clean = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_"), r"^_+|_+$", "")
    return F.when(clean != "", clean).otherwise("unknown")


def safe_name(c: Column) -> Column:
    """A number with four digits at least and no further zeros in front; any other text as `safe_id`."""
    number = F.regexp_replace(c, r"^0+(?=\d)", "")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return F.when(c.rlike(r"^\d+$"), padded).otherwise(safe_id(c))


def review_key(token: Column, config: Column, reviewer: Column, nth: Column | None = None) -> Column:
    """The name of a review: the case, who reviewed it, and the round."""
    return F.concat(case_key(safe_id(token), config), F.lit("__"), safe_id(reviewer), F.lit("__r"), (F.lit(1) if nth is None else nth).cast("string"))


def case_key(token: Column, config: Column) -> Column:
    return F.concat_ws("__", token, config)


def public_age(age: Column) -> tuple[Column, Column]:
    """(age, band): minors are withheld, ages from 90 on share the last band."""
    low = F.least(F.lit(80), F.floor(age / 10) * 10).cast("int")
    shown = age >= 18
    return F.when(shown, age), F.when(shown, F.concat_ws("-", low, low + 9))


def years(c: Column) -> Column:
    """A number and D, W, M or Y, in either case and with white space around, to whole years; a bare number is years. From
    OLDEST on all are OLDEST."""
    shape = r"^\s*(\d+)\s*([YMWDymwd]?)\s*$"
    n, unit = F.regexp_extract(c, shape, 1).try_cast("long"), F.upper(F.regexp_extract(c, shape, 2))
    found = F.when(unit == "M", F.floor(n / 12)).when(unit == "W", F.floor(n * 7 / 365)).when(unit == "D", F.floor(n / 365)).otherwise(n)
    return F.when(found > OLDEST, OLDEST).otherwise(found).cast("int")


def position(c: Column) -> Column:
    """The position from the scanner's code: lying on a side by its ending; other codes in lower case, none is NULL."""
    code = F.upper(F.trim(c))
    side = F.when(code.endswith("DR"), "decubitus_right").when(code.endswith("DL"), "decubitus_left")
    return F.when(c != "", F.coalesce(lookup(code, POSITIONS), side, F.lower(code)))


def lookup(c: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c]
