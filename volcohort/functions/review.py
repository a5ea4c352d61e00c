"""Predicates and small state transitions of reviewing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECISIONS = ("accept", "corrected", "reject")


def is_flag(c: Column) -> Column:
    """Whether text says yes: 1, 1.0 or true."""
    return F.coalesce(F.lower(F.trim(c)).isin("1", "1.0", "true"), F.lit(False))


# How a note says that only the edge of the scan is meant.
SCAN_EDGE = ("fov-truncated", "clipped by the top/bottom of the scan", "clipped by the scan edge", "clipped by the edge of the scan")


def scan_edge_note(message: Column) -> Column:
    """Whether a message is a note that only tells of the edge of the scan."""
    low = F.lower(F.trim(message))
    return low.startswith("note") & F.greatest(*[low.contains(m) for m in SCAN_EDGE])


def auto_accept(ok: Column, messages: Column) -> tuple[Column, Column]:
    """(accept, reason): accepted if it is ok and every message says OK or is a note on the edge of the scan. Blank messages say
    nothing, and neither do none; else the first message that stands against it gives the reason."""
    kind = lambda m: (
        F.when(F.coalesce(F.trim(m), F.lit("")) == "", F.lit(None).cast("string")).when(F.trim(m).startswith("X"), "blocking")
        .when(F.lower(F.trim(m)).startswith("ok") | scan_edge_note(m), F.lit(None).cast("string")).otherwise("note")
    )
    against = F.get(F.filter(F.transform(messages, kind), lambda k: k.isNotNull()), F.lit(0))
    reason = F.when(~F.coalesce(ok, F.lit(False)), "not_ok").otherwise(F.coalesce(against, F.lit("accepted")))
    return reason == "accepted", reason


def violations(decision: Column, sha: Column, changed: Column) -> Column:
    """What is wrong with a review record, as an array of messages."""
    return F.array_compact(F.array(
        F.when(~F.coalesce(decision.isin(*DECISIONS), F.lit(False)), "unknown decision"),
        F.when(~F.coalesce(sha.rlike("^[0-9a-f]{64}$"), F.lit(False)), "bad digest"),
        F.when(changed.isNull() | (changed < 0), "bad count"), F.when((decision == "accept") & (changed > 0), "accepted with changes"),
    ))


def provenance_after(provenance: Column, reviewed: Column) -> Column:
    """A predicted region that was corrected says so; all others stay."""
    return F.when(reviewed & (provenance == "pseudo"), "pseudo_corrected").otherwise(provenance)


def qualifier(text: Column, position: Column) -> Column:
    """The qualifier among the parts of a name between underscores: exact parts only, semi before full."""
    parts = F.split(F.lower(text), "_")
    has = lambda w: F.array_contains(parts, w)
    return F.when(has("semisacralized") | has("semi"), "semi").when(has("sacralized"), "sacralized").when(has("lumbarized"), "lumbarized").otherwise(position)


def percent_difference(a: Column, b: Column) -> Column:
    """Signed difference from b in per cent; NULL without b."""
    return F.when(b != 0, 100 * (a - b) / b)


def verdict(normal: Column, swapped: Column, high: float = 0.8, low: float = 0.2) -> Column:
    """Sides of two labels from the overlap as named and with sides swapped."""
    return F.when(normal.isNull() | swapped.isNull(), "SKIP").when((normal >= high) & (swapped <= low), "OK").when((swapped >= high) & (normal <= low), "FLIPPED").otherwise("MIXED")
