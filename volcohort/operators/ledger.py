"""State of a double-review ledger, derived from its log of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIMARIES = 2


def slots(events: DataFrame) -> DataFrame:
    """(case_id, slot, reviewer, claimed_at, done_at, done): the last claim of each slot, and whether it was submitted since.

    events: (case_id, slot, reviewer, kind, at, seq) with kind claim, submit or release; the log's order is (at, seq)."""
    order = F.struct("at", "seq")
    of = lambda k, c: F.max_by(F.when(F.col("kind") == k, F.col(c)), F.when(F.col("kind") == k, order))
    last = lambda k: F.max(F.when(F.col("kind") == k, order))
    g = events.groupBy("case_id", "slot").agg(
        of("claim", "reviewer").alias("reviewer"), last("claim").alias("c"), last("submit").alias("s"), last("release").alias("r")
    )
    open_ = F.col("c").isNotNull() & (F.col("r").isNull() | (F.col("c") > F.col("r")))
    done = F.col("s").isNotNull() & open_ & (F.col("s") > F.col("c"))
    return g.where(open_).select("case_id", "slot", "reviewer", F.col("c.at").alias("claimed_at"), F.when(done, F.col("s.at")).alias("done_at"), done.alias("done"))


def status(final: Column, adjudicated: Column, done: Column, claimed: Column, agree: Column) -> Column:
    """Where a case stands. final: decision or NULL; agree: NULL while it isn't known."""
    full = done >= PRIMARIES
    return (
        F.when(final == "reject", "excluded").when(final.isNotNull() | adjudicated, "finalized").when(full & agree, "finalized")
        .when(full & ~agree, "needs_adjudication").when(full | (claimed > 0), "in_review").otherwise("unassigned")
    )


def case_states(cases: DataFrame, slot_rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(case_id, n_claimed, n_done, agree, final, status). outcomes: (case_id, agree, final)."""
    counts = slot_rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_claimed"), F.count_if("done").alias("n_done"))
    out = cases.select("case_id").join(counts, "case_id", "left").join(outcomes, "case_id", "left").fillna(0, ["n_claimed", "n_done"])
    state = status(F.col("final"), F.lit(False), F.col("n_done"), F.col("n_claimed"), F.col("agree"))
    return out.select("case_id", "n_claimed", "n_done", "agree", "final", state.alias("status"))


def claimable(cases: DataFrame, slot_rows: DataFrame, now: Column, hours: int) -> DataFrame:
    """Cases with a slot to give: fewer than two slots that are done or whose lease still runs."""
    held = F.col("done") | (F.col("claimed_at") + F.make_interval(hours=F.lit(hours)) > now)
    taken = slot_rows.groupBy("case_id").agg(F.count_if(held).alias("held"))
    return cases.join(taken, "case_id", "left").fillna(0, ["held"]).where(F.col("held") < PRIMARIES)


def next_claims(cases: DataFrame, n: int) -> DataFrame:
    """The n cases to give out next: untouched ones first, then by priority, then by id."""
    return cases.orderBy(F.col("held") > 0, F.desc("priority"), "case_id").limit(n)


def reviewer_stats(submissions: DataFrame) -> DataFrame:
    """(reviewer, submitted, passed, pass_percent, smoothed): halves round to even."""
    g = submissions.groupBy("reviewer").agg(F.count(F.lit(1)).alias("submitted"), F.count_if("passed").alias("passed"))
    return g.withColumns({"pass_percent": F.bround(100 * F.col("passed") / F.col("submitted"), 0), "smoothed": F.round((F.col("passed") + 1) / (F.col("submitted") + 2), 6)})


def final_pick(submissions: DataFrame) -> DataFrame:
    """(case_id, slot, changed): the submission that changes fewest voxels; ties go to the first slot."""
    return submissions.groupBy("case_id").agg(F.min(F.struct("changed", "slot")).alias("m")).select("case_id", "m.slot", "m.changed")


def seed_cases(records: DataFrame, existing: DataFrame, regions: dict[str, str], worklist: DataFrame | None = None) -> DataFrame:
    """(case_id, region, priority) to add: records (case_id, config, triage) of known configs that are not there yet, and, if a
    worklist (case_id) is given, only those on it; an empty worklist adds nothing."""
    table = F.create_map(*[F.lit(x) for kv in regions.items() for x in kv])
    new = records.withColumn("region", table[F.col("config")]).where("region is not null").join(existing.select("case_id"), "case_id", "left_anti")
    if worklist is not None:
        new = new.join(worklist.select("case_id"), "case_id", "left_semi")
    return new.groupBy("case_id").agg(F.min("region").alias("region"), F.max(F.coalesce("triage", F.lit(0))).alias("priority"))


def reset(slot_rows: DataFrame, outcomes: DataFrame, reviewer: str) -> tuple[DataFrame, DataFrame]:
    """(slots, outcomes) without a reviewer's slots; outcomes of the cases they were in lose agreement and decision."""
    hit = slot_rows.where(F.col("reviewer") == reviewer).select("case_id").distinct().withColumn("_hit", F.lit(True))
    out = outcomes.join(hit, "case_id", "left")
    kept = lambda c: F.when(F.col("_hit").isNull(), F.col(c)).alias(c)
    return slot_rows.where(F.col("reviewer") != reviewer), out.select("case_id", kept("agree"), kept("final"))


def expert_take(cases: DataFrame, expert: str, roster: list[str], wanted: DataFrame) -> DataFrame:
    """Cases (case_id, priority, deferred_by) with those wanted put off for everyone but the expert, and put first."""
    others = F.array(*[F.lit(r) for r in roster if r != expert])
    w = cases.join(wanted.select("case_id", F.lit(True).alias("_w")), "case_id", "left")
    return w.select(
        "case_id", F.when(F.col("_w"), F.greatest(F.col("priority"), F.lit(1_000_000))).otherwise(F.col("priority")).alias("priority"),
        F.when(F.col("_w"), F.array_sort(F.array_remove(F.array_union("deferred_by", others), expert))).otherwise(F.col("deferred_by")).alias("deferred_by"),
    )


def pending(states: DataFrame) -> DataFrame:
    """(case_id, reason) of the cases that are neither final nor excluded."""
    reason = (
        F.when(F.col("status") == "needs_adjudication", "adjudicate").when(F.col("n_done") == 1, "second_review").when(F.col("n_claimed") > 0, "claimed")
        .otherwise("unclaimed")
    )
    return states.where(~F.col("status").isin("finalized", "excluded")).select("case_id", reason.alias("reason"))


def restore_outside(base: DataFrame, edited: DataFrame, remit: list[int], at: list[str]) -> DataFrame:
    """The edited voxels, but where the base or the edit has a label out of the remit, the base's label."""
    b, e = base.select(*at, F.col("label").alias("_b")), edited.select(*at, F.col("label").alias("_e"))
    m = b.join(e, at, "full_outer").fillna(0, ["_b", "_e"])
    inside = lambda c: (F.col(c) == 0) | F.col(c).isin(remit)
    return m.select(*at, F.when(inside("_b") & inside("_e"), F.col("_e")).otherwise(F.col("_b")).alias("label"))
