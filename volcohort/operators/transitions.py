"""Transitions of the review ledger on tables: amend, defer, flag, adjudicate, priorities and the gate.

slots: (case_id, slot, reviewer, claim_token, claimed_at, done, amend, amend_base); cases: (case_id, region, label_file, priority,
deferred_by, needs_expert, rereads); lists and flags that are NULL count as empty and false. Requests that don't match an open claim change nothing and are returned with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIMARY = ("1", "2")
ADJUDICATION = "adj"


def amend_next(cases: DataFrame, slots: DataFrame, reviewer: str) -> DataFrame:
    """The first slot (by case and slot) that was opened again for its own reviewer, with the label to start from: one row at most."""
    open_ = slots.where(F.col("slot").isin(*PRIMARY) & (F.col("reviewer") == reviewer) & F.coalesce("amend", F.lit(False)) & ~F.coalesce("done", F.lit(False)))
    held = open_.join(cases.where("region is not null").select("case_id", "label_file"), "case_id")
    return held.orderBy("case_id", "slot").limit(1).select("case_id", "slot", F.coalesce("amend_base", "label_file").alias("base"))


def _requests(slots: DataFrame, requests: DataFrame, owner: bool) -> DataFrame:
    """requests (case_id, slot, claim_token[, reviewer_id, reason]) with the slot's reviewer and `problem`, NULL if it holds."""
    own = slots.select("case_id", "slot", F.col("claim_token").alias("_token"), F.col("reviewer").alias("_by"), F.coalesce("done", F.lit(False)).alias("_done"))
    match = F.coalesce(F.col("claim_token") == F.col("_token"), F.lit(False))
    match = match | F.coalesce(F.col("reviewer_id") == F.col("_by"), F.lit(False)) if owner else match
    problem = F.when(~match, "no open claim")
    problem = problem if owner else problem.when(F.col("_done"), "already submitted")
    return requests.join(own, ["case_id", "slot"], "left").withColumn("problem", problem)


def _released(slots: DataFrame, good: DataFrame) -> DataFrame:
    return slots.join(good.where("not _done").select("case_id", "slot"), ["case_id", "slot"], "left_anti")


def _put_off(cases: DataFrame, good: DataFrame, *more: Column) -> DataFrame:
    """Cases with the reviewers of `good` among those they are not given to again, each once, in the order they came."""
    by = good.groupBy("case_id").agg(F.sort_array(F.collect_set("_by")).alias("_who"), *more)
    none = F.array().cast("array<string>")
    out = cases.join(by, "case_id", "left")
    return out.withColumn("deferred_by", F.array_union(F.coalesce("deferred_by", none), F.coalesce("_who", none))).drop("_who")


def defer(cases: DataFrame, slots: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, slots, refused): claims that are given back free their slot, and the case isn't given to the reviewer again."""
    asked = _requests(slots, requests, owner=False)
    good = asked.where("problem is null")
    return _put_off(cases, good), _released(slots, good), asked.where("problem is not null").select("case_id", "slot", "problem")


REREADS = "array<struct<by:string,reason:string,at:timestamp>>"


def flag(cases: DataFrame, slots: DataFrame, requests: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, slots, refused): flagged cases wait for an expert, with who flagged them, why and when; a claim that wasn't submitted
    is freed. The owner of a slot may flag it without the right token; a slot without a reviewer is flagged by who asks."""
    asked = _requests(slots, requests, owner=True).withColumn("_by", F.coalesce(F.nullif("_by", F.lit("")), F.col("reviewer_id")))
    good = asked.where("problem is null")
    why = F.coalesce(F.nullif("reason", F.lit("")), F.lit("(no reason given)"))
    told = F.sort_array(F.collect_list(F.struct(F.col("_by").alias("by"), why.alias("reason"), now.cast("timestamp").alias("at")))).alias("_told")
    out, none = _put_off(cases, good, told), F.array().cast(REREADS)
    out = out.withColumn("needs_expert", F.coalesce("needs_expert", F.lit(False)) | F.col("_told").isNotNull())
    out = out.withColumn("rereads", F.concat(F.coalesce("rereads", none), F.coalesce("_told", none))).drop("_told")
    return out, _released(slots, good), asked.where("problem is not null").select("case_id", "slot", "problem")


def adjudicable(states: DataFrame, slots: DataFrame, adjudicator: str, now: Column, hours: int) -> DataFrame:
    """(case_id) that the adjudicator may take: in need of it, not reviewed by them, and not held by another whose lease runs."""
    own = slots.where(F.col("slot").isin(*PRIMARY) & (F.col("reviewer") == adjudicator)).select("case_id")
    runs = F.col("claimed_at") + F.make_interval(hours=F.lit(hours)) > now
    held = slots.where((F.col("slot") == ADJUDICATION) & (F.col("reviewer") != adjudicator) & runs).select("case_id")
    return states.where("status = 'needs_adjudication'").select("case_id").join(own, "case_id", "left_anti").join(held, "case_id", "left_anti")


def adjudication_next(states: DataFrame, slots: DataFrame, adjudicator: str, now: Column, hours: int) -> DataFrame:
    return adjudicable(states, slots, adjudicator, now, hours).orderBy("case_id").limit(1)


def adjudicate(slots: DataFrame, requests: DataFrame) -> DataFrame:
    """(case_id, outcome, final, by, label): requests (case_id, claim_token, decision, label) against the adjudication slots. A
    rejection needs no label, any other decision is a correction and does; what is done already stays as it is."""
    adj = slots.where(F.col("slot") == ADJUDICATION).select("case_id", F.col("claim_token").alias("_token"), F.col("reviewer").alias("by"), F.coalesce("done", F.lit(False)).alias("_done"))
    out = requests.join(adj, "case_id", "left")
    reject = F.col("decision") == "reject"
    outcome = (
        F.when(~F.coalesce(F.col("claim_token") == F.col("_token"), F.lit(False)), "no open claim").when(F.col("_done"), "duplicate")
        .when(~reject & F.col("label").isNull(), "no label").otherwise("done")
    )
    done = F.col("outcome") == "done"
    out = out.withColumn("outcome", outcome)
    return out.select("case_id", "outcome", F.when(done, F.when(reject, "reject").otherwise("corrected")).alias("final"), F.when(done, F.col("by")).alias("by"), F.when(done & ~reject, F.col("label")).alias("label"))


def set_priority(cases: DataFrame, wanted: DataFrame, priority: int) -> DataFrame:
    """Cases with this priority where they are wanted (case_id)."""
    w = wanted.select("case_id", F.lit(True).alias("_w")).distinct()
    return cases.join(w, "case_id", "left").withColumn("priority", F.when(F.col("_w"), F.lit(priority)).otherwise(F.col("priority"))).drop("_w")


def gate(submissions: DataFrame, checks: DataFrame, check: str | None) -> DataFrame:
    """(case_id, slot, accepted, reason): a submission passes if its check passed. One whose check didn't run fails; the reason
    joins the messages that block it, or all if none does. Without a check, or a label, all pass.

    checks: (case_id, slot, ok, messages), ok NULL where the check broke."""
    if check in (None, "", "none"):
        return submissions.select("case_id", "slot", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason"))
    held = submissions.join(checks, ["case_id", "slot"], "left")
    blocking = F.filter("messages", lambda m: m.startswith("X"))
    told = F.array_join(F.when(F.size(blocking) > 0, blocking).otherwise(F.col("messages")), "; ")
    free = F.col("label").isNull()
    reason = F.when(free | F.col("ok"), F.lit(None).cast("string")).when(F.col("ok").isNull(), "the check did not run").otherwise(told)
    return held.select("case_id", "slot", (free | F.coalesce("ok", F.lit(False))).alias("accepted"), reason.alias("reason"))
