"""The cascade of all lines against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from volcohort.operators import matching
from volcohort.plans import catalogue


def test_every_line_gets_its_candidate(spark, tmp_path):
    rng = random.Random(31)
    keys = [(o, n) for o in range(40) for n in range(1, 4)]
    rows = [(o, n, rng.randrange(12), rng.randrange(6), float(rng.randint(1, 30))) for o, n in keys]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double")
    df.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = set()
    for o, n, part, supp, q in rows:
        found = []
        for xo, xn, xpart, xsupp, xq in rows:
            if xpart == part and (xo, xn) != (o, n):
                tier = 0 if xsupp == supp else 1 if xq == q else 2 if abs(xq - q) <= 5 else 3
                found.append((tier, abs(q - xq), xsupp, xo, xn))
        if found:
            tier, _, supplier, xo, xn = min(found)
            want.add((o, n, tier, supplier, xo, xn))
    assert {o % 10 for o, *_ in want} == set(range(10))
    got = catalogue.candidate_cascade(spark, str(tmp_path)).select("ok", "ln", "tier", "sk", "xo", "xl").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("first", [True, False])
def test_candidates_that_can_be_kept(spark, first):
    """Equal rows of the left, keys of several rows and missing numbers included."""
    rng = random.Random(5)
    lines = [(rng.randrange(40), rng.randrange(2), rng.randrange(4), rng.choice([1.0, 2.0, 9.0, 30.0, None]), rng.randrange(8)) for _ in range(160)]
    lines += lines[:9]
    left = spark.createDataFrame(lines, "ok int, ln int, os int, oq double, part int")
    right = left.toDF("xo", "xl", "sk", "xq", "part")
    dq, other = F.abs(F.col("oq") - F.col("xq")), (F.col("ok") != F.col("xo")) | (F.col("ln") != F.col("xl"))
    tiers, rank = [F.col("os") == F.col("sk"), dq == 0, dq <= 5], [dq, F.col("sk"), F.col("xo"), F.col("xl")]
    found = matching.candidates(left, right, ["part"], other, tiers, rank, first)
    want = matching.cascade(left, right, ["part"], ["ok", "ln"], tiers, rank, other).select("ok", "ln", "tier", "rank", "sk", "xo", "xl", dq.alias("dq"))
    got = matching.ranked(found, ["ok", "ln"], tiers, rank).select(*want.columns[:-1], dq.alias("dq"))
    keep = (lambda d: d.where("rank = 1")) if first else (lambda d: d)
    assert sorted(map(repr, keep(got).collect())) == sorted(map(repr, keep(want).collect()))
    assert found.count() < left.join(right, "part").where(other).count() / 2  # what can't be kept reaches neither sort nor shuffle
