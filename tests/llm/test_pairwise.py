"""The pairwise quality score by plain loops: features, optimal weights, threshold, scores."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np

from volcohort.llm import pairwise_quality as pq

SCHEMA = "doc_id long, text string, lang string, label int, _f int"


def features(text: str | None) -> list[float]:
    t = text or ""
    if not t:
        return [0.0] * len(pq.FEATURES)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    lines = [x for x in t.split("\n") if x]
    n, nw, nl, u = len(t), max(1, len(words)), max(1, len(lines)), len(set(words))
    chars = sum(map(len, words))
    count = lambda p: sum(len(x) for x in re.findall(p, t))
    return [
        math.log1p(len(words)), float(len(words) < 20), math.log1p(n), count(r"[A-Z]+") / n, count(r"[0-9]+") / n, count(r"[!-/:-@\[-`{-~]+") / n, count(r"[#*$%&|<>]+") / n, count(r"[^\x00-\x7F]+") / n,
        (n - chars) / n, u / nw, chars / nw / 10, (len(lines) - len(set(lines))) / nl, math.log1p(len(words) / nl), math.log1p(len(lines)),
        count(r"[.!?]+") / nw, math.log(nw / max(u, 1)), count(r"!+") / nw, count(r"\|+") / nw,
    ]


def made(seed: int) -> tuple[list[tuple], dict[int, int]]:
    rng = random.Random(seed)
    rows, labels = [], {}
    for d in range(260):
        words = ["".join(rng.choice("abcdeéXY19") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([3, 30, 90]))]
        bad = rng.random() < 0.4
        text = rng.choice([" ", "\n", "\t "]).join(w + rng.choice(["!", "|", ".", "#$"]) if bad and rng.random() < 0.5 else w for w in words)
        rows.append((d, text, "en", 1, 7))
        if rng.random() < 0.8:
            labels[d] = int(bad == (rng.random() < 0.15))
    return [*rows, (1000, None, None, None, None), (1001, "", None, None, None), (None, "no id", None, None, None), rows[5]], labels


def test_scores(spark):
    rows, labels = made(3)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    table = spark.createDataFrame([(d, q, 0) for d, q in labels.items()] + [(None, 1, 0), (5000, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    weights, threshold = pq.train(docs, table)
    held = {d: features(t) for d, t, *_ in rows}
    crc = lambda d: zlib.crc32(b"" if d is None else str(d).encode())
    learnt = [d for d in sorted(labels) if crc(d) % 5]
    good, bad = ([held[d] for d in learnt if labels[d] == q] for q in (1, 0))
    # At the least loss its gradient vanishes: over the pairs, each row with PAIRS_PER_ROW of the other label.
    scale = np.array(good + bad).std(axis=0)
    scale[scale == 0] = 1
    k, slope = max(len(good), len(bad)), np.zeros(len(weights))
    w = np.array(weights) * scale
    for s in range(pq.PAIRS_PER_ROW):
        for n in range(k):
            x = (np.array(good[n % len(good)]) - np.array(bad[(n * (1 if len(bad) == k else 7) + 102 * s) % len(bad)])) / scale
            slope -= x / (1 + math.exp(x @ w)) / (k * pq.PAIRS_PER_ROW)
    assert np.abs(slope + pq.L2 * w).max() < 1e-6
    # The threshold is the score below or at which as large a share lies as labels are bad.
    every = sorted(sum(a * b for a, b in zip(f, weights, strict=True)) for f in good + bad)
    assert abs(threshold - every[len(bad) - 1]) < 1e-9 or abs(threshold - every[len(bad)]) < 1e-9
    shift = math.log(0.3 / 0.7)
    got = pq.rank(docs, table).collect()
    assert len(got) == len(rows)
    for r in got:
        z = sum(a * b for a, b in zip(held[r.doc_id], weights, strict=True)) - threshold + shift
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9 and r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def test_all_rows_are_learnt_from(spark):
    """Beyond what one task or the driver would take: rows and pairs are dealt, and each labelled row is in the model."""
    rows = spark.range(24000, numPartitions=6).selectExpr("id doc_id", "concat(repeat('ab ', cast(25 + id % 40 as int)), if(id % 2 = 0, '!!! #', 'fine.')) text")
    labels = rows.selectExpr("doc_id", "cast(doc_id % 2 as int) quality", "0 toxic")
    w, threshold = pq.train(rows, labels)
    held = pq.with_features(rows.where("crc32(cast(doc_id as string)) % 5 <> 0")).selectExpr("doc_id % 2 quality", "_f")
    scores = sorted((sum(a * b for a, b in zip(r["_f"], w, strict=True)), r["quality"]) for r in held.collect())
    bad = sum(q == 0 for _, q in scores)
    assert len(scores) > 18000 and abs(scores[bad - 1][0] - threshold) < 1e-9
    numbers = pq.ordered(rows.selectExpr("doc_id"), ["doc_id"], "t").where("_i <> doc_id")
    assert numbers.isEmpty() and {q for z, q in scores if z > threshold + 1e-6} == {1}
