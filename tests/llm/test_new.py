"""Line dedup, periodic runs and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from volcohort.llm import hard_negatives, line_dedup, periodic

DOCS = "doc_id long, text string, doc string, n_chars long"
VECTORS = "vec_id long, label int, embedding array<double>, cell int"
WHITE = " \t\n\x0b\x0c\r"


def lines_made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    shared = ["A common Line of text", " a common line of text\t", "short", "Ä" * 10, "ä" * 10, "x" * 9, "", "  ", "z" * 40000, *[f"line number {i}" for i in range(40)]]
    texts: list[str | None] = [None, "", "\n\n", "one line only here", "\n".join(f"own line {i}" for i in range(5000))]
    texts += ["\n".join(rng.choice(shared) if rng.random() < 0.7 else f"own {rng.random()}" for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts += ["A common Line of text\n" * 3] * 4
    rng.shuffle(texts)
    rows = [(i * 2, t, "clash", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[7], (rows[8][0], "another text of one doc_id\nline number 3\nline number 3", "clash", 1), (None, "line number 5\nof nobody, this one", None, None)]


def lines_wanted(rows: list[tuple]) -> list[tuple]:
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(WHITE))
    low = lambda d: -(1 << 63) if d is None else d
    first: dict = {}
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)] = min(first.get(key(x), 1 << 62), low(d))
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(key(x), low(d)) == low(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lines(spark, monkeypatch, limit):
    """With the arrays sent to the tasks, and with the names shuffled to copies of the arrays."""
    monkeypatch.setattr(line_dedup, "PORTION", 8)
    rows = lines_made(limit)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert sorted(map(tuple, line_dedup.measure(df, limit).collect()), key=str) == lines_wanted(rows)
    out = line_dedup.drop_lines(df, limit)
    assert out.columns == df.columns
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = out.collect()
    assert sorted((r.doc_id, digest(r.text)) for r in got if r.doc_id is not None) == sorted((d, h) for d, _, _, h in lines_wanted(rows) if d is not None)
    assert sum(r.text is None for r in got) == 1 and all(r.n_chars == len(r.text) for r in got if r.text and r.doc_id not in (None, rows[8][0]))


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) for _ in range(2))
    a[: n // 2] = a[0] if n else a[:0]  # names that differ in one half alone
    sizes, bits, slot = line_dedup.build(a[:n], b[:n])
    assert sorted(slot.tolist()) == list(range(n)) and bits.sum() == n and sum(sizes) == len(bits)
    order = np.argsort(slot)
    cells = {"sizes": np.array(sizes, np.int64), "bits": np.packbits(bits), "prints": b[:n][order], "firsts": order.astype(np.int64), "counts": np.ones(n, np.int32)}
    index = line_dedup.Index([{"shard": 0} | {k: x.tobytes() for k, x in cells.items()}], 1)
    assert index.find(a, b).tolist() == [*slot.tolist(), *[-1] * n]


def test_no_lines(spark):
    none = spark.createDataFrame([], DOCS)
    assert line_dedup.measure(none).collect() == [] and line_dedup.drop_lines(none, 0).collect() == []


def runs_wanted(x: list, least: int = 12) -> list[tuple]:
    found: dict = {}
    for p in range(1, len(x) // 2 + 1):
        i = 0
        while i + p < len(x):
            s = i
            while i + p < len(x) and x[i] == x[i + p]:
                i += 1
            if i > s and i - s + p >= max(least, 2 * p):
                found.setdefault((s, i - s + p), p)
            i += 1
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic_words(rng: random.Random) -> list[str]:
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 30]))}" for _ in range(rng.choice([0, 1, 11, 12, 40, 150]))]
    for _ in range(rng.randint(0, 3)):
        if len(words) > 4:
            a, p = rng.randrange(len(words)), rng.randint(1, len(words) // 4)
            for i in range(a + p, min(len(words), a + rng.randint(p, 5 * p))):
                words[i] = words[i - p]
    return words


def test_runs_of_many_texts():
    rng = random.Random(4)
    for _ in range(150):
        texts = [periodic_words(rng) for _ in range(rng.randint(1, 6))]
        coded = [np.array([int(w[1:]) for w in t], np.int64) for t in texts]
        assert [[tuple(r) for r in x.tolist()] for x in periodic.runs_of(coded)] == [runs_wanted(t) for t in texts]


def test_periodic(spark, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", 400)
    rng = random.Random(5)
    texts = [None, "", " \n ", "a " * 3000, "a b c " * 500, *[rng.choice([" ", "\n", "\t "]).join(periodic_words(rng)) for _ in range(80)]]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, texts[3], "clash", 1), (None, "x y " * 9, None, None)]
    df = periodic.planted(spark.createDataFrame(rows, DOCS).repartition(3))
    got = sorted(map(tuple, periodic.summary(periodic.collapse(df)).collect()), key=str)
    want, planted = [], 0
    for d, t, *_ in rows:
        w, h = (t or "").split(), zlib.crc32(b"" if d is None else str(d).encode())
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p, planted = 1 + (n - a) // (3 + g % 8), planted + 1
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = runs_wanted(w)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        gone = {i for a, m, p in runs for i in range(a + p, a + m)}
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        told = "".join(f"{a},{m},{p}\n" for a, m, p in runs)
        want.append((d, len(runs), s, n, q, None if n is None else 1000 * n // q, digest(told), digest(" ".join(x for i, x in enumerate(w) if i not in gone))))
    assert planted > 3 and got == sorted(want, key=str)
    assert periodic.collapse(spark.createDataFrame([], DOCS)).collect() == []


def mined(rows: list[tuple]) -> list[tuple]:
    held: dict = {}
    for v, label, e, *_ in rows:
        if v is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        x = (label, [int(np.floor(256 * c)) for c in e])
        held[v] = min(held.get(v, x), x)
    score = lambda a, b: sum(p * q for p, q in zip(held[a][1], held[b][1], strict=False))
    out = []
    for a in sorted(v for v in held if v % 100 == 0):
        by = sorted(((-score(a, b), b) for b in held if b != a))
        for s, p in [x for x in by if held[x[1]][0] == held[a][0]][:5]:
            fits = [x for x in by if held[x[1]][0] != held[a][0] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, r, n, -s, -t) for r, (t, n) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e7])
def test_hard_negatives(spark, scale):
    """Clusters with copies, ties, odd rows and a hot vector; the second scale passes what doubles add exactly."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 8))
    rows: list[tuple] = []
    for i in range(900):
        x = centres[rng.integers(6)] + rng.normal(size=8) * 0.2 if i % 3 else np.round(centres[0], 1)
        rows.append((i * 5, int(rng.integers(3)), (x * scale / 4).tolist(), 7))
    rows += [rows[20], (rows[40][0], 9, rows[41][2], 1), (10000, None, rows[0][2], 1), (10001, 1, None, 1), (10100, 1, [1.0, None], 1), (10200, 1, [float("nan")], 1), (10300, 0, [float("inf")], 1), (10400, 0, [], 1), (10500, 1, [0.5 * scale], 1), (None, 1, rows[0][2], 1)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = sorted(map(tuple, hard_negatives.mine(df, search={"cell_rows": 60, "sample": 200, "block": 10}).collect()))
    assert len(got) > 200 and got == mined(rows)
    if scale == 1:
        assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []
