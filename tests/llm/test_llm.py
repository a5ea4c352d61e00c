"""Operators for training text against brute force, on small fixtures with nulls, ties, copies and very long texts."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from volcohort.llm import (
    components, decontaminate, hmm_lm, packing, pairwise_quality, quality_rules, sharding, similar, simhash, storage, substring_dedup, suffix_dedup, text, token_cache,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long"


def make(seed: int, n: int = 60) -> list[tuple]:
    """Documents with shared passages, copies, runs, nulls, empty and one very long text; `fp` clashes with a name inside."""
    rng = random.Random(seed)
    voc = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(rng.choice([3, 40, 400]))]
    base = [rng.choice(voc) for _ in range(400)]
    texts: list[str | None] = [None, "", "  \n\t", "one", " ".join(rng.choice(voc) for _ in range(20000)), "x" * 3000]
    while len(texts) < n:
        r, words = rng.random(), []
        if r < 0.2 and len(texts) > 8:
            texts.append(texts[rng.randrange(6, len(texts))])
            continue
        while len(words) < rng.randint(1, 150):
            k = rng.random()
            if k < 0.4:
                a = rng.randint(0, 380)
                words += base[a : a + rng.randint(1, 60)]
            elif k < 0.5:
                words += [rng.choice(voc)] * rng.randint(1, 45)
            else:
                words += [rng.choice(voc) for _ in range(rng.randint(1, 30))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    rng.shuffle(texts)
    return [(i * 3, t, rng.choice(["en", "de", None]), "s", len(t or ""), i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return make(request.param)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bytes_of(t: str | None) -> bytes:
    return (t or "").encode()


def covered(rows, units, length: int, across: bool) -> dict[int, np.ndarray]:
    first: dict = {}
    for r in sorted(rows, key=lambda r: r[0]):
        u = units(r[1])
        for p in range(len(u) - length + 1):
            first.setdefault(tuple(u[p : p + length]) if not isinstance(u, bytes) else u[p : p + length], (r[0], p))
    out = {}
    for r in rows:
        u = units(r[1])
        m = np.zeros(len(u), bool)
        for p in range(len(u) - length + 1):
            d, q = first[tuple(u[p : p + length]) if not isinstance(u, bytes) else u[p : p + length]]
            if d < r[0] or not across and d == r[0] and q < p:
                m[p : p + length] = True
        out[r[0]] = m
    return out


def test_suffix_dedup(docs, rows):
    want = covered(rows, bytes_of, 50, True)
    got = {r.doc_id: r for r in suffix_dedup.measure(docs).collect()}
    assert len(got) == len(rows)
    for d, t, *_ in rows:
        b, m = np.frombuffer(bytes_of(t), np.uint8), want[d]
        spans = int(np.diff(np.concatenate([[0], m.astype(int)])).clip(0).sum())
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans) == (len(b), int(m.sum()), spans)
        assert got[d].kept_sha256 == hashlib.sha256(b[~m].tobytes()).hexdigest()


def test_substring_dedup(docs, rows):
    want = covered(rows, lambda t: bytes_of(t).split(), 20, False)
    got = {r.doc_id: r for r in substring_dedup.measure(docs).collect()}
    stripped = {r.doc_id: r.text for r in substring_dedup.strip_documents(docs).collect()}
    for d, t, *_ in rows:
        kept = [w for w, g in zip(bytes_of(t).split(), want[d], strict=True) if not g]
        assert (got[d].n_words, got[d].n_removed) == (len(want[d]), int(want[d].sum()))
        assert got[d].kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()
        assert bytes_of(stripped[d]).split() == kept and (want[d].any() or stripped[d] == t)


def test_repeated_rows_keep_their_text(spark):
    same = [(1, " ".join(f"w{i}" for i in range(60)), "en", "s", 1, 1)] * 2
    df = spark.createDataFrame([*same, (None, "y" * 80, None, None, None, None)], SCHEMA)
    assert {r.n_removed for r in substring_dedup.measure(df).collect()} == {0}
    assert {r.n_removed for r in suffix_dedup.measure(df).collect()} == {0}


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = [
        quality_rules.measure(none), quality_rules.filter_documents(none), decontaminate.leaks(none, bench), decontaminate.clean_documents(none, bench), packing.pack(none),
        token_cache.count_tokens(none, cache=storage.new_path(spark, "t")), sharding.shard(none), suffix_dedup.measure(none), simhash.near_duplicates(none), simhash.keep_one(none), similar.near_duplicates(none), similar.keep_one(none),
        substring_dedup.measure(none), substring_dedup.strip_documents(none), hmm_lm.score(none), pairwise_quality.rank(none, labels),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_simhash(docs, rows):
    def fingerprint(t):
        w = bytes_of(t).lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {r[0]: fingerprint(r[1]) for r in rows if len(r[1] or "") < 50_000} | {r[0]: simhash.fingerprint(r[1], 3) for r in rows if len(r[1] or "") >= 50_000}
    ids = sorted(fp)
    name = {d: d for d in ids}
    for _ in ids:
        for a in ids:
            name[a] = min([name[a], *(name[b] for b in ids if (fp[a] ^ fp[b]).bit_count() <= 3)])
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {d: got[d].fingerprint for d in ids} == {d: f"{fp[d]:016x}" for d in ids}
    assert {d: got[d].component_id for d in ids} == name
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(name.values()))


def test_simhash_links_in_long_lists(spark, monkeypatch):
    """Posting lists longer than a block are split, and no link is lost."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(40)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    named = {r.node: r.component for r in components.components(links).collect()}
    root = {f: f for f in signed}
    for _ in signed:
        for a in signed:
            root[a] = min(root[b] for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
        if all(root[a] == min(root[b] for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3) for a in signed):
            break
    assert {f: named.get(f, f) for f in signed} == root


def edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_similar_texts(spark):
    """Every link of 0.8 or more is found and none below."""
    rng = random.Random(12)
    rows = []
    for g in range(30):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randint(30, 300))]
        rows += [" ".join(words), " ".join(edited(rng, words, 0.006)), " ".join(edited(rng, words, 0.012)), " ".join(edited(rng, words, 0.15))]
    rows += [rows[0].upper(), None, "", "one two", "one  two"]
    held = [(i, t, "en", "s", 1, i) for i, t in enumerate(rows)]
    sets = []
    for t in rows:
        w = bytes_of(t).lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    name = list(range(len(rows)))
    link = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    for _ in range(4):
        name = [min(name[b] for b in range(len(rows)) if link(sets[a], sets[b])) for a in range(len(rows))]
    docs = spark.createDataFrame(held, SCHEMA).repartition(3)
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()} == dict(enumerate(name))
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(name))


def test_similar_texts_in_long_lists(spark):
    """Groups of edited copies larger than a short list: nothing depends on the length of a list, as all pairs are compared that
    may reach the similarity."""
    rng, rows = random.Random(31), []
    for g in range(3):
        shared = [f"s{g}x{i}" for i in range(100)]
        rows += [" ".join([*shared, *(f"p{g}x{m}x{i}" for i in range(rng.randint(6, 24)))]) for m in range(90)]
    sets = [word_set(t) for t in rows]
    root = list(range(len(rows)))
    link = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    for _ in range(6):
        root = [min(root[b] for b in range(len(rows)) if link[a][b]) for a in range(len(rows))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in enumerate(rows)], SCHEMA).repartition(3)
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()} == dict(enumerate(root))


def test_spanning_forest_is_minimal():
    rng = np.random.default_rng(2)
    fp = np.repeat(rng.integers(0, 1 << 63, (3, 2), dtype=np.uint64), 12, axis=0)
    fp ^= np.uint64(1) << rng.integers(0, 64, fp.shape, dtype=np.uint64)
    links = similar._forest(fp)
    assert len(links) == 36 - 3 and all(a // 12 == b // 12 for a, b in links)


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_quality_counts(docs, rows):
    got = {r.doc_id: r for r in quality_rules.measure(docs).collect()}
    for d, t, *_ in rows:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        lines = [x for x in t.split("\n") if x.encode().split()]
        seen: dict = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        hit = np.zeros(len(w), bool)
        for at in (a for a in seen.values() if len(a) > 1):
            for i in at:
                hit[i : i + 8] = True
        r = got[d]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert (r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), int(hit.sum()))
        assert r.base_failed == (len(w) < 20 or 100 * hit.sum() > 30 * len(w)) and not (r.base_failed and r.kept)


def test_quality_distance(spark):
    common = "the of and to in a is that for it as was with be by on are this or at".split()
    rng = random.Random(3)
    good = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"word{rng.choice('abcdefgh')}{rng.choice('xyz')}" for _ in range(120)) for _ in range(60)]
    bad = [" ".join(str(rng.randrange(10**6)) for _ in range(120)) for _ in range(4)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in enumerate(good + bad)], SCHEMA)
    rows = {r.doc_id: r for r in quality_rules.measure(df).collect()}
    assert all(rows[i].kept for i in range(60)) and not any(rows[i].kept or rows[i].base_failed for i in range(60, 64))
    assert {r.doc_id for r in quality_rules.filter_documents(df).collect()} == set(range(60))
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    want = math.sqrt(sum(x * math.log2(x / y) for x, y in zip(p, m, strict=True) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(q, m, strict=True) if x) / 2)
    arr = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(quality_rules.distance("p", "q")).first()[0]
    assert abs(arr - want) < 1e-12


def test_decontamination(spark):
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([3, 8, 14, 30, 59])] + [(9, None), (10, "")]
    rows = []
    for d in range(40):
        w = [rng.choice(voc) for _ in range(rng.randint(0, 120))]
        if d % 2:
            x = items[d % 5][1].upper().split()
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = "changed"
            if rng.random() < 0.4:
                x.insert(rng.randrange(len(x)), "more")
            at = rng.randint(0, len(w))
            w[at:at] = x
        rows.append((d, " ".join(w) if d != 6 else None, "en", "s", 1, 1))
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t, *_ in rows:
        w = (t or "").lower().split()
        for item, s in items:
            x = (s or "").lower().split()
            if not x or not w:
                continue
            sh = lambda y: Counter(tuple(y[i : i + min(5, len(y))]) for i in range(max(1, len(y) - 4)))
            for p in range(max(1, len(w) - len(x) + 1)):
                a, b = sh(w[p : p + len(x)]), sh(x)
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= 0.8:
                    want[d, item] = max(want.get((d, item), 0), sim)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(docs, bench).collect()}
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(40)) - {d for d, _ in want}


def test_boundaries_are_optimal():
    rng = random.Random(6)
    for _ in range(20):
        n = rng.randint(1, 7)
        lengths = sorted(rng.sample(range(1, 40), n))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 4)
        cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts, strict=True))
        subsets = [[x for i, x in enumerate(lengths) if m >> i & 1] for m in range(1 << n)]
        best = min(cost(s) for s in subsets if s and s[-1] == lengths[-1] and len(s) <= k)
        bounds, padding = packing.boundaries(lengths, counts, k)
        assert padding == best == cost(bounds) and len(bounds) <= k


def test_packing(docs, rows):
    got = packing.pack(docs, buckets=4, max_len=64, budget=256).collect()
    want = Counter({r[0]: len(bytes_of(r[1]).split()) for r in rows})
    tokens: Counter = Counter()
    batches: dict = {}
    for r in got:
        tokens[r.doc_id] += r.n_tokens
        if r.bucket is not None:
            assert r.n_tokens <= r.bucket_len
            batches.setdefault(r.batch, []).append((r.bucket, r.bucket_len, r.slot))
    assert tokens == want and {r.doc_id for r in got} == {r[0] for r in rows}
    for b in batches.values():
        assert len({x[:2] for x in b}) == 1 and len(b) * b[0][1] <= 256 and sorted(x[2] for x in b) == list(range(len(b)))
    assert sorted(batches) == list(range(len(batches)))


def test_token_cache(spark, docs, rows, monkeypatch):
    path = storage.new_path(spark, "tokens")
    count = token_cache.counter(token_cache.TOKENIZER)
    want = dict(zip([r[0] for r in rows], count([r[1] or "" for r in rows]), strict=True))
    got = {r.doc_id: r for r in token_cache.count_tokens(docs, cache=path).collect()}
    assert {d: got[d].n_tokens for d in got} == want and all(got[r[0]].n_bytes == len(bytes_of(r[1])) for r in rows)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got.values())
    distinct = len({r[1] or "" for r in rows})
    assert spark.read.parquet(path).count() == distinct
    more = docs.union(spark.createDataFrame([(999, "<|endoftext|> a new text", None, None, None, None)], SCHEMA))
    again = {r.doc_id: r.n_tokens for r in token_cache.count_tokens(more, cache=path).collect()}
    assert again == want | {999: count(["<|endoftext|> a new text"])[0]} and spark.read.parquet(path).count() == distinct + 1


def test_shards(spark, docs, rows):
    got = {r.doc_id: r for r in sharding.shard(docs, 5).collect()}
    for d, t, *_ in rows:
        assert (got[d].size, got[d].text_crc32) == (len(bytes_of(t)) + 16, zlib.crc32(bytes_of(t)))
    for s in range(5):
        slots = sorted(r.slot for r in got.values() if r.shard == s)
        assert slots == list(range(len(slots)))
    hot = spark.createDataFrame([(i, "same text here" if i % 3 else f"text number {i}", None, None, None, None) for i in range(3000)], SCHEMA)
    sizes = Counter()
    for r in sharding.shard(hot, 5).collect():
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 5


def test_language_model(docs, rows, monkeypatch):
    monkeypatch.setattr(hmm_lm, "HEAD", 30)
    train = Counter()
    for d, t, *_ in rows:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            train.update([*hmm_lm.tokens(t), hmm_lm.END])
    n, v = sum(train.values()), len(train)
    got = {r.doc_id: r for r in hmm_lm.score(docs).collect()}
    assert len(got) == len(rows)
    for d, t, *_ in rows:
        w = [*hmm_lm.tokens(t), hmm_lm.END]
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(train[x] > 0 for x in w), n)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 7 == 2) and abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(1)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    model = norm(rng.random(2), 0), norm(rng.random(2), 0), norm(rng.random((2, 2)), 1), norm(rng.random((3, 2)), 0)
    seqs = [[0, 1, 2, 1], [2], [1, 1, 0]]
    flat, sizes = np.array(sum(seqs, [])), np.array([4, 1, 3])
    starts = np.array([0, 4, 5])
    order = np.argsort(-sizes)
    logs, _, _ = hmm_lm.forward(flat, starts[order], sizes[order], np.ones(3, bool), model, keep=False)
    start, _, move, emit = model
    for i, o in enumerate(order):
        total = 0.0
        for path in np.ndindex(*[2] * len(seqs[o])):
            p = start[path[0]] * emit[seqs[o][0], path[0]]
            for t in range(1, len(path)):
                p *= move[path[t - 1], path[t]] * emit[seqs[o][t], path[t]]
            total += p
        assert abs(logs[i] - math.log(total)) < 1e-12
    before = logs.sum()
    for _ in range(3):  # Baum-Welch never lowers the likelihood
        counts, moves, begun = hmm_lm.expected(flat, starts[order], sizes[order], np.ones(3, bool), model)
        assert abs(counts.sum() - len(flat)) < 1e-9
        model = begun / begun.sum(), model[1], moves / moves.sum(axis=1, keepdims=True), counts / counts.sum(axis=0)
        after = hmm_lm.forward(flat, starts[order], sizes[order], np.ones(3, bool), model, keep=False)[0].sum()
        assert after >= before - 1e-9
        before = after


def test_pairwise_quality(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for d in range(400):
        good = d % 4 != 0
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(80)]
        rows.append((d, " ".join(w) if good else " ".join(x.upper() + "!! #$" for x in w[:30]), "en", "s", 1, 1))
        labels.append((d, int(good), 0))
    rows += [(1000, None, None, None, None, None), (1001, "", None, None, None, None)]
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in pairwise_quality.rank(docs, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [r for r in got.values() if r.held_out and r.doc_id < 1000]
    assert sum(r.predicted == (r.doc_id % 4 != 0) for r in held) / len(held) > 0.97
    only = pairwise_quality.rank(docs, lab.where("quality = 1")).collect()
    assert {r.predicted for r in only} == {1}


def test_clashing_columns(spark, rows):
    """Columns with names that operators use inside, and odd ones, pass through filters untouched."""
    from pyspark.sql import functions as F

    names = ["_keep", "_doc", "_spans", "_leak", "row_in", "kept", "component_id", "fingerprint", "_t", "_w", "n_words", "a.b", "item_id", "fp"]
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    bench = spark.createDataFrame([(1, "some words that nobody wrote here")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    filters = [quality_rules.filter_documents(docs), simhash.keep_one(docs), similar.keep_one(docs), substring_dedup.strip_documents(docs), decontaminate.clean_documents(docs, bench)]
    for out in filters:
        assert out.columns == docs.columns
        assert all(r[n] == i for r in out.collect() for i, n in enumerate(names))
    others = [
        quality_rules.measure(docs), suffix_dedup.measure(docs), substring_dedup.measure(docs), simhash.near_duplicates(docs), packing.pack(docs), sharding.shard(docs), hmm_lm.score(docs),
        token_cache.count_tokens(docs, cache=storage.new_path(spark, "t")), pairwise_quality.rank(docs, labels),
    ]
    assert all(out.select("doc_id").distinct().count() == len(rows) for out in others)


def test_numbering_is_gapless(spark):
    df = spark.range(500).selectExpr("id", "cast(if(id % 5 < 4, 0, id % 3) as int) g")
    got = text.numbered(df, "g", ["id"], "n").collect()
    for g in {r.g for r in got}:
        assert sorted(r.n for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))


def word_set(t: str | None) -> set:
    w = bytes_of(t).lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def leaks_item(t: str | None, item: str) -> bool:
    """Whether a window of the text as long as the item is similar enough, by trying all."""
    w, x = (t or "").lower().split(), item.lower().split()
    sh = lambda y: Counter(tuple(y[i : i + 5]) for i in range(len(y) - 4))
    b = sh(x)
    return any(sum((sh(w[p : p + len(x)]) & b).values()) >= 0.8 * sum((sh(w[p : p + len(x)]) | b).values()) for p in range(max(1, len(w) - len(x) + 1)) if w)


@pytest.mark.parametrize("repeat", [False, True])
def test_keep_one_of_repeated_rows(spark, repeat):
    rows = [(i, f"text number {i} " + " ".join(f"w{i}x{j}" for j in range(30)), "en", "s", 1, 1) for i in range(6)]
    rows += [(7, rows[2][1], "en", "s", 1, 1), (None, rows[3][1], "en", "s", 1, 1), (None, "alone " * 30, "en", "s", 1, 1)]
    df = spark.createDataFrame(rows + (rows[:3] if repeat else []), SCHEMA)
    for keep in (similar.keep_one, simhash.keep_one):
        assert sorted(map(str, (r.doc_id for r in keep(df).collect()))) == sorted(map(str, [*range(6), None, None]))


def test_pipeline(spark, tmp_path):
    """Each stage by brute force on what it is given."""
    import corpus_pipeline

    rng = random.Random(11)
    rows = [r[:5] for r in make(11, 60)]
    for g in range(12):
        words = [f"v{rng.randrange(500)}" for _ in range(rng.randint(60, 200))]
        for share in (0, 0.008, 0.1):
            rows.append((1000 + len(rows), " ".join(edited(rng, words, share)), "en", "s", 1))
    fresh = [f"z{i}" for i in range(80)]
    rows.append((5000, " ".join([*(f"y{i}" for i in range(50)), *fresh, *(f"y{i}" for i in range(50, 90))]), "en", "s", 1))
    item = " ".join([*fresh[:12], "other", *fresh[13:]])
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for i, (_, work) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = storage.stage(work(spark, docs, str(tmp_path)), f"s{i}")
        assert after.columns == columns
        before, kept = ({r.doc_id: r.text for r in d.collect()} for d in (docs, after))
        if i == 0:
            assert kept.keys() == {r.doc_id for r in quality_rules.measure(docs).collect() if r.kept}
        if i == 1:
            sets = {d: word_set(t) for d, t in before.items()}
            name = {d: d for d in sets}
            for _ in range(4):
                name = {a: min(name[b] for b in sets if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])) for a in sets}
            assert kept.keys() == set(name.values()) and len(kept) < len(before)
        if i == 2:
            gone = covered(list(before.items()), lambda t: bytes_of(t).split(), 20, False)
            assert kept.keys() == before.keys() and any(g.any() for g in gone.values())
            assert all(bytes_of(kept[d]).split() == [w for w, g in zip(bytes_of(t).split(), gone[d], strict=True) if not g] for d, t in before.items())
        else:
            assert all(before[d] == kept[d] for d in kept)
        if i == 3:
            assert kept.keys() == {d for d, t in before.items() if not leaks_item(t, item)} and 5000 not in kept
        docs = after
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(kept) and sum(r.n_tokens for r in got) == sum(len((t or "").split()) for t in kept.values())


def test_shared_bytes():
    """The count filter: positional bytes that two fingerprints share."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64) & rng.choice(np.array([0, 0xFF, 0xFF00FF, 0x80, (1 << 63) | 1], np.uint64), 500)
    assert simhash.shared_bytes(x).tolist() == [int(v).to_bytes(8, "big").count(0) for v in x]


def test_equal_texts_stay_together(spark):
    rng = random.Random(21)
    texts = [f"group {g} " + "w " * rng.randint(1, 30) for g in range(60)]
    rows = [(i, texts[rng.randrange(60)], None, None, None, None) for i in range(400)] + [(i, "hot", None, None, None, None) for i in range(400, 600)]
    got = {r.doc_id: r.shard for r in sharding.shard(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    where: dict = {}
    for d, t, *_ in rows:
        where.setdefault(t, set()).add(got[d])
    assert all(len(s) == 1 for t, s in where.items() if t != "hot") and len(where["hot"]) == 4  # a third of all rows is more than a shard's share


def test_placement_is_greedy():
    """Largest first, each to the shard whose residual capacity has the highest dot product; ties to the lower shard."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        items = rng.integers(0, 9, (rng.integers(1, 30), 3)).astype(float)
        unit = items / np.where(items.sum(axis=0) > 0, items.sum(axis=0), 1)
        free = [[1 / 5] * 3 for _ in range(5)]
        want = [0] * len(items)
        for i in sorted(range(len(items)), key=lambda i: (-max(unit[i]), i)):
            dots = [sum(f * u for f, u in zip(row, unit[i], strict=True)) for row in free]
            want[i] = max(range(5), key=lambda s: (round(dots[s], 12), -s))
            free[want[i]] = [f - u for f, u in zip(free[want[i]], unit[i], strict=True)]
        assert sharding.place(items, 5).tolist() == want


def test_language_model_end_to_end(spark, monkeypatch):
    """Training and scores by plain loops over all texts, with a head, tail classes and pieces."""
    monkeypatch.setattr(hmm_lm, "HEAD", 12)
    rng = random.Random(17)
    voc = [f"w{i}" for i in range(25)]
    rows = [(i, " ".join(voc[min(24, int(rng.expovariate(0.2)))] for _ in range(rng.choice([0, 3, 40, 700]))), "en", "s", 1, 1) for i in range(40)]
    got = {r.doc_id: r.score for r in hmm_lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    train = [t for d, t, *_ in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    count = Counter(w for t in train for w in [*hmm_lm.tokens(t), hmm_lm.END])
    level = lambda w: math.floor(math.log2(count[w]) * 64)
    from pyspark.sql import functions as F

    digest = {bytes(r.w): r.h for r in spark.createDataFrame([(w,) for w in count], "w binary").select("w", F.xxhash64("w").alias("h")).collect()}
    head = sorted(w for w in sorted(count, key=lambda w: (-level(w), digest[w], w))[:12] if w != hmm_lm.END)
    ids = {w: i + 1 for i, w in enumerate(head)} | {hmm_lm.END: 0}
    symbol = lambda w: ids.get(w, len(head) + 1 + zlib.crc32(w) % hmm_lm.TAIL)
    total, kinds = Counter(), Counter()
    for w, c in count.items():
        total[symbol(w)] += c
        kinds[symbol(w)] += 1
    frequency = np.array([total[s] + 1 for s in range(len(head) + 1 + hmm_lm.TAIL)], float)
    frequency /= frequency.sum()
    start, middle, move, emit = hmm_lm._initial(frequency)
    S = len(move)
    for _ in range(hmm_lm.STEPS):
        counts, moves, begun = np.zeros_like(emit), np.zeros((S, S)), np.zeros(S)
        for t in train:
            seq = [symbol(w) for w in [*hmm_lm.tokens(t), hmm_lm.END]]
            for p in range(0, len(seq), hmm_lm.PIECE):
                part = seq[p : p + hmm_lm.PIECE]
                a, b = [(start if p == 0 else middle) * emit[part[0]]], [np.ones(S)]
                for s in part[1:]:
                    a[-1] = a[-1] / a[-1].sum()
                    a.append((a[-1] @ move) * emit[s])
                a[-1] = a[-1] / a[-1].sum()
                for s in reversed(part[1:]):
                    x = move @ (emit[s] * b[0])
                    b.insert(0, x / x.sum())
                gamma = [x * y / (x @ y) for x, y in zip(a, b, strict=True)]
                for s, g in zip(part, gamma, strict=True):
                    counts[s] += g
                begun += gamma[0] if p == 0 else 0
                for i in range(len(part) - 1):
                    xi = np.outer(a[i], emit[part[i + 1]] * b[i + 1]) * move
                    moves += xi / xi.sum()
        used = counts.sum(axis=0)
        emit = (counts + hmm_lm.SMOOTH * frequency[:, None]) / (used + hmm_lm.SMOOTH)
        middle, start = (used + 1 / S) / (used + 1 / S).sum(), (begun + 1 / S) / (begun + 1 / S).sum()
        move = (moves + 1 / S) / (moves + 1 / S).sum(axis=1, keepdims=True)
    for d, t, *_ in rows:
        words = [*hmm_lm.tokens(t), hmm_lm.END]
        log, a = 0.0, None
        for w in words:
            a = (start if a is None else a @ move) * emit[symbol(w)]
            log += math.log10(a.sum())
            a = a / a.sum()
            if w not in ids:
                log += math.log10((count[w] + 1) / (total[symbol(w)] + kinds[symbol(w)] + 1))
        assert abs(got[d] - log) < 1e-6 * max(1, abs(log)), d


def test_ranking_on_tied_scores(spark):
    """Equal texts of both labels tie: the threshold lies at their score, so all are predicted 1."""
    rows = [(d, "the same text " * 5, "en", "s", 1, 1) for d in range(60)]
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(60)], "doc_id long, quality int, toxic int")
    got = pairwise_quality.rank(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert len({(r.score, r.predicted) for r in got}) == 1 and len(got) == 60


def test_null_and_repeated_ids(spark, rows):
    """Every operator takes rows without an id and rows that repeat, and gives each its row."""
    odd = [*rows, rows[0], rows[1], (None, rows[10][1], "en", "s", 1, 1), (None, "new words " * 20, None, None, None, None), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(odd, SCHEMA).repartition(4)
    bench = spark.createDataFrame([(None, None), (1, "new words " * 10), (1, "new words " * 10)], "item_id long, text string")
    labels = spark.createDataFrame([(rows[0][0], 1, 0), (rows[0][0], 1, 0), (rows[5][0], 0, 0), (None, 1, 0), (rows[7][0], None, 0)], "doc_id long, quality int, toxic int")
    want = Counter(r[0] for r in odd)
    for out in (
        quality_rules.measure(docs), token_cache.count_tokens(docs, cache=storage.new_path(spark, "t")), sharding.shard(docs, 3), suffix_dedup.measure(docs), substring_dedup.measure(docs), simhash.near_duplicates(docs),
        similar.near_duplicates(docs), hmm_lm.score(docs), pairwise_quality.rank(docs, labels), substring_dedup.strip_documents(docs),
    ):
        assert Counter(r.doc_id for r in out.select("doc_id").collect()) == want
    assert {r.doc_id for r in packing.pack(docs).collect()} == set(want)
    assert decontaminate.leaks(docs, bench).where("doc_id is null").count() == 1
    assert None not in {r.doc_id for r in decontaminate.clean_documents(docs, bench).collect()}


def test_hot_keys_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    df = spark.range(3000).select(half_hot().alias("key"), "id")
    table = storage.stage(df.groupBy("key").count().selectExpr("key", "count n", "key * 2 twice").where("key <> 5"), "t")
    got = storage.lookup(df, table, ["key"], "n").collect()
    assert len(got) == 3000 and all(r.twice == (None if r.key == 5 else r.key * 2) for r in got)


def half_hot():
    from pyspark.sql import functions as F

    return F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1500)
