"""The whole job of operators, where they once did less."""

from __future__ import annotations

import random

import numpy as np
import pytest

from volcohort.llm import quality_rules, similar, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long"


def test_texts_without_common_words_go(spark):
    """Common words evenly spread: their distance from none at all is below MAX_WORD_DISTANCE at any length."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common = quality_rules.COMMON_WORDS["en"]
    good = [" ".join(rng.choice(common) if rng.random() < 0.27 else word() for _ in range(n)) for n in [40, 60, 400] * 20]
    bad = [" ".join(word() for _ in range(n)) for n in (40, 120, 2000)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in enumerate(good + bad)], SCHEMA)
    assert all(r.word_distance < quality_rules.MAX_WORD_DISTANCE for r in quality_rules.measure(df).collect())
    assert {r.doc_id for r in quality_rules.filter_documents(df).collect()} == set(range(60))


def groups(texts: list[str]) -> list[int]:
    """The smallest place that links of similarity 0.8 reach, by trying all pairs."""
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    link = [[b for b in range(len(sets)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])] for a in range(len(sets))]
    name, before = list(range(len(sets))), None
    while name != before:
        name, before = [min(name[b] for b in near) for near in link], name
    return name


@pytest.mark.parametrize("block", [2048, 16])
def test_long_lists_lose_no_link(spark, monkeypatch, block):
    """Texts around one shared passage: in one long list, with links of just 0.8 beside nearer fingerprints that fail."""
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(109)]
    texts = []
    for _ in range(50):
        own = [f"q{rng.randrange(10**6)}" for _ in range(14)]
        texts += [" ".join([*passage, *own[:n], *(f"r{rng.randrange(10**6)}" for _ in range(14 - n))]) for n in (0, 4, 8)]
    monkeypatch.setattr(similar, "BLOCK", block)
    df = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want = dict(enumerate(groups(texts)))
    assert len(set(want.values())) == 100
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(df).collect()} == want


def test_weak_links_are_found(spark):
    """Pairs just above a similarity of 0.8, by words appended or a block replaced: few positional bytes agree."""
    rng = random.Random(22)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    texts = []
    for n in (24, 60, 240):
        for _ in range(40):
            words, changed = fresh(n), int(0.09 * n) - 2
            at = rng.randrange(5, n - changed - 5)
            texts += [" ".join(words), " ".join(words + fresh(int(0.23 * (n - 4))))]
            words = fresh(n)
            texts += [" ".join(words), " ".join([*words[:at], *fresh(changed), *words[at + changed :]])]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want = dict(enumerate(groups(texts)))
    assert sum(a != b for a, b in want.items()) > 150
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(df).collect()} == want


def test_odd_white_space_is_kept(spark):
    """Only blank and 0x09 to 0x0D part words; other white space is part of them."""
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, passage), (2, f"\u00a0first {passage} last\u3000"), (3, f"\x1c {passage} \x85")]
    out = substring_dedup.strip_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out} == {1: passage, 2: "\u00a0first last\u3000", 3: "\x1c \x85"}


def test_words_of_one_polynomial_name_differ(spark):
    """Thue-Morse words and their complements agree in any polynomial of an odd base modulo 2^64, but aren't equal."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    morse, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    side = [f"w{i}" for i in range(10)]
    rows = [(1, " ".join([*side, morse, *side])), (2, " ".join([*side, other, *side])), (3, " ".join([*side, morse, *side]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.measure(df).collect()} == {1: 0, 2: 0, 3: 21}
    assert {r.doc_id: r.text for r in substring_dedup.strip_documents(df).collect()} == {1: rows[0][1], 2: rows[1][1], 3: ""}


def test_names_of_words_tell_all_bytes():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([1, 7, 8, 9, 16, 17, 5000]))) for _ in range(3000)})
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    a, b = substring_dedup.word_bounds(data, np.array([0]))
    assert all(len(set(x.tolist())) == len(words) for x in substring_dedup.word_names(data, a, b))
    at = np.array([a[-1]]), np.array([b[-1]])
    alone = substring_dedup.word_names(np.frombuffer(words[-1].encode(), np.uint8), np.array([0]), np.array([len(words[-1])]))
    assert [int(x[0]) for x in substring_dedup.word_names(data, *at)] == [int(x[0]) for x in alone]
