import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docprep.llm.components import components
from docprep.llm.neardup import member_pairs, near_duplicate_groups, near_duplicates
from docprep.llm.sketch import banding, character_shingles, paired_jaccard, prob_minhash, shingles, weighted_jaccard, weights, words


def edited(rng, vocabulary, base, rate):
    out = []
    for w in base:
        x = rng.random()
        out += [] if x < rate / 3 else [rng.choice(vocabulary)] if x < rate else [w]
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(45, 120))]
        rows += [base] + [edited(rng, vocabulary, base, rng.choice([0, 0.02, 0.06, 0.2])) for _ in range(3)]
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def brute(rows, n, threshold, least):
    sets = {}
    for i, t in rows:
        w = "".join(c if c.isascii() and c.isalnum() else " " for c in (t or "").lower()).split()
        s = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        if s and len(s) >= least:
            sets[i] = s
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


@pytest.mark.parametrize("n,threshold,least", [(3, 0.6, 40), (5, 0.8, 1)])
def test_pairs_equal_brute_force(spark, n, threshold, least):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "a b"), (1003, "Same text " * 60), (1004, "same  TEXT " * 60)]
    links, members = near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text"), n, threshold, least)
    assert {tuple(r) for r in member_pairs(links, members).collect()} == brute(rows, n, threshold, least)


def test_groups_copies_and_links(spark):
    base = " ".join(f"x{i}" for i in range(100))
    rows = [(5, base), (3, base + "!"), (9, base + " tail"), (7, "other " * 3 + base[:40]), (None, base)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "id bigint, text string, n int, class_id int")
    out = {r.id: tuple(r)[1:] for r in near_duplicate_groups(*near_duplicates(df, "id", F.col("text"))).collect()}
    assert out[5] == out[3] == (3, 3, 1) and out[9] == (9, 3, 1) and out[7] == (7, 7, 0) and None not in out


def test_empty_table(spark):
    links, members = near_duplicates(spark.createDataFrame([], "id bigint, text string"), "id", F.col("text"))
    assert links.count() == members.count() == member_pairs(links, members).count() == near_duplicate_groups(links, members).count() == 0


def test_words_follow_the_definition():
    owner, h = words(["Aa-b1 é a", None, "", "B1"])
    assert owner.tolist() == [0, 0, 0, 3] and h[1] == h[3] and h[0] != h[2]


def test_sketch_estimates_probability_jaccard():
    texts = ["a b c d e f g h i j k l m n o p q r s t"] * 1 + ["a b c d e f g h i j k l m n o x y z u v"]
    owner, h, *_ = shingles(texts, 1)
    sig = prob_minhash(owner, h, np.ones(len(h)), 2, 4000)
    assert abs((sig[0] == sig[1]).mean() - 15 / 25) < 0.04
    weight = np.where(owner == 0, 1.0, 3.0)  # probability Jaccard doesn't depend on a text's total weight
    assert abs((lambda s: (s[0] == s[1]).mean())(prob_minhash(owner, h, weight, 2, 4000)) - 15 / 25) < 0.04


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8, 0.95, 1.0])
def test_bands_miss_little(threshold):
    bands, rows = banding(threshold)
    assert threshold == 1 or (1 - threshold**rows) ** bands <= 1e-5


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3)]
    out = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect())
    assert out == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


@pytest.mark.parametrize("weighting,unit,n", [("count", "word", 1), ("opening", "character", 3)])
def test_weighted_links_equal_brute_force(spark, weighting, unit, n):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(60):
        base = [rng.choice(vocabulary[:20]) if rng.random() < 0.7 else rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        rows += [base] + [edited(rng, vocabulary, base, rng.choice([0, 0.05, 0.15])) for _ in range(2)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]

    def shares(t):
        parts = t.split() if unit == "word" else [f" {t} "[k : k + n] for k in range(len(t) + 2 - n + 1)]
        weight = {}
        for k, p in enumerate(parts):
            weight[p] = weight.get(p, 0) + 1 if weighting == "count" else weight.get(p, 2 ** (-k / 16))
        total = sum(weight.values())
        return {p: w / total for p, w in weight.items()}

    def similarity(a, b):
        common = sum(min(a[p], b[p]) for p in a.keys() & b.keys())
        return common / (2 - common)

    sets = {i: shares(t) for i, t in rows}
    wanted = {(a, b) for a in sets for b in sets if a < b and similarity(sets[a], sets[b]) >= 0.6}
    links, members = near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text"), n, 0.6, 1, weighting, unit)
    found = {tuple(r) for r in member_pairs(links, members).collect()}
    assert len(wanted) > 50 and found <= wanted and len(found) >= 0.99 * len(wanted)


@pytest.mark.parametrize("most", [1, 50, 1_000_000])
def test_similarities_of_many_pairs_equal_those_of_each(most):
    texts = ["", "ab", "the passage is silent on gout", "silent on gout the passage is", "对不起我无法回答这个问题", "对不起我无法回复这个问题", "aaaa " * 200]
    owner, h, count, first = sets = character_shingles(texts, 3)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(1, len(texts)), np.arange(1, len(texts))))
    weight = weights("opening", count, first)
    wanted = [weighted_jaccard(h[owner == x], weight[owner == x], h[owner == y], weight[owner == y]) for x, y in zip(a, b)]
    assert np.allclose(paired_jaccard(sets, "opening", len(texts), a, b, most), wanted)
    assert len(paired_jaccard(character_shingles([], 3), "opening", 0, a[:0], b[:0], most)) == 0
