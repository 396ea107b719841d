import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docprep.llm.mixing import Target, mix, water_fill

TARGETS = "source string, target_share double, max_repeats int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 100).map(lambda w: w / 100), st.integers(0, 5)), min_size=1, max_size=8), st.integers(0, 4000))
def test_water_fill(sources, total):
    sizes = {str(i): s for i, (s, *_) in enumerate(sources)}
    targets = [Target(str(i), w, k) for i, (_, w, k) in enumerate(sources)]
    out = water_fill(sizes, targets, total)
    most = {t.source: t.cap * sizes[t.source] for t in targets}
    reachable = sum(most[t.source] for t in targets if t.share > 0)
    assert all(0 <= out[s] <= most[s] + 1e-6 for s in out) and sum(out.values()) == pytest.approx(min(total, reachable))
    rates = {out[t.source] / t.share for t in targets if t.share > 0 and 0 < out[t.source] < most[t.source] - 1e-6}
    assert not rates or max(rates) == pytest.approx(min(rates), rel=1e-6)
    full = [out[t.source] / t.share for t in targets if t.share > 0 and most[t.source] and out[t.source] >= most[t.source] - 1e-6]
    assert not rates or all(f <= max(rates) * (1 + 1e-6) for f in full)


def test_mix(spark):
    rng = random.Random(1)
    docs = [(i, rng.choice(["A-b", "a_B ", "A b"]), rng.randint(1, 40), "x") for i in range(4000)]
    docs += [(10_000 + i, "small", rng.randint(1, 40), "x") for i in range(60)] + [(20_000 + i, "tiny", 10, "x") for i in range(5)]
    docs += [(30_000, None, 10, "x"), (30_001, "other", 10, "x"), (30_002, "a_b", None, "x"), (None, "a_b", 3, "x"), (20_000, "tiny", 10, "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, n bigint, repeats string")
    targets = spark.createDataFrame([("a_b", 0.6, 1), ("small", 0.3, 40), ("tiny", 0.1, 3), ("absent", 0.0, 2), (None, 0.5, 1)], TARGETS)
    plan, shares = mix(df, "doc_id", "source", "n", targets, total=50_000, seed=3)
    rows = plan.collect()
    assert len(rows) == len(docs)
    by = {r.source: r for r in shares.collect()}
    assert by["tiny"].tokens == 3 * 60 and by["absent"].tokens == 0 and sum(r.actual_share for r in by.values()) == pytest.approx(1)
    for s in ("a_b", "small"):
        assert abs(by[s].tokens - by[s].planned_tokens) <= 40
        repeats = {r.repeats for r in rows if r.source == s}
        assert max(repeats) - min(repeats) <= 1 and by[s].tokens == sum(r.repeats * r.n_tokens for r in rows if r.source == s)
    assert by["a_b"].planned_tokens / by["small"].planned_tokens == pytest.approx(2, rel=1e-3)
    assert {r.repeats for r in rows if r.doc_id in (30_000, 30_001)} == {0}
    again = {(r.doc_id, r.n_tokens, r.repeats) for r in mix(df.repartition(9), "doc_id", "source", "n", targets, total=50_000, seed=3)[0].collect()}
    assert again == {(r.doc_id, r.n_tokens, r.repeats) for r in rows}
    other = {(r.doc_id, r.repeats) for r in mix(df, "doc_id", "source", "n", targets, total=50_000, seed=4)[0].collect()}
    assert other != {(r.doc_id, r.repeats) for r in rows}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, n bigint")
    targets = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    plan, shares = mix(none, "doc_id", "source", "n", targets)
    assert plan.count() == 0 and [r.actual_share for r in shares.collect()] == [0]
    docs = spark.createDataFrame([(1, "a", 5)], "doc_id bigint, source string, n bigint")
    plan, shares = mix(docs, "doc_id", "source", "n", targets.limit(0))
    assert [r.repeats for r in plan.collect()] == [0] and shares.count() == 0
