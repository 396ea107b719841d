import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docprep.llm import packing
from docprep.llm.packing import best_fit, fill_rates, first_id, merged_partitions, pack
from docprep.llm.tokens import encoding, with_token_counts

SPECS = "spec_id int, capacity_tokens int, gap_tokens int"


def plain_best_fit(sizes, capacity, gap):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in range(len(rooms)) if rooms[r] >= s + gap]
        if fits:
            b = min(fits, key=lambda r: rooms[r])
            rooms[b] -= s + gap
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(0, 3))
def test_best_fit_equals_the_plain_algorithm(sizes, gap):
    bins = best_fit(sizes, 50, gap)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert sorted(50 - sum(sizes[i] for i in b) - gap * (len(b) - 1) for b in bins) == plain_best_fit(sizes, 50, gap)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_every_item_once_and_little_waste(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice([rng.randint(1, 60), rng.randint(60, 400)]), 7, 1) for i in range(3000)] + [(9000, 1700, 7, 1), (9001, 0, 7, 1), (9002, None, 7, 1), (None, 5, 7, 1), (9003, 300, 7, 1), (9003, 300, 7, 1)]
    items = spark.createDataFrame(rows, "doc_id bigint, n bigint, spec_id int, position int").repartition(parts)
    specs = spark.createDataFrame([(1, 512, 1), (2, 256, 0), (2, 256, 0)], SPECS)
    packed = pack(items, "doc_id", "n", specs).cache()
    for spec, capacity, gap in ((1, 512, 1), (2, 256, 0)):
        got = packed.where(F.col("spec_id") == spec).collect()
        by, whole = {}, {}
        for r in got:
            by.setdefault(r.container_id, []).append(r)
            whole.setdefault(r.doc_id, []).append(r)
        for items_in in by.values():
            assert sum(r.n_tokens for r in items_in) + gap * (len(items_in) - 1) <= capacity
            assert sorted(r.position for r in items_in) == list(range(len(items_in)))
        assert set(whole) == {r[0] for r in rows}
        for doc_id, n, *_ in rows:
            mine = sorted(whole[doc_id], key=lambda r: r.piece_no)
            copies = 2 if doc_id == 9003 else 1
            assert sum(r.n_tokens for r in mine) == (n or 0) * copies and len(mine) == copies * max(1, -(-(n or 0) // capacity))
            assert all(r.start_token == r.piece_no * capacity for r in mine)
        least = sum(max(1, r.n_tokens) + gap for r in got) / (capacity + gap)
        assert len(by) <= 1.03 * least + 2
    rates = {r.spec_id: r for r in fill_rates(packed, specs).collect()}
    assert 0.95 < rates[1].fill <= 1 and rates[2].tokens == sum(r[1] or 0 for r in rows)


def test_items_that_never_fit_together_end(spark):
    items = spark.range(500).select("id", F.lit(300).alias("n")).repartition(30)
    packed = pack(items, "id", "n", spark.createDataFrame([(1, 512, 0)], SPECS))
    assert packed.select("container_id").distinct().count() == 500


def test_empty_table_and_wrong_specs(spark):
    none = spark.createDataFrame([], "doc_id bigint, n bigint")
    assert pack(none, "doc_id", "n", spark.createDataFrame([(1, 5, 0)], SPECS)).count() == 0
    for bad in ([(1, 0, 0)], [(None, 5, 0)], [(1, 5, 0), (1, 6, 0)]):
        with pytest.raises(ValueError):
            pack(none, "doc_id", "n", spark.createDataFrame(bad, SPECS))


def test_token_counts_are_those_of_the_vocabulary(spark):
    texts = ["Hello world", "", None, "naïve 漢字 \U0001f48a", "<|endoftext|>", "word " * 20_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, n_tokens string")
    out = {r.id: r.n_tokens for r in with_token_counts(df, "text", ["id"]).collect()}
    e = encoding()
    assert out == {i: len(e.encode_ordinary(t or "")) for i, t in enumerate(texts)} and e.decode(e.encode_ordinary(texts[3])) == texts[3]


def test_numbers_of_tasks_do_not_meet():
    firsts = sorted(first_id(r, p) for r in range(32) for p in (0, 1, 2**18 - 1, 2**18, 2**18 + 1, 2**28 - 1))
    assert all(b - a >= 2**30 for a, b in zip(firsts, firsts[1:])) and 0 <= firsts[0] and firsts[-1] + 2**30 <= 2**63
    for bad in ((32, 0), (0, 2**28), (-1, 0)):
        with pytest.raises(ValueError):
            first_id(*bad)


def test_merging_is_bounded():
    parts, left, seen = 2**20, 10**10, []
    while True:
        merged = merged_partitions(parts, left, 8)
        if merged == parts:
            break
        parts, left = merged, int(left * 0.9)
        seen.append(left / parts)
    assert max(seen) <= packing.MERGED and merged_partitions(8, 5, 8) == 1 and merged_partitions(1, 0, 8) == 1


def test_later_rounds_stop_at_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 10)
    rng = random.Random(5)
    items = spark.createDataFrame([(i, rng.randint(100, 300)) for i in range(3000)], "id bigint, n bigint").repartition(40)
    packed = pack(items, "id", "n", spark.createDataFrame([(1, 512, 0)], SPECS)).collect()
    assert sorted(r.id for r in packed) == list(range(3000))
    loads = {}
    for r in packed:
        loads[r.container_id] = loads.get(r.container_id, 0) + r.n_tokens
    assert max(loads.values()) <= 512
