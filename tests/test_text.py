import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docprep.functions import text as X
from docprep.functions.json_repair import relevancy_items, reply_objects, statement_verdicts
from docprep.functions.splitter import split_column, split_recursively

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("r")).first().r


def test_strip_and_split_follow_python(spark):
    texts = [a + "x" + b + "y" + c for a in ("", *SPACES) for b, c in ((" ", "\xa0"), (" \n", ""))] + ["", SPACES, "​x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.strip(F.col("t")).alias("s"), X.split_words(F.col("t")).alias("w")).collect()
    assert all(r.s == r.t.strip() and r.w == r.t.split() for r in rows)


@pytest.mark.parametrize("reply", ['```json\n{"a": 1}\n```', "null", "```x```", "", "`\njson{}", "plain"])
def test_fences_go_as_sets_of_characters(spark, reply):
    assert one(spark, X.strip_fence(F.col("t")), t=reply) == reply.strip("```json\n").strip("```")


@pytest.mark.parametrize("reply,bare", [('```json\n{"a":\n1}\n```', '{"a":\n1}'), ("```x", "```x"), ("x\ny", "x\ny")])
def test_fence_lines(spark, reply, bare):
    assert one(spark, X.drop_fence_lines(F.col("t")), t=reply) == bare


def test_signs_flags_and_citation(spark):
    assert one(spark, X.replace_all(F.col("t"), X.PADDED_SIGNS), t="a≥b<c") == "a more than or equals to b less than c"
    df = spark.createDataFrame([("What does THIS Source say?",), ("What?",), (None,)], "q string")
    assert [r[0] for r in df.select(X.speaks_of_source(F.col("q"))).collect()] == [1, 0, 0]
    row = spark.createDataFrame([("T", "1.2", [3, 4])], "t string, s string, p array<int>").select(X.citation(F.col("t"), F.col("s"), F.col("p"))).first()
    assert row[0] == "For more information, refer to clinical protocol T, Section 1.2, Pages [3, 4]"


def plain_prose(n, cells):
    parts = [f"In row {n},"]
    for i, (c, v) in enumerate(cells):
        v = ("nan" if v is None else v).strip().replace("\n", " ").replace("\r", "")
        if v:
            parts += [f"The {c} is: {v}", ". " if i < len(cells) - 1 else "."]
    return " ".join(parts).strip()


@pytest.mark.parametrize("values", [("x", "y"), ("", "y"), ("x", ""), (None, " a\nb\r "), ("", ""), ("\xa0", "z")])
def test_row_prose(spark, values):
    got = one(spark, X.row_prose(F.lit(1), [("A", F.col("a")), ("B", F.col("b"))]), a=values[0], b=values[1])
    assert got == plain_prose(1, list(zip("AB", values)))


def items(spark, reply):
    found = one(spark, statement_verdicts(reply_objects(F.col("t"))), t=reply)
    return found if found is None else [tuple(x) for x in found]


def test_replies_that_need_repair(spark):
    flat = '{"statement_1": "a", "reason": "r", "verdict": "1"}'
    two = '{"statement_2": "b", "reason": "s", "verdict": "0"}'
    want = [("a", "r", "1"), ("b", "s", "0")]
    for reply in (f"[{flat}, {two}]", f"```json\n[{flat},{two}]\n```", f"{flat}{two}", f"{flat}, {two},", f"{flat}\n{two}", f"[{flat},{two}, ]"):
        assert items(spark, reply) == want, reply
    assert items(spark, flat) == want[:1]
    nested = '{"statement_1": {"text": "a", "reason": "r", "verdict": "1"}, "statement_2": {"text": "b", "reason": "s", "verdict": 0}}'
    assert items(spark, nested) == want
    assert items(spark, '[{"statement_1": "a", "reason": "r"}]') == [("a", "r", None)]
    assert not items(spark, "no json") and items(spark, "") is None and items(spark, "[{}]") == []


def test_relevancy_replies(spark):
    both = lambda t, flat=False: [tuple(x) for x in one(spark, relevancy_items(F.col("t"), flat), t=t)]
    assert both('{"questions": ["a", "b"], "noncommittal": 1}') == [("a", 1), ("b", 1)]
    assert both('```json\n{"questions": [{"question": "a", "noncommittal": 0}]}\n```') == [("a", 0)]
    assert both('{"questions": ["a"]}\n{"questions": ["b"], "noncommittal": 1}') == [("a", 0), ("b", 1)]
    assert both("") == [] and both('{"question": "a"}') == [] and both('{"question": "a"}', True) == [("a", 0)]


TEXT = st.text(alphabet="ab \n\xa0é", max_size=400)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(20, 60), st.integers(0, 9))
def test_splitter_keeps_order_size_overlap_and_text(text, size, overlap):
    at, kept = 0, set()
    for piece in split_recursively(text, size, overlap):
        assert 0 < len(piece) <= size and piece == piece.strip()
        begin = text.index(piece, max(0, at - overlap))
        kept |= set(range(begin, begin + len(piece)))
        at = begin + len(piece)
    if not re.search(r"(.{2,20})\1", text, re.S):
        assert all(text[i].isspace() for i in set(range(len(text))) - kept)


def test_splitter_on_long_words_and_in_columns(spark):
    assert [len(p) for p in split_recursively("x" * 7000)] == [3000, 3000, 1200]
    df = spark.createDataFrame([(1, "a" * 3000), (2, "b " * 2000), (3, ""), (4, None)], "i int, t string")
    out = {r.i: r.p for r in df.select("i", split_column(F.col("t")).alias("p")).collect()}
    assert out[1] == ["a" * 3000] and [len(p) for p in out[2]] == [len(p) for p in split_recursively("b " * 2000)] and out[3] == [""] and out[4] == [None]


def test_json_of_prompts_is_whole():
    from docprep.operators.models import PROMPTS

    assert all(p.format(question="q", answer="a", context="c", statements="s", ground_truth="g", section="s", source="o", text="t") for p in PROMPTS.values()) and json
