import re

import pytest

from docprep.llm.lookalike import LookAlikes, confusables, consistent_form


@pytest.fixture(scope="module")
def known(spark):
    return LookAlikes(*confusables(spark))


CASES = {
    "Ａbc１": "Abc1", "ﬁt": "fit", "3.9 K": "3.9 K", "2 Å": "2 Å", "naïve": "naïve", "a​b": "ab", "a­b": "ab", "﻿a": "a",
    "a b　c": "a b c", "fоr": "for", "а": "a", "νο": "vo", "diaɡnosis": "diagnosis", "yoս": "you", "cс²": "cc²", "x́": "x́",
    "（用法）": "(用法)",
}
PLAIN = ["", "naïve", "Дозировка", "β-blocker", "ν", "m² µg ≥", "\U0001f48a", "\U0001f468‍⚕️", "K⁺", "x\ty\r\n\x0c", "、用法", "a b"]


@pytest.mark.parametrize("text,form", CASES.items())
def test_cases_and_their_form(known, text, form):
    assert known.look_alike(text) == (form, True) and re.search(known.suspect_pattern, text)


@pytest.mark.parametrize("text", PLAIN)
def test_no_cases(known, text):
    assert known.look_alike(text) == (text, False)


def test_form_is_stable_and_tables_are_whole(known):
    assert all(known.look_alike(form)[0] == form for form in CASES.values())
    assert len(known.posing) > 250 and all(len(b) == 1 and b.isascii() and b.isalpha() for b in (known.posing | known.near).values())
    # letters of each script that the standard lists, and none that is Latin or runs from right to left
    assert {"а": "a", "Ν": "N", "ο": "o", "ս": "u", "Ꭺ": "A", "ꓐ": "B", "ɡ": "g", "ꜱ": "s", "ϲ": "c", "І": "I", "ӏ": "l"}.items() <= {chr(c): b for c, b in known.posing.items()}.items()
    assert not {ord(c) for c in "aéıſøαβא".replace("α", "").replace("β", "") + "اه"} & set(known.posing | known.near)


@pytest.mark.parametrize("text,form,case", [("\U0001d407ello", "Hello", False), ("\u210e", "h", False), ("нет", "нет", False), ("nет", "net", True), ("\u043aidney", "kidney", True), ("\u03baidney", "kidney", True), ("\ua731alt", "salt", True), ("ᴀspirin", "aspirin", True), ("\u24d7", "\u24d7", False), ("κατα", "κατα", False)])
def test_styled_and_near_letters(known, text, form, case):
    assert known.look_alike(text) == (form, case)


def test_rows_of_a_class_get_one_form(spark):
    texts = ["naïve Ａ", "naïve A", "naïve A", "naïve​ A", "naive A", "Naïve A", None, "", "​"]
    rows = [(i, t, "clash", True) for i, t in enumerate(texts)] + [(0, texts[0], "clash", True), (100, "word оn " * 30_000, "", False)]
    out = consistent_form(spark.createDataFrame(rows, "id int, text string, form string, is_case boolean"), "text", ["id"]).collect()
    assert len(out) == len(rows)
    form = {r.id: r.form for r in out}
    assert form[0] == form[1] == form[2] == form[3] == "naïve A"
    assert form[4] == "naive A" and form[5] == "Naïve A" and form[6] is None and form[7] == form[8] == "" and form[100] == "word on " * 30_000
    assert {r.id for r in out if r.is_case} == {0, 1, 3, 8, 100}


def test_empty_table(spark):
    assert consistent_form(spark.createDataFrame([], "id int, text string"), "text", ["id"]).count() == 0


def test_the_suspect_pattern_reads_alike_in_java(spark, known):
    from pyspark.sql import functions as F

    rows = [(t, True) for t in CASES] + [(t, False) for t in PLAIN if t == known.look_alike(t)[0] and not re.search(known.suspect_pattern, t)]
    df = spark.createDataFrame(rows, "text string, wanted boolean")
    assert df.where(F.col("text").rlike(known.suspect_pattern) != F.col("wanted")).count() == 0


@pytest.mark.parametrize("text,form", [("38°\u200dC", "38°C"), ("x^\u200dy", "x^y"), ("™\u200ea", "™a"), ("\U0001f48a\u200d a", "\U0001f48a a")])
def test_joiners_outside_pictures_print_nothing(known, text, form):
    assert known.look_alike(text) == (form, True)
