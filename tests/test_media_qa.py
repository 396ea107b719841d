import random

import pytest
from pyspark.sql import functions as F

from docprep.operators import media as M
from docprep.operators import qa

ELEMENTS = "doc_id string, pos int, Path string, Text string, Page int, ObjectID bigint, filePaths array<string>"


def tree(seed):
    rng = random.Random(seed)
    out = []
    for pos in range(25):
        path = "//Document/" + "/".join(rng.choice(["T", "T[1]", "F", "P"]) for _ in range(rng.randint(1, 3)))
        out.append(("d", pos, path, rng.choice([None, "", "x", "y"]), 0, pos, rng.choice([None, None, None, ["a1.x"], ["a1.x", "b.y"], ["a10.x"]])))
    return out


def plain_inventory(rows):
    general, number, order = {}, {}, {}
    for _, pos, path, _, _, oid, files in rows:
        if files is not None:
            general[tuple(files)], number[tuple(files)] = path + "/", oid
            order.setdefault(tuple(files), pos)
    out = {}
    for k, g in general.items():
        under = [r for r in rows if r[3] is not None and (r[2] + "/" == g or r[2].startswith(g))]
        out[", ".join(k)] = (number[k], g, [r[2] for r in under], [r[3] for r in under], order[k])
    return out


@pytest.mark.parametrize("seed", range(5))
def test_inventory_equals_the_loop(spark, seed):
    rows = tree(seed)
    got = {r.files: (r.object_id_file, r.general_path, r.specific_paths, r.texts, r.ord) for r in M.media_inventory(spark.createDataFrame(rows, ELEMENTS)).collect()}
    assert got == plain_inventory(rows)


def plain_merge(files, old, names, fill):
    state = old
    for name, summary in names:
        if summary is None or fill and not (old is None or old == M.ERROR_SUMMARY):
            continue
        if fill and not (state is None or state == M.ERROR_SUMMARY):
            continue
        if any(name in f for f in files.split(", ")):
            state = summary if state is None else state + "\n" + summary
    return state


def test_merges_equal_the_loop(spark):
    rng = random.Random(3)
    names = [("a1", "one"), ("a10", M.ERROR_SUMMARY), ("b", None), ("a", "short"), ("b.y", "two"), ("a1", M.ERROR_SUMMARY)]
    rng.shuffle(names)
    sheet = [("d", i, f, s) for i, (f, s) in enumerate((f, s) for f in ("a1.x", "a10.x, b.y", "c", "b.y") for s in (None, "old", M.ERROR_SUMMARY))]
    left = spark.createDataFrame(sheet, "doc_id string, ord int, files string, summary string")
    right = spark.createDataFrame([("d", n, i, s) for i, (n, s) in enumerate(names)] + [("other", "a1", 0, "no")], "doc_id string, name string, ord int, summary string")
    for fill, merge in ((False, M.merge_summaries), (True, M.fill_summaries)):
        got = {r.ord: r.summary for r in merge(left, right, ("ord",), "name").collect()}
        assert got == {i: plain_merge(f, s, names, fill) for _, i, f, s in sheet}


@pytest.mark.parametrize("match", ["substring", "exact"])
@pytest.mark.parametrize("seed", range(4))
def test_write_back_equals_the_loop(spark, seed, match):
    rows = tree(seed)
    rng = random.Random(seed)
    sheet = [("d", i, rng.randint(0, 24), rng.choice([None, "s1", "s2"]), [r[2] for r in rng.sample(rows, 3)]) for i in range(6)]
    text = {r[1]: r[3] for r in rows}
    for _, _, oid, summary, paths in sheet:
        for r in rows:
            if r[5] == oid and r[6] is not None:
                text[r[1]] = summary
            elif r[6] is None and (r[2] in str(paths) if match == "substring" else r[2] in paths):
                text[r[1]] = ""
    df = spark.createDataFrame(sheet, "doc_id string, ord int, object_id_file bigint, summary string, specific_paths array<string>")
    assert {r.pos: r.Text for r in M.write_back(spark.createDataFrame(rows, ELEMENTS), df, match).collect()} == text


def test_word_validity(spark):
    texts = spark.createDataFrame([(1, "The cat sat xyzzy"), (2, ""), (3, None), (4, "a of"), (5, "Cat cat cat")], "id int, t string")
    out = {r.id: tuple(r)[1:] for r in M.word_validity(texts, "id", "t", spark.createDataFrame([("the",), ("cat",), ("cat",), ("sat",)], "word string")).collect()}
    assert out == {1: (4, 3, True), 2: (0, 0, False), 3: (0, 0, False), 4: (0, 0, False), 5: (3, 3, False)}


def test_usable_chunks(spark):
    rows = [("a", "x" * 100), ("a", "x" * 101), (None, "x" * 200), ("a", None), ("a", "≥" * 5)]
    got = qa.usable_chunks(spark.createDataFrame(rows, "section_name string, text_chunk string")).collect()
    assert sorted(len(r.text_chunk) for r in got) == [101, 120]


REPLY = "**Question 1:** What is the Answer?\n**Answer:** First *bold*\nline.\n\n**Question 2:** Why?\n**Answer:**  Because.\nQuestion 3: How?\nAnswer: So"


def test_pairs_of_a_reply(spark):
    found = lambda t: [tuple(x) for x in spark.createDataFrame([(t,)], "t string").select(qa.qa_pairs(F.col("t"))).first()[0]]
    first, *rest = found(REPLY)
    assert rest == [("Why?", "Because."), ("How?", "So")] and first[0] == "What is the Answer?" and first[1].endswith("First bold\nline.")
    assert found("no pairs") == [] and found("") == []


def test_rows_of_replies(spark):
    df = spark.createDataFrame([(REPLY, "T", "S", [1, 2], "ctx"), ("", "T", "S", [1], "c")], "full_text string, Title string, section_name string, pages array<int>, text_chunk string")
    rows = qa.qa_rows(df).orderBy("pair_no").collect()
    assert [r.pair_no for r in rows] == [0, 1, 2] and rows[1].contexts == "ctx" and rows[1].reference.endswith("Section S, Pages [1, 2]") and rows[1].Flag_Source == 0
    assert qa.flagged(qa.qa_rows(df)).count() == 0 and qa.scorable(qa.qa_rows(df)).count() == 3
    assert [r.row_no for r in qa.numbered_rows(qa.qa_rows(df), ["Title"], ["pair_no"]).collect()] == [1, 2, 3]
    assert [r.pair_no for r in qa.slice_rows(qa.qa_rows(df), ["pair_no"], 1, 3).collect()] == [1, 2]


def test_names_of_any_length_and_repeated_summaries(spark):
    sheet = spark.createDataFrame([("d", 1, "tables/fileoutpart12.xlsx, a.png", None), ("d", 2, "b", None), ("d", 3, None, None), (None, 4, "b", None)], "doc_id string, ord int, files string, summary string")
    names = [("d", "fileoutpart1", 0, "in twelve"), ("d", "fileoutpart12", 1, "twelve"), ("d", "outpart2", 2, "no"), ("d", "a", 3, "short"), ("d", "a", 3, "short"), ("d", "", 4, "all"), ("d", None, 5, "none"), ("e", "b", 0, "other")]
    right = spark.createDataFrame(names, "doc_id string, name string, ord int, summary string")
    got = {r.ord: r.summary for r in M.merge_summaries(sheet, right, ("ord",), "name").collect()}
    assert got == {1: "in twelve\ntwelve\nshort\nshort\nall", 2: "all", 3: None, 4: None}
    assert M.merge_summaries(sheet.limit(0), right, ("ord",), "name").count() == 0


def test_word_validity_with_a_large_vocabulary(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "The cat sat xyzzy"), (None, "the"), (2, "Cat " * 1000)], "id int, t string")
    vocabulary = spark.createDataFrame([("the",), ("cat",), (None,), ("sat",)], "word string")
    small = sorted(map(tuple, M.word_validity(texts, "id", "t", vocabulary).collect()), key=repr)
    monkeypatch.setattr(M, "MOST_WORDS", 2)
    assert sorted(map(tuple, M.word_validity(texts, "id", "t", vocabulary).collect()), key=repr) == small
    assert M.word_validity(texts, "id", "t", vocabulary.limit(0)).where("n_valid > 0").count() == 0


@pytest.mark.parametrize(
    "reply,pairs",
    [
        ("Sure!\n**Question 1:** A?\n**Answer:** B\n\nQuestion 2: C?\nAnswer: D", [("A?", "B"), ("C?", "D")]),
        ("**Question 1:** no answer\n**Question 2:** C?\n**Answer:** D", [("C?", "D")]),
        ("Question 1: A?\nand more?\nAnswer: B\nAnswer: C", [("A?\nand more?", "B\n C")]),
        ("**Question 1:** A?\n**Answer:**", [("A?", "")]),
        ("Answer: B\nQuestion", []),
    ],
)
def test_replies_are_cut_at_their_labels(spark, reply, pairs):
    assert [tuple(x) for x in spark.createDataFrame([(reply,)], "t string").select(qa.qa_pairs(F.col("t"))).first()[0]] == pairs
