import random

import pytest


from pyspark.sql import functions as F

from docprep.operators import chunks as C
from docprep.operators import sections as S
from docprep.plans.pipeline import chunk_documents, chunk_new_documents
from docprep.profiles import PROFILES

ELEMENTS = "doc_id string, pos int, Path string, Text string, Page int, ObjectID bigint, filePaths array<string>, profile string"


def document(profile, rows, doc_id="d"):
    return [(doc_id, i, path, text, i // 3, 100 + i, files, profile) for i, (path, text, *rest) in enumerate(rows) for files in [rest[0] if rest else None]]


def summary(spark, rows, profile="profile", block=S.BLOCK):
    out = S.classify(spark.createDataFrame(rows, ELEMENTS), profile, block=block).orderBy("doc_id", "pos").collect()
    return [(r.cls, r.title_id, r.section_id, r.text_id, r.table_id, r.figure_id) for r in out]


def test_ace(spark):
    rows = document("ace", [
        ("//Document/P", "before"), ("//Document/Title/Sub[2]", "The title"), ("//Document/H1", " Objective "), ("//Document/H1[2]", "Scope"),
        ("//Document/P[2]", "Insulin and T2DM\xa0"), ("//Document/P[3]", ""), ("//Document/Table", None, ["t"]), ("//Document/Table/TR", None),
        ("//Document/Figure[1]", None, ["f"]), ("//Document/Figure[1]/P", "in"), ("//Document/H1[9]/Figure", "x"), ("//Document/H2/H10", "also"),
        ("//Document/P[4]", "References"), ("//Document/H1[3]", "References "), ("//Document/P[5]", "gone"), ("//Document/Table[2]", None, ["t"]),
    ])
    assert summary(spark, rows) == [
        ("TEXT", 0, 0, 1, 0, 0), ("TITLE", 1, 0, 1, 0, 0), ("TEXT", 1, 0, 2, 0, 0), ("HEADER", 1, 1, 2, 0, 0), ("KEEP", 1, 2, 2, 0, 0), ("TEXT", 1, 2, 3, 0, 0),
        ("TABLE", 1, 2, 3, 1, 0), (None, 1, 2, 3, 1, 0), ("FIGURE", 1, 2, 3, 1, 1), ("TEXT", 1, 2, 4, 1, 1), ("TEXT", 1, 2, 5, 1, 1), ("HEADER", 1, 3, 5, 1, 1), ("TEXT", 1, 3, 6, 1, 1),
    ]


def test_acg(spark):
    rows = document("acg", [("//Document/Figure", "Title"), ("//Document/H1", "A"), ("//Document/H1[2]", "www.ace-hta.gov.sg"), ("//Document/Figure", None, ["f"]), ("//Document/H1[3]", "References")])
    assert [r[0] for r in summary(spark, rows)] == ["TITLE", "HEADER", "TEXT", "FIGURE"]


def test_healtiersg_titles_are_also_classified(spark):
    rows = document("healtiersg", [
        ("//Document/Title", "T"), ("//Document/H1", "a <b>"), ("//Document/P", "(<>)c"), ("//Document/P", " (<>)c"), ("//Document/P", "Background "),
        ("//Document/P", "Recent key changes:"), ("//Document/Title/H1", "(<>)References"), ("//Document/Title", "gone"),
    ])
    assert [r[:3] for r in summary(spark, rows)] == [("TEXT", 1, 0), ("HEADER", 1, 1), ("HEADER", 1, 2), ("TEXT", 1, 2), ("HEADER", 1, 3), ("KEEP", 1, 4), ("STOP", 2, 4)]


def test_numbering(spark):
    rows = document("numbering", [
        ("//Document/P[2]", "Title"), ("//Document/H1", "1 Intro"), ("//Document/H1[8]", "2 no"), ("//Document/P", "1.2 yes"), ("//Document/Span/P", "1.2 no"),
        ("//Document/H2", "٣ digits"), ("//Document/P", "FOREWORD"), ("//Document/P", " References"), ("//Document/P", "gone"),
    ])
    assert [r[0] for r in summary(spark, rows)] == ["TITLE", "HEADER", "TEXT", "HEADER", "TEXT", "HEADER", "KEEP"]


def test_unknown_and_null_profiles_are_generic_and_empty_tables_stay_empty(spark):
    rows = document(None, [("//Document/Title", "T"), ("//Document/H3", "A"), ("//Document/H3", "References")]) + document("x", [("//Document/H3", "A")], "e")
    assert [r[0] for r in summary(spark, rows)] == ["TITLE", "HEADER", "HEADER"]
    assert summary(spark, []) == []


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_counts_do_not_depend_on_blocks(spark, block):
    rng = random.Random(4)
    rows = [r for d in range(3) for r in document("ace", [(rng.choice(["//Document/H1", "//Document/P", "//Document/Table"]), rng.choice(["a", "b", None])) for _ in range(40)], f"d{d}")]
    assert summary(spark, rows, block=block) == summary(spark, rows)


def fold(texts):
    out = ""
    for t in texts:
        out = out + "\n\n" + t if out else t
    return out




def test_joined_text_is_that_of_a_loop(spark):
    rng = random.Random(2)
    lists = [[rng.choice(["", "a", "b\n", " "]) for _ in range(rng.randint(0, 6))] for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in lists], "t array<string>").select("t", C.joined_text(F.col("t")).alias("j")).collect()
    assert all(r.j == fold(r.t) for r in rows)


def test_chunks_of_a_document(spark):
    rows = document("ace", [
        ("//Document/P", "dropped"), ("//Document/Title/Sub[2]", "First"), ("//Document/Title/Sub[2]", "Second"), ("//Document/H1", "A"), ("//Document/P[2]", ""), ("//Document/P[3]", "one ≥ 2"), ("//Document/P[4]", "two"),
        ("//Document/H1[2]", "B"), ("//Document/H1[3]", "C"), ("//Document/P[5]", "word " * 700), ("//Document/P", "Insulin and T2DM"), ("//Document/P", "x"), ("//Document/P", "y"),
    ])
    elements = spark.createDataFrame(rows, ELEMENTS)
    sets = chunk_documents(elements.drop("profile"), spark.createDataFrame([("d", " ACE ")], "doc_id string, profile string"), reuse=True)
    final = sorted((r.section_id, r.piece_no, r.section_name, r.text_chunk, r.pages, r.Title) for r in sets["final_chunks"].collect())
    assert final[0] == (1, 0, "A", "one more than or equals to 2\n\ntwo", [2, 3], "First") and final[1] == (2, 0, "B", "", [], "First")
    assert [len(f[3]) <= 3000 for f in final if f[0] == 3] == [True, True] and [tuple(r) for r in sets["exception_chunks"].collect()] == [("d", 4, "Insulin and T2DM", "xy")]
    assert sets["tables"].count() == 0 and sets["titles"].count() == 2
    assert chunk_new_documents(elements.drop("profile"), elements.select("doc_id"))["sections"].count() == 0


def test_latest_delivery(spark):
    rows = [("d", 1, "old", "2024-01-01"), ("d", 1, "new", "2024-01-02"), ("d", 2, None, None), ("d", 2, "x", "2024-01-01"), (None, 1, "n", "2024-01-01")]
    df = spark.createDataFrame(rows, "doc_id string, pos int, Text string, a string").withColumn("arrived_at", F.col("a").cast("timestamp")).drop("a")
    assert {(r.doc_id, r.pos, r.Text) for r in S.latest_delivery(df).collect()} == {("d", 1, "new"), ("d", 2, "x"), (None, 1, "n")}


def test_profiles_are_named_by_their_key():
    assert all(name == p.name for name, p in PROFILES.items())
