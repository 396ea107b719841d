import json

import pytest
from pyspark.sql import functions as F

from docprep.sources import elements as E
from docprep.sources import files, sheets, sinks
from docprep.streaming import incremental as I

DOC = {"elements": [{"Path": "//Document/H1", "Text": "A", "Page": 0, "ObjectID": 1}, {"Path": "//Document/P", "Text": "", "Page": 0, "ObjectID": 2}, {"Path": "//Document/Table", "Page": 1, "ObjectID": 3, "filePaths": ["t.xlsx"], "Bounds": [1]}]}


@pytest.fixture
def folder(tmp_path):
    for name in ("doc one", "two"):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "structuredData.json").write_text(json.dumps(DOC, indent=1))
    (tmp_path / "in" / "two" / "figure.png").write_bytes(b"x")
    (tmp_path / "in" / "bad").mkdir()
    (tmp_path / "in" / "bad" / "structuredData.json").write_text("{broken")
    return tmp_path


def test_elements_round_trip(spark, folder):
    read = E.read_elements(spark, str(folder / "in"))
    rows = sorted((r.doc_id, r.pos, r.Text, r.ObjectID, r.filePaths) for r in read.collect())
    assert rows == [(d, i, t, o, f) for d in ("doc one", "two") for i, (t, o, f) in enumerate([("A", 1, None), ("", 2, None), (None, 3, ["t.xlsx"])])]
    one = json.loads(E.element_json(read.where("doc_id = 'two'")).first().value)
    assert one == {"elements": [{k: v for k, v in e.items() if k != "Bounds"} for e in DOC["elements"]]}
    E.write_elements(read, str(folder / "out"))
    again = E.read_elements(spark, str(folder / "out"), "*.txt")
    assert again.count() == 6


def test_listings(spark, folder):
    found = files.list_files(spark, str(folder / "in"))
    assert {(r.folder, r["name"]) for r in found.collect()} == {("doc one", "structuredData.json"), ("two", "structuredData.json"), ("two", "figure.png"), ("bad", "structuredData.json")}
    assert files.list_files(spark, str(folder / "in"), files.IMAGES, content=True).first().content == b"x"
    assert files.list_folders(spark, str(folder / "in")).count() == 3
    assert files.find_file(found, "structuredData.json", "two").count() == 1 and files.find_file(found, "none").count() == 0
    assert files.latest_file(found, "structured").count() == 3
    assert {r.folder for r in files.unprocessed(found, spark.createDataFrame([("two",)], "folder string"), "folder").collect()} == {"doc one", "bad"}


def test_sheets(spark, tmp_path):
    rows = [["x", None, "a & <b>"], [" y ", "1", "long" * 10_000], [None, None, None], [[1, 2], 3, ""]]
    data = sheets.workbook(["A", "B", "C"], rows)
    assert sheets.sheet_rows(data) == [["A", "B", "C"], ["x", None, "a & <b>"], [" y ", "1", "long" * 10_000], [], ["[1, 2]", "3", None]]
    (tmp_path / "file1.xlsx").write_bytes(data)
    (tmp_path / "file2.xlsx").write_bytes(b"broken")
    (tmp_path / "other.xlsx").write_bytes(data)
    got = sheets.read_sheets(spark, str(tmp_path), prefix="file").orderBy("row_no").collect()
    assert [r.row_no for r in got] == [1, 2, 3, 4] and got[0].cells == {"A": "x", "B": None, "C": "a & <b>"}
    for bad in (b"", b"PK"):
        with pytest.raises(ValueError):
            sheets.sheet_rows(bad)
    with pytest.raises(ValueError):
        sheets.sheet_rows(data, "no such sheet")
    df = spark.createDataFrame([("d", 2, "b", None), ("d", 1, "a", [1]), ("e", 1, "c", [])], "doc_id string, n int, t string, p array<int>")
    books = {r.doc_id: sheets.sheet_rows(bytes(r.content)) for r in sheets.workbooks(df, "doc_id", ["n"], ["t", "p"]).collect()}
    assert books["d"] == [["t", "p"], ["a", "[1]"], ["b"]] and books["e"][1][0] == "c"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", 'a "q",\nline', [1, 2]), ("e", None, None)], "doc_id string, t string, p array<int>")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = {r.doc_id: (r.t, r.p) for r in sinks.read_csv(spark, str(tmp_path / "csv")).collect()}
    assert back["d"] == ('a "q",\nline', "[1,2]")
    where = sinks.write_datasets({"x": df}, str(tmp_path / "sets"))
    assert spark.read.parquet(where["x"]).where("doc_id = 'd'").count() == 1


def test_stream_chunks_each_document_once(spark, folder):
    (folder / "in" / "bad" / "structuredData.json").unlink()
    out, check = str(folder / "chunks"), str(folder / "check")

    def run():
        I.chunk_stream(I.element_stream(spark, str(folder / "in")), out, check).awaitTermination()
        return sum(spark.read.parquet(str(p)).count() for p in (folder / "chunks").glob("*/sections") if list(p.rglob("*.parquet")))

    assert run() == 2 and run() == 2
    (folder / "in" / "three").mkdir()
    (folder / "in" / "three" / "structuredData.json").write_text(json.dumps(DOC))
    assert run() == 3


def test_watermarked_streams(spark, folder):
    (folder / "in" / "bad" / "structuredData.json").unlink()
    stream = I.element_stream(spark, str(folder / "in"))
    for name, df, mode in (("once", I.deduplicated(stream), "append"), ("arrived", I.arrivals(stream), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(folder / name)).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 6 and tuple(spark.table("arrived").agg(F.sum("n_elements"), F.sum("n_documents")).first()) == (6, 2)


def test_arrivals_count_documents_exactly(spark):
    rows = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("doc_id"), F.lit("2024-05-01 10:00:00").cast("timestamp").alias("arrived_at"))
    exact, before = I.arrivals(rows).first(), rows.agg(F.approx_count_distinct("doc_id")).first()[0]
    assert (exact.n_elements, exact.n_documents) == (10_000, 5000) and before != 5000


def test_buckets_hold_a_hot_document_in_parts(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 50)).alias("doc_id"), "id").unionByName(spark.createDataFrame([(None, 1)], "doc_id string, id bigint"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    try:
        where = sinks.write_datasets({"x": df}, str(tmp_path / "sets"), buckets=4)["x"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(where)
    assert sorted(map(repr, back.select("doc_id", "id").collect())) == sorted(map(repr, df.collect()))
    assert back.where(F.col("bucket") != sinks.bucket_of(F.col("doc_id"), 4)).count() == 0 and back.select("bucket").distinct().count() == 4
    assert len({r.f for r in back.where("doc_id = 'hot'").select(F.input_file_name().alias("f")).distinct().collect()}) > 1
    assert sinks.write_datasets({"y": df.limit(0)}, str(tmp_path / "sets"))


def test_files_are_written_whole(spark, tmp_path):
    df = spark.createDataFrame([("a.txt", b"one"), ("b.txt", None), (None, b"x"), ("a.txt", b"one")], "name string, content binary")
    assert sorted((r["name"], r.size) for r in sinks.write_files(df, str(tmp_path / "f")).collect()) == [("a.txt", 3), ("a.txt", 3), ("b.txt", 0)]
    assert {p.name: p.read_bytes() for p in (tmp_path / "f").iterdir()} == {"a.txt": b"one", "b.txt": b""}
    gone = spark.createDataFrame([(str(tmp_path / "f" / n),) for n in ("a.txt", "a.txt", "c.txt")] + [(None,)], "path string")
    assert sorted(r.deleted for r in sinks.delete_files(gone).collect()) == [False, True]
    assert [p.name for p in (tmp_path / "f").iterdir()] == ["b.txt"]


def test_elements_are_written_line_by_line(spark, tmp_path):
    rows = [("d", 5, "p", "b", 1, 2, None), ("d", 1, "p", 'a "q"\n', 0, 1, ["f"]), ("e", 0, None, None, None, None, None), (None, 1, "p", "x", 0, 1, None)]
    df = spark.createDataFrame(rows, "doc_id string, pos int, Path string, Text string, Page int, ObjectID bigint, filePaths array<string>")
    E.write_elements(df, str(tmp_path / "out"))
    found = {p.parent.name: json.loads(p.read_text()) for p in (tmp_path / "out").rglob("*.txt")}
    assert found == {"doc_id=d": {"elements": [{"Path": "p", "Text": 'a "q"\n', "Page": 0, "ObjectID": 1, "filePaths": ["f"]}, {"Path": "p", "Text": "b", "Page": 1, "ObjectID": 2}]}, "doc_id=e": {"elements": [{}]}}
    assert {(r.doc_id, r.pos) for r in E.read_elements(spark, str(tmp_path / "out"), "*.txt").collect()} == {("d", 0), ("d", 1), ("e", 0)}


def test_vocabulary(spark, tmp_path):
    (tmp_path / "words.txt").write_text(" The\nthe\n\nNaïve\n")
    assert {r.word for r in files.read_vocabulary(spark, str(tmp_path / "words.txt")).collect()} == {"the", "naïve"}


def test_only_a_single_process_makes_its_own_folder():
    from types import SimpleNamespace

    from docprep.session import shared_dir

    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(ValueError):
            shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))
