"""Queries that go through the sinks and come back through the sources, and the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.operators import sections as S
from docprep.session import shared_path, table, tune
from docprep.sources import files, sheets, sinks
from docprep.sources.elements import read_elements, write_elements


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_delivery(table(tune(spark), sf_dir, "elements"))


def elements_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements written as a JSON file for each document, and read again."""
    folder = shared_path(spark, "json")
    write_elements(_elements(spark, sf_dir), folder)
    return read_elements(spark, folder, "*.txt").select("doc_id", "pos", "Path", "Text", "Page", "ObjectID", F.array_join("filePaths", "|").alias("files"))


def folders_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders of the documents written."""
    folder = shared_path(spark, "json")
    write_elements(_elements(spark, sf_dir).where("pos < 3"), folder)
    return files.list_folders(spark, folder).where("folder like 'doc_id=%'").select(F.regexp_replace("folder", "^doc_id=", "").alias("doc_id"))


def datasets_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks written into buckets of documents, and read again with each one's bucket."""
    chunks = table(tune(spark), sf_dir, "chunks_data").select("doc_id", "chunk_no", "section_name", "text_chunk")
    where = sinks.write_datasets({"chunks": chunks}, shared_path(spark, "sets"))
    back = spark.read.parquet(where["chunks"])
    return back.select("doc_id", "chunk_no", "section_name", "text_chunk", (F.col("bucket") == sinks.bucket_of(F.col("doc_id"))).alias("in_its_bucket"))


def csv_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question-answer rows as CSV and back; CSV doesn't tell null from ''."""
    folder = shared_path(spark, "csv")
    sinks.write_csv(table(tune(spark), sf_dir, "qa_rows").select("qa_id", "question", "answer", "contexts"), folder)
    back = sinks.read_csv(spark, folder, "qa_id bigint, question string, answer string, contexts string")
    return back.select("qa_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("question", "answer", "contexts")))


def sheets_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook of section names for each document, written as a file, found by its prefix and read again."""
    chunks = table(tune(spark), sf_dir, "chunks_data").where("doc_id is not null").select("doc_id", "chunk_no", "section_name", F.size("text_id").alias("texts")).distinct()
    books = sheets.workbooks(chunks, "doc_id", ["chunk_no", "section_name"], ["chunk_no", "section_name", "texts"])
    folder = shared_path(spark, "sheets")
    named = books.select(F.concat(F.lit("Sections_"), "doc_id", F.lit(".xlsx")).alias("name"), "content")
    sinks.write_files(named, folder).count()
    rows = sheets.read_sheets(spark, folder, prefix="Sections_")
    cells = F.col("cells")
    return rows.select(F.regexp_extract("name", "^Sections_(.*)[.]xlsx$", 1).alias("doc_id"), "row_no", cells["chunk_no"].cast("int").alias("chunk_no"), cells["section_name"].alias("section_name"), cells["texts"].cast("int").alias("texts"))


def files_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each guideline, listed again: the newest of a prefix in its folder, and one looked up by name."""
    names = table(tune(spark), sf_dir, "guidelines").select(F.concat("doc_id", F.lit(".txt")).alias("name"), F.encode("Title", "utf-8").alias("content"))
    folder = shared_path(spark, "files")
    written = sinks.write_files(names, folder).count()
    listed = files.list_files(spark, folder, "*.txt")
    first = names.agg(F.min("name")).first()[0]
    found = files.find_file(listed, first).select("name", F.lit("found").alias("how"), F.lit(written).cast("bigint").alias("of"))
    latest = files.latest_file(listed, "cpg-").select(F.lit("any").alias("name"), F.lit("latest").alias("how"), F.lit(written).cast("bigint").alias("of"))
    return listed.select("name", F.lit("listed").alias("how"), F.col("size").alias("of")).unionByName(found).unionByName(latest)


def files_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the guidelines' files after those of one profile were deleted."""
    names = table(tune(spark), sf_dir, "guidelines").select(F.concat(F.lower(F.trim("profile")), F.lit("_"), "doc_id").alias("name"), F.encode("doc_id", "utf-8").alias("content"))
    folder = shared_path(spark, "files")
    sinks.write_files(names, folder).count()
    sinks.delete_files(files.list_files(spark, folder).where(files.named(F.col("name"), "ace_"))).count()
    return files.list_files(spark, folder).select("name")


def vocabulary_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of titles, written one a line and read as a vocabulary."""
    folder = shared_path(spark, "words")
    table(tune(spark), sf_dir, "guidelines").select(F.explode(F.split("Title", " ")).alias("word")).write.text(folder)
    return files.read_vocabulary(spark, folder)


QUERIES = {q.__name__: q for q in (elements_read_back, folders_listed, datasets_read_back, csv_read_back, sheets_read_back, files_found, files_deleted, vocabulary_read)}

_LATEST = "(SELECT * FROM elements QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY arrived_at DESC) = 1)"
ORACLE = {
    "elements_read_back": f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS pos, Path, Text, Page, ObjectID, array_to_string(filePaths, '|') AS files FROM {_LATEST}""",
    "folders_listed": "SELECT DISTINCT doc_id FROM elements WHERE pos < 3",
    "datasets_read_back": "SELECT doc_id, chunk_no, section_name, text_chunk, true AS in_its_bucket FROM chunks_data",
    "csv_read_back": "SELECT qa_id, coalesce(question, '') AS question, coalesce(answer, '') AS answer, coalesce(contexts, '') AS contexts FROM qa_rows",
    "sheets_read_back": """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no, section_name NULLS LAST) AS INTEGER) AS row_no, chunk_no, nullif(section_name, '') AS section_name, texts
FROM (SELECT DISTINCT doc_id, chunk_no, section_name, CAST(len(text_id) AS INTEGER) AS texts FROM chunks_data WHERE doc_id IS NOT NULL)""",
    "files_found": """SELECT doc_id || '.txt' AS name, 'listed' AS how, coalesce(octet_length(encode(Title)), 0)::BIGINT AS of FROM guidelines
UNION ALL SELECT min(doc_id) || '.txt', 'found', count(*) FROM guidelines UNION ALL SELECT 'any', 'latest', count(*) FROM guidelines""",
    "files_deleted": "SELECT lower(trim(profile)) || '_' || doc_id AS name FROM guidelines WHERE profile IS NOT NULL AND lower(trim(profile)) <> 'ace'",
    "vocabulary_read": "SELECT DISTINCT lower(trim(w)) AS word FROM (SELECT unnest(string_split(Title, ' ')) AS w FROM guidelines) WHERE trim(w) <> ''",
}
