"""Element files: JSON with a list of elements in reading order, read and written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENT = "struct<Path:string,Text:string,Page:int,ObjectID:bigint,filePaths:array<string>>"


def read_elements(spark: SparkSession, path: str, name: str = "*.json") -> DataFrame:
    """(doc_id, pos, Path, Text, Page, ObjectID, filePaths) of every file under the path, a folder for each document.

    doc_id is the name of the file's folder, without a leading doc_id= as write_elements makes. Only these fields are parsed; a file that isn't JSON has no rows.
    """
    files = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).schema(f"elements array<{ELEMENT}>").json(path)
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return files.select(F.regexp_replace(F.url_decode(folder), "^doc_id=", "").alias("doc_id"), F.posexplode("elements").alias("pos", "e")).select("doc_id", "pos", "e.*")


def element_json(elements: DataFrame) -> DataFrame:
    """(doc_id, value): each document's elements as one JSON value in order, without null fields; for documents that fit a task."""
    ordered = elements.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("Path", "Text", "Page", "ObjectID", "filePaths").alias("e")))).alias("r"))
    return ordered.select("doc_id", F.to_json(F.struct(F.col("r.e").alias("elements"))).alias("value"))


def element_lines(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, value): the lines of each document's JSON, one for each element; (doc_id, pos) must be unique, null keys are left out."""
    known = elements.where("doc_id is not null and pos is not null")
    ends = known.groupBy("doc_id").agg(F.min("pos").alias("_first"), F.max("pos").alias("_last"))
    json = F.to_json(F.struct("Path", "Text", "Page", "ObjectID", "filePaths"))
    start = F.when(F.col("pos") == F.col("_first"), F.lit('{"elements":[')).otherwise(F.lit(""))
    stop = F.when(F.col("pos") == F.col("_last"), F.lit("]}")).otherwise(F.lit(","))
    return known.join(ends, "doc_id").select("doc_id", "pos", F.concat(start, json, stop).alias("value"))


def write_elements(elements: DataFrame, path: str) -> None:
    """A folder doc_id=... for each document, with one file of JSON, a line for each element.

    A document's file is written in one go by one task, as a file must be, but line by line: no document is ever one value.
    """
    lines = element_lines(elements).repartition("doc_id").sortWithinPartitions("doc_id", "pos")
    lines.select("doc_id", "value").write.mode("overwrite").partitionBy("doc_id").text(path)
