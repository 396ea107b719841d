"""Listings of files and folders, and guarded reads; Hadoop file systems do the transport."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.functions.text import strip

IMAGES = "*.{png,jpg,jpeg,gif,bmp,tif,tiff}"


def list_files(spark: SparkSession, path: str, glob: str = "*", content: bool = False) -> DataFrame:
    """(path, folder, name, modified, size[, content]) of every file under the path that isn't empty; no page limit. The bytes are read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    parts = F.split("path", "/")
    columns = ["path", F.url_decode(F.element_at(parts, -2)).alias("folder"), F.url_decode(F.element_at(parts, -1)).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")]
    return files.select(*columns, *(["content"] if content else []))


def list_folders(spark: SparkSession, path: str) -> DataFrame:
    """(folder) that hold files, anywhere under the path."""
    return list_files(spark, path).select("folder").distinct()


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(word): the distinct words of text files with one a line, in lower case and without white space around; empty lines are none."""
    word = F.lower(strip(F.col("value")))
    return spark.read.text(path).select(word.alias("word")).where("word <> ''").distinct()


def find_file(files: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The file of that name, in that folder if one is given; of several the first by path, of none no row."""
    found = files.where(F.col("name") == name)
    return (found.where(F.col("folder") == folder) if folder is not None else found).orderBy("path").limit(1)


def named(name: Column, prefix: str) -> Column:
    return name.startswith(prefix)


def latest_file(files: DataFrame, prefix: str) -> DataFrame:
    """For each folder the file that begins with the prefix and was modified last; ties by name."""
    matching = files.where(named(F.col("name"), prefix))
    keep = [c for c in files.columns if c != "folder"]
    return matching.groupBy("folder").agg(F.max_by(F.struct(*keep), F.struct("modified", "name")).alias("f")).select("folder", "f.*")


def unprocessed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key isn't done yet."""
    return items.join(done.select(key).distinct(), key, "left_anti")
