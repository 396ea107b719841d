"""Where results go: partitioned Parquet for the data sets, CSV for people, nothing rewritten as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Folders that a data set is spread over by its documents, and the parts that each may be written in at once.
BUCKETS, PARTS = 64, 8


def bucket_of(document: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a document: filter by it, too, to read one document from one folder."""
    return F.pmod(F.xxhash64(document), F.lit(buckets)).cast("int")


def write_datasets(sets: dict[str, DataFrame], path: str, mode: str = "overwrite", buckets: int = BUCKETS, parts: int = PARTS) -> dict[str, str]:
    """Each named set as Parquet in a folder of its name, partitioned by `bucket`, a hash of doc_id.

    The number of folders doesn't grow with the documents. Rows are salted by their content, so that a document with a
    third of all rows is written by several tasks; within a file they are ordered by document.
    """
    out = {}
    for name, df in sets.items():
        out[name] = f"{path.rstrip('/')}/{name}"
        salted = df.withColumn("bucket", bucket_of(F.col("doc_id"), buckets)).withColumn("_part", F.pmod(F.xxhash64(F.to_json(F.struct(*df.columns))), F.lit(parts)))
        salted.repartition("bucket", "_part").sortWithinPartitions("bucket", "doc_id").drop("_part").write.mode(mode).partitionBy("bucket").parquet(out[name])
    return out


def write_files(files: DataFrame, path: str, name: str = "name", content: str = "content") -> DataFrame:
    """(name, size) of the files (name, content) written under the path by the workers that hold them; written when it is read.

    The path is a folder or URI that all workers reach. A file is complete or not there: it is moved to its place, and
    a task that runs again writes the same file again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            sizes = []
            for n, data in zip(*(c.to_pylist() for c in batch.columns)):
                draft = f"{root}/.{n}.{uuid.uuid4().hex}"
                with fs.open_output_stream(draft) as f:
                    f.write(data or b"")
                fs.move(draft, f"{root}/{n}")
                sizes.append(len(data or b""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["name", "size"])

    return files.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content")).where("name is not null").mapInArrow(run, "name string, size bigint")


def delete_files(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, deleted) of the files, deleted by workers when it is read; one that isn't there is no error, a null path is left out.

    Files are named by their whole path, so none of the same name elsewhere is touched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for at in batch.column(0).to_pylist():
                fs, where = pafs.FileSystem.from_uri(at) if "://" in at or at.startswith("file:") else (pafs.LocalFileSystem(), at)
                there = fs.get_file_info(where).is_file
                if there:
                    fs.delete_file(where)
                gone.append(there)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.bool_())], names=["path", "deleted"])

    return files.select(F.col(path).cast("string").alias("path")).where("path is not null").distinct().mapInArrow(run, "path string, deleted boolean")


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; quotes are doubled, line ends and outer blanks kept; arrays and structs as JSON."""
    flat = rows.select(*(F.to_json(c).alias(c) if rows.schema[c].dataType.typeName() in ("array", "struct", "map") else F.col(c) for c in rows.columns))
    flat.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)
