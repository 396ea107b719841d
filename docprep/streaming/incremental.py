"""Documents as they arrive: a stream over element files, chunked once each, whatever is restarted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docprep.plans.pipeline import chunk_documents
from docprep.sources.elements import ELEMENT
from docprep.sources.sinks import write_datasets


def element_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(doc_id, pos, ..., arrived_at) of element files in a folder for each document, as they appear."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True)
    files = lines.schema(f"elements array<{ELEMENT}>").json(path)
    folder = F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return files.select(folder.alias("doc_id"), F.col("_metadata.file_modification_time").alias("arrived_at"), F.posexplode("elements").alias("pos", "e")).select("doc_id", "pos", "e.*", "arrived_at")


def chunk_stream(stream: DataFrame, path: str, checkpoint: str, guidelines: DataFrame | None = None, once: bool = True) -> StreamingQuery:
    """Chunk each batch's documents and write the data sets; a batch run again overwrites its own folder.

    With once=True what is there is worked off and the query ends; else it goes on.
    """

    def run(batch: DataFrame, number: int) -> None:
        write_datasets(chunk_documents(batch, guidelines, reuse=True), f"{path.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def deduplicated(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """The stream without rows delivered again within the delay; the state for older ones is let go."""
    return stream.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["doc_id", "pos"])


def arrivals(stream: DataFrame, window: str = "1 day", delay: str = "30 days") -> DataFrame:
    """Elements and documents by day of arrival; late rows count until the delay is over.

    Documents are counted exactly: a row for each document's first arrival of a day is added to the elements' rows. The
    state has an entry for each document of a day, spread over all tasks, never a day's documents in one place.
    """
    seen = stream.withWatermark("arrived_at", delay).select("doc_id", F.window("arrived_at", window).alias("w"))
    first = seen.where("doc_id is not null").dropDuplicates(["doc_id", "w"])
    each = seen.select("w", F.lit(1).alias("e"), F.lit(0).alias("d")).unionByName(first.select("w", F.lit(0).alias("e"), F.lit(1).alias("d")))
    counted = each.groupBy("w").agg(F.sum("e").alias("n_elements"), F.sum("d").alias("n_documents"))
    return counted.select(F.col("w.start").alias("from"), "n_elements", "n_documents")
