"""Session helpers shared by the operators: where lineage is cut and how big Arrow batches are."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Functions of this package travel to the executors by value, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

#: Rows in one Arrow batch handed to a Python worker; texts can be long, so it stays well below Spark's 10,000.
ARROW_ROWS = 2000
_DEFAULT_ARROW_ROWS = "10000"


def tune(spark: SparkSession) -> SparkSession:
    """Lower the Arrow batch size unless the session has set one, so that a batch of long texts fits a small worker."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == _DEFAULT_ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and a single process runs everything (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="docprep-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def never_sent(df: DataFrame) -> DataFrame:
    """For a side of a join whose rows hold arrays or long texts: Spark counts these as a few bytes, so it would send them to every task unchecked."""
    return df.hint("merge")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table written by an operator."""
    return f"{shared_dir(spark).rstrip('/')}/docprep-{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
