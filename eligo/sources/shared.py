"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder that is set. Only a local session, whose executor is the
    driver itself, may go without one and then gets a temporary folder; a cluster without one is an error."""
    context = spark.sparkContext._jsc.sc()
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and context.getCheckpointDir().isDefined():
        at = context.getCheckpointDir().get()
    if not at:
        if not context.isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new path inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; its lineage ends there, so lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def file_system(uri: str):
    """(file system, path) of a shared folder's URI, for tasks that read or write files of their own there."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
