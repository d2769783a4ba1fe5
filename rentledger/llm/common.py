"""What the operators share: the folder for intermediate tables and files, and access to files from tasks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-work-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


class Scratch:
    """Intermediate tables of one operator run below the shared folder.

    Tables are Parquet files written by committed Spark jobs, so a lost executor costs a task, not a lineage.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a frame that reads the files."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path(name))
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a name for each row that holds in every pass over it, and the name of that column.

    How files are packed into partitions, and with it a number taken from a scan, changes with the executors that are there. Rows of Parquet files are
    named by their file and their place in it, 24 bytes. Other frames are written once with numbers beside the rows.
    """
    column, taken = "_row_no", {c.lower() for c in docs.columns}
    while column in taken:
        column += "_"
    try:
        place = docs.metadataColumn("_metadata")
        file = F.unhex(F.md5(place["file_path"].cast("binary")))
        return docs.withColumn(column, F.concat(file, F.unhex(F.lpad(F.hex(place["row_index"]), 16, "0")))), column
    except AnalysisException:
        return scratch.save(docs.withColumn(column, F.monotonically_increasing_id()), "numbered"), column


def row_number(column: str | None):
    """The name of the row, or a number that holds for a single pass over the rows."""
    return (F.col(column) if column else F.monotonically_increasing_id()).alias("row_no")


def type_of(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def open_folder(uri: str):
    """``(filesystem, path)`` of a folder or file for use inside a task; any scheme that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
