"""Tables kept in versions: a run writes a folder of its own, then one small file is switched to it.

Spark's overwrite deletes the old table before it writes the new one, so a run that dies leaves neither. Here readers see the old
version until the new one is complete; a run that dies in between leaves an unused folder behind and nothing else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shuffles_released

POINTER = "_current"


class _Files:
    """The file system of a table's folder, through Hadoop, so that any scheme Spark knows will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> list[str]:
        if not self.fs.exists(self.path(name)):
            return []
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode().split()
        finally:
            stream.close()

    def replace(self, name: str, lines: list[str]) -> None:
        """Write a file beside and move it over the old one in one step."""
        made = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(made), True)
        stream.write(bytearray("\n".join(lines).encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(self.path(made), self.path(name), options)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def write_versioned(df: DataFrame, root: str, keep: int = 2, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the new version of the table below ``root`` and return its name.

    The ``keep`` latest versions stay, so that readers that began with an older one can end; older ones are removed.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with shuffles_released(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root.rstrip('/')}/{version}")
    switch(spark, root, version, keep)
    return version


def switch(spark: SparkSession, root: str, version: str, keep: int = 2) -> None:
    """Make a complete version the current one."""
    files = _Files(spark, root)
    history = [version, *(v for v in files.read(POINTER) if v != version)]
    files.replace(POINTER, history[:keep])
    for old in history[keep:]:
        files.delete(old)


def current_version(spark: SparkSession, root: str) -> str:
    found = _Files(spark, root).read(POINTER)
    if not found:
        raise FileNotFoundError(f"no complete version of a table below {root}")
    return found[0]


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The current version; rows that a later run writes don't change a frame that was read before."""
    return spark.read.parquet(f"{root.rstrip('/')}/{current_version(spark, root)}")


def drop_table(spark: SparkSession, root: str) -> None:
    """Remove a table with all its versions, for instance intermediate data that nothing reads any more."""
    _Files(spark, root).delete("")
