"""Snapshots, intermediate stages and report files."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.money import decimal_amounts
from ..operators.projection import quoted
from ..session import shuffles_released
from .quoted import SPLIT_BYTES, read_quoted
from .versions import write_versioned


def snapshot(df: DataFrame, cols: list[str] | None = None, exact_money: bool = False) -> DataFrame:
    """Columns to stage (all without ``cols``). ``exact_money`` turns doubles into decimals."""
    kept = df if cols is None else df.select([quoted(c) for c in cols])
    return decimal_amounts(kept) if exact_money else kept


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table so that a rerun replaces it."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stage_root(spark: SparkSession) -> str | None:
    """Shared folder for intermediate data, as the cluster names it. A local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and re.match(r"local(\[|$)", spark.sparkContext.master):
        root = "file://" + tempfile.mkdtemp(prefix="stage-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_stage(spark: SparkSession, name: str) -> str:
    """New folder below ``spark.checkpoint.dir``, which must be set."""
    root = stage_root(spark)
    if root is None:
        raise ValueError("give a path or set spark.checkpoint.dir")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def write_step(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write intermediate data, compressed well, and drop the shuffle files it took."""
    with shuffles_released(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


def checkpoint_stage(df: DataFrame, path: str | None = None, name: str = "stage") -> DataFrame:
    """Write a step and read it back, so that later failures do not recompute it.

    Without ``path`` the step goes to a new folder below ``spark.checkpoint.dir``, which must be set then.
    """
    path = path or new_stage(df.sparkSession, name)
    write_step(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", order_by: list[str] | None = None, versioned: bool = False) -> None:
    """Write a report; ``order_by`` sorts it over all files. ``versioned`` keeps the old report until the new one is complete (``versions.py``)."""
    ordered = df.orderBy(*map(quoted, order_by)) if order_by else df
    if versioned:
        write_versioned(ordered, path)
    else:
        write_table(ordered, path, fmt=fmt)


CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "NULL"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report as CSV: header, quoted fields, doubled quotes, ``NULL`` for missing values."""
    df.write.mode(mode).options(**CSV_OPTIONS, quoteAll="true", emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read such a report, many tasks to a large file.

    Fields may have line breaks: record ends are found by counting quotes (``quoted.py``), in one pass right away. ``multiline=False``
    skips that pass and takes every line for a record.
    """
    if multiline:
        return read_quoted(spark, path, schema, {**CSV_OPTIONS, "emptyValue": ""}, split_bytes)
    return spark.read.schema(schema).options(**CSV_OPTIONS, emptyValue="").csv(path)
