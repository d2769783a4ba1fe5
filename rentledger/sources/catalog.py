"""Read source systems and give their tables distinct names."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .schema import SHARED_TABLES, SYSTEM_PREFIX, SYSTEM_TABLES


def load_source(
    spark: SparkSession,
    source: str,
    tables: list[str] | None = None,
    options: dict[str, str] | None = None,
    table_options: dict[str, dict[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Lazy readers for the named tables of one source.

    ``source`` is a system name (orders, products, locations, users, payments) or any label when
    ``tables`` is given. ``options`` needs ``format`` (``parquet``, ``jdbc``, ...) and either ``path``,
    the folder of the tables, or the JDBC options. Partitioned JDBC reads take ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` per table through ``table_options``. A password
    that is not given is taken from ``<SOURCE>_DB_PASSWORD``.
    """
    opts = dict(options or {})
    fmt = opts.pop("format", "parquet")
    path = opts.pop("path", None)
    suffix = opts.pop("suffix", ".parquet" if fmt == "parquet" else "")
    secret = os.environ.get(f"{source.upper()}_DB_PASSWORD")
    if fmt == "jdbc" and "password" not in opts and secret:
        opts["password"] = secret
    out = {}
    for name in tables or SYSTEM_TABLES[source]:
        reader = spark.read.format(fmt).options(**opts).options(**(table_options or {}).get(name, {}))
        if fmt == "jdbc":
            out[name] = reader.option("dbtable", f'"{name}"').load()
        else:
            out[name] = reader.load(os.path.join(path, f"{name}{suffix}"))
    return out


def register(dfs: dict[str, DataFrame], domain: str) -> dict[str, DataFrame]:
    """Prefix the table names that other systems use as well (``OrderDynamicControls``, ...)."""
    prefix = SYSTEM_PREFIX.get(domain, "")
    return {f"{prefix}{n}" if n in SHARED_TABLES else n: df for n, df in dfs.items()}


def register_views(dfs: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in dfs.items():
        register_view(df, f"{prefix}{name}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for use in SQL; nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df


def id_table(spark: SparkSession, ids: list[int], name: str = "order_number") -> DataFrame:
    """One-column table of a list the caller holds."""
    return spark.createDataFrame([(i,) for i in ids], f"`{name}` bigint")
