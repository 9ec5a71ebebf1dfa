"""Managed tables: namespaces, publish with a staged swap, append-or-create, views, previews.

Spark refuses to overwrite a table that the same plan reads, and the state operators read the
table they replace. ``publish`` therefore materialises the new state under a staging name (which
also cuts the lineage — executors lost later do not recompute the whole history) and swaps it in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskflow.constants import PREVIEW_ROWS

LAYERS = ("raw", "silver", "gold")


def create_namespaces(spark: SparkSession, layers=LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_empty(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> bool:
    """Create ``name`` with ``schema`` and no rows if it does not exist (never overwrites an
    existing table). Returns True when created."""
    recover(spark, name)
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.format(fmt).saveAsTable(name)
    return True


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def overwrite_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
) -> None:
    """Overwrite ``name`` (schema replaced). ``bucket_by=(n, cols)`` stores the table hashed by
    ``cols`` so later joins/aggregations on them read it without a shuffle."""
    w = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def append_or_create(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Append when the table exists, else create it (first write)."""
    df.write.mode("append").format(fmt).saveAsTable(name)


def publish(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    bucket_by: tuple[int, list[str]] | None = None,
) -> None:
    """Replace ``name`` with ``df`` even when ``df`` reads ``name``.

    The new state is written in full under a staging name first (a failure there leaves ``name``
    untouched). Then the old table is renamed to a backup, the staging table renamed in, and the
    backup dropped. If the driver dies between the two renames, ``name`` is missing and the backup
    holds the last state: ``read_state`` / ``recover`` put it back before the next step reads it,
    and ``publish`` refuses to run over an unrecovered backup. One writer per state table.
    """
    backup = _backup(name)
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(backup):
        raise RuntimeError(f"{name} is missing and {backup} holds its last state: call recover() first")
    stage = f"{name}__stage_{uuid.uuid4().hex[:8]}"
    overwrite_table(df, stage, fmt=fmt, bucket_by=bucket_by)
    spark.sql(f"DROP TABLE IF EXISTS {backup}")  # left over by a swap that completed its renames
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {backup}")


def _backup(name: str) -> str:
    return f"{name}__previous"


def recover(spark: SparkSession, name: str) -> bool:
    """Restore ``name`` from its backup after an interrupted swap. Returns True when restored."""
    backup = _backup(name)
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(backup):
        spark.sql(f"ALTER TABLE {backup} RENAME TO {name}")
        return True
    return False


def read_state(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """The current state table (recovered first if a swap was interrupted); an empty DataFrame of
    ``schema`` when the table does not exist yet."""
    recover(spark, name)
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if schema is None:
        raise ValueError(f"table {name} does not exist")
    return spark.createDataFrame([], schema)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: list | None = None) -> DataFrame:
    """First ``n`` rows (a sampling operator: the limit is the feature). With ``order_by`` the
    rows are deterministic (planned as a top-k: each task keeps its best ``n``)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
