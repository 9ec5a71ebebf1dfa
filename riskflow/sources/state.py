"""Keyed state tables in key buckets: a batch rewrites the buckets that it touches, and no others.

A state table is partitioned by ``state_bucket`` (hash of the key); a second table holds one digest a
bucket. A batch reads the touched buckets only (partition pruning), writes their new content to a
staging table, then overwrites just these partitions. Two states are compared by their digests first, so
that equal buckets are neither read nor joined.

The staging table is the commit point: it is complete once its properties name the touched buckets.
``recover_state`` finishes the overwrite of a complete staging table and drops an incomplete one, and
every step below calls it first, so that a driver lost at any point leaves the old state or the new one
(readers should do so too). One writer per state table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from riskflow.operators.triage import apply_changes, snapshot_diff

BUCKET = "state_bucket"
_MODE = "spark.sql.sources.partitionOverwriteMode"
_PROPERTY = "riskflow."


def key_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of a key, 0 to ``buckets`` - 1 (a NULL key has one too)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """(state_bucket, n_rows, high, low, mixed): sums and an exclusive or over two 64-bit hashes of each
    row, which do not depend on the order of the rows. Equal buckets have equal digests; buckets that
    differ have equal ones with a probability of about 2^-128."""
    plain = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        nested = isinstance(f.dataType, ArrayType | MapType | StructType)
        plain.append(F.to_json(F.struct(f.name)) if nested else F.col(f.name))
    # NULLs leave a hash as it is: whether each value is NULL is hashed beside the values.
    known = [c.isNull() for c in plain]
    rows = df.select(
        key_bucket(keys, buckets).alias(BUCKET), F.xxhash64(F.lit(1), *plain, *known).alias("a"), F.xxhash64(F.lit(2), *known, *plain).alias("b")
    )
    return rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.shiftright("a", 32)).alias("high"),
        F.sum(F.col("a").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.bit_xor("b").alias("mixed"),
    )


def changed_buckets(old: DataFrame, new: DataFrame) -> list[int]:
    """Buckets whose digests differ, or that only one side has: at most the number of buckets."""
    figures = [c for c in old.columns if c != BUCKET]
    o = old.select(BUCKET, F.struct(*figures).alias("o"))
    n = new.select(BUCKET, F.struct(*figures).alias("n"))
    return sorted(r[0] for r in o.join(n, BUCKET, "full_outer").filter(~F.col("o").eqNullSafe(F.col("n"))).select(BUCKET).collect())


def diff_by_bucket(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = 256) -> DataFrame:
    """``triage.snapshot_diff`` of two snapshots, joining rows of the buckets whose digests differ only."""
    some = changed_buckets(bucket_digests(old, keys, buckets), bucket_digests(new, keys, buckets))
    held = key_bucket(keys, buckets).isin(some)
    return snapshot_diff(old.filter(held), new.filter(held), keys)


def _digest_table(name: str) -> str:
    return f"{name}__digests"


def _stage_table(name: str) -> str:
    return f"{name}__changed"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"][len(_PROPERTY):]: r["value"] for r in rows if r["key"].startswith(_PROPERTY)}


def _set(spark: SparkSession, name: str, **values) -> None:
    pairs = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _write(df: DataFrame, name: str, root: str | None) -> None:
    w = df.write.mode("overwrite").format("parquet").partitionBy(BUCKET)
    if root:
        w = w.option("path", os.path.join(root, name.replace(".", "/")))
    # A first write and a staging table replace all of their own partitions.
    _with_mode(df.sparkSession, "static", lambda: w.saveAsTable(name))


def _with_mode(spark: SparkSession, mode: str, action: Callable[[], None]) -> None:
    before = spark.conf.get(_MODE, "static")
    spark.conf.set(_MODE, mode)
    try:
        action()
    finally:
        spark.conf.set(_MODE, before)


def _in_buckets(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One task and one file a bucket, unless AQE splits a bucket that is far larger than the others."""
    return df.withColumn(BUCKET, key_bucket(keys, buckets)).hint("rebalance", BUCKET)


def is_bucketed(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and "buckets" in _properties(spark, name)


def create_state(spark: SparkSession, df: DataFrame, name: str, keys: list[str], buckets: int = 256, root: str | None = None) -> None:
    """Write ``df`` as the state table ``name``, with its digests. ``root``: a folder that all nodes share
    (default: the warehouse). Choose ``buckets`` so that one fits a task; a batch with more random keys
    than buckets touches them all."""
    _write(_in_buckets(df, keys, buckets), name, root)
    _write(bucket_digests(spark.table(name).drop(BUCKET), keys, buckets), _digest_table(name), root)
    _set(spark, name, keys=",".join(keys), buckets=buckets, root=root or "")


def read_buckets(spark: SparkSession, name: str, some: list[int] | None = None) -> DataFrame:
    """The state's rows, or those of ``some`` buckets (only their files are read)."""
    recover_state(spark, name)
    rows = spark.table(name)
    return (rows if some is None else rows.filter(F.col(BUCKET).isin(some))).drop(BUCKET)


def recover_state(spark: SparkSession, name: str) -> None:
    """Finish or drop an interrupted batch."""
    stage = _stage_table(name)
    if not spark.catalog.tableExists(stage):
        return
    found = _properties(spark, stage)
    if "touched" in found:
        _overwrite(spark, name, stage, found)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")


def _overwrite(spark: SparkSession, name: str, stage: str, found: dict[str, str]) -> None:
    """Put the staged buckets in place; repeating it gives the same state."""
    about = _properties(spark, name)
    keys, buckets = about["keys"].split(","), int(about["buckets"])
    staged = spark.table(stage)
    digests = bucket_digests(staged.drop(BUCKET), keys, buckets)
    for target, rows in ((name, staged), (_digest_table(name), digests)):
        cols = spark.table(target).columns
        _with_mode(spark, "dynamic", lambda: rows.select(*cols).write.mode("overwrite").insertInto(target))
    left = {r[0] for r in staged.select(BUCKET).distinct().collect()}
    for b in sorted({int(x) for x in found["touched"].split(",") if x} - left):
        # A dynamic overwrite leaves a bucket that lost all of its rows as it was.
        held = [t for t in (name, _digest_table(name)) if spark.table(t).filter(F.col(BUCKET) == b).limit(1).count()]
        for target in held:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({BUCKET} = {b})")
            _forget_files(spark, target, b)
    if "batch" in found:
        _set(spark, name, batch=found["batch"])


def _forget_files(spark: SparkSession, name: str, bucket: int) -> None:
    """Files of a dropped partition (a table outside the warehouse keeps them)."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    if place is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{place['data_type']}/{BUCKET}={bucket}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(name)


def change_state(
    spark: SparkSession,
    name: str,
    changes: DataFrame,
    step: Callable[[DataFrame, DataFrame], DataFrame],
    batch_id: int | None = None,
) -> list[int]:
    """Replace the buckets that hold a key of ``changes`` by ``step(rows of these buckets, changes)``;
    returns them. ``step`` may add, change and remove rows of the keys in ``changes``, as
    ``triage.upsert_triage`` and ``apply_reviews`` do. A ``batch_id`` that is not above the last one's
    changes nothing (a replayed micro-batch)."""
    recover_state(spark, name)
    about = _properties(spark, name)
    if batch_id is not None and batch_id <= int(about.get("batch", -1)):
        return []
    keys, buckets = about["keys"].split(","), int(about["buckets"])
    touched = sorted(r[0] for r in changes.select(key_bucket(keys, buckets)).distinct().collect())
    if touched:
        old = spark.table(name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        stage = _stage_table(name)
        _write(_in_buckets(step(old, changes).select(*old.columns), keys, buckets), stage, about.get("root") or None)
        _set(spark, stage, touched=",".join(map(str, touched)), **({} if batch_id is None else {"batch": batch_id}))
        recover_state(spark, name)
    elif batch_id is not None:
        _set(spark, name, batch=batch_id)
    return touched


def sync_state(spark: SparkSession, source: str, target: str) -> list[int]:
    """Bring the state ``target`` to ``source``'s rows; returns the buckets that differed. Digests (a row a
    bucket) are compared first; the rows of differing buckets alone are read, joined and rewritten."""
    recover_state(spark, source)
    recover_state(spark, target)
    here, there = _properties(spark, source), _properties(spark, target)
    if (here["keys"], here["buckets"]) != (there["keys"], there["buckets"]):
        raise ValueError(f"{source} and {target} have other keys or numbers of buckets")
    keys = here["keys"].split(",")
    some = changed_buckets(spark.table(_digest_table(target)), spark.table(_digest_table(source)))
    if some:
        feed = snapshot_diff(read_buckets(spark, target, some), read_buckets(spark, source, some), keys)
        change_state(spark, target, feed, lambda rows, changes: apply_changes(rows, changes, keys))
    return some
