"""Session, table and Arrow helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import scratch_path, ship_package

# Arrow batches sent to Python workers hold at most this many bytes, so that a run of very long
# texts cannot fill a worker's memory (the row bound alone would allow 10,000 long texts at once).
ARROW_BATCH_BYTES = 4 << 20
#: A filter of keys has at most two to this power words of 64 bits; up to that it has a word for each WORD_KEYS keys.
FILTER_LOG2, WORD_KEYS = 17, 4


def prepare(spark: SparkSession) -> None:
    """Session settings the Python-side operators rely on: UTC, bounded Arrow batches, package shipped."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: cuts the lineage,
    and a lost executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    path = os.path.join(scratch_path(spark, "llm"), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns every text operator reads; a null text counts as the empty text."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    out = []
    for name in names:
        while name.lower() in {c.lower() for c in df.columns}:
            name += "_"
        out.append(name)
    return out


def _marks(h: Column) -> Column:
    """Four bits of a 64-bit word, picked by the upper half of a hash."""
    picked = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, n).bitwiseAND(F.lit(63)).cast("int")) for n in (40, 46, 52, 58)]
    return picked[0].bitwiseOR(picked[1]).bitwiseOR(picked[2]).bitwiseOR(picked[3])


def parted(rows: DataFrame, by: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash ``by`` may be in ``keys``, the others): what is joined with the keys of few rows need
    not shuffle all of them. ``keys`` has one column of hashes without nulls, ``by`` has none either.

    A Bloom filter, which is broadcast, parts them. Its size is bounded: the more keys there are beyond that, the
    more rows without a key are among the first; none with a key is among the others."""
    keys = stage(keys.toDF("h"), "keys")
    n = min(FILTER_LOG2, (keys.count() // WORD_KEYS).bit_length())
    slot, bits, hashed = fresh(rows, "__slot", "__bits", "__hash")
    spot = F.lit((1 << n) - 1).cast("long")
    words = keys.groupBy(F.col("h").bitwiseAND(spot).alias(slot)).agg(F.bit_or(_marks(F.col("h"))).alias(bits))
    words = F.broadcast(stage(words, "key-words"))
    at = rows.withColumn(hashed, by).join(words, F.col(hashed).bitwiseAND(spot) == F.col(slot), "left")
    marks = _marks(F.col(hashed))
    maybe = F.coalesce(F.col(bits).bitwiseAND(marks) == marks, F.lit(False))
    return at.filter(maybe).select(*rows.columns), at.filter(~maybe).select(*rows.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64 of n + 1, bytes uint8) of a string column, without a copy of the bytes."""
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose bytes stay under ``limit`` (a longer single row is a range of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in place on a uint64 array)."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [starts, starts + lens)."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
