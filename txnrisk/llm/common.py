"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = 1000  # rows of an Arrow batch: whole documents are large, and a Python worker holds a batch several times over


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand documents to Python workers in batches of ``BATCH_ROWS`` (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``more`` columns) of the documents table; other columns are never read."""
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def encoded(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text without decoding it; a null text counts as empty."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def remainder(doc_id, parts: int):
    """CRC-32 of the ID's decimal text modulo ``parts``, which fixes the folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def row_key(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """``df`` with a hash of all its columns under ``name``: equal rows share it, a missing ID does not matter.

    A ``wide`` key has 128 bits, so that no two of even 10**12 different rows share one.
    """
    cells = [F.to_json(F.col(c)) if "map" in kind else F.col(c) for c, kind in df.dtypes]
    key = F.xxhash64(*cells)
    return df.withColumn(name, F.struct(key.alias("a"), F.xxhash64(F.lit(1), *cells).alias("b")) if wide else key)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
