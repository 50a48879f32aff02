"""Category numbers from a distributed dictionary, for columns with more values than a driver should list."""

from __future__ import annotations

import json

from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.operators import kernels as K
from txnrisk.session import stage

LITERAL_LABELS = 10_000   # values that a pipeline stage may hold as a list
ROWS_PER_RANGE = 1_000_000


def many_valued(df: DataFrame, cols: list[str], limit: int | None = None) -> list[str]:
    """The columns with more than ``limit`` distinct values (counted up to there only)."""
    limit = LITERAL_LABELS if limit is None else limit
    return [c for c in cols if df.where(F.col(c).isNotNull()).select(c).distinct().limit(limit + 1).count() > limit]


def numbered_values(df: DataFrame, cols: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(column, value, idx): the distinct non-null values of every column, numbered from 0 in their order.

    Values are cut into ranges, a small table of range counts gives every range its first number, and
    values are numbered inside ranges: no task and no driver holds a column's values.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("p")).select("p.*")
    distinct = stage(pairs.where("value is not null").distinct(), "categories")
    ranges = max(1, -(-distinct.count() // rows_per_range))
    # Stored with the range, because ranges come from a sample and must not change between two uses.
    ranged = stage(distinct.repartitionByRange(ranges, "column", "value").withColumn("_range", F.spark_partition_id()), "category-ranges")
    before = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("column", "_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("column", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("column", "_range").orderBy("value")
    return ranged.join(K.small(starts, ranges * len(cols)), ["column", "_range"]).select(
        "column", "value", (F.col("_start") + F.row_number().over(inside) - 1).alias("idx"))


class CategoryIndex(Transformer, MLReadable, MLWritable):
    """Adds the number of each category column; a value outside the dictionary, or none, gets the number of values.

    ``columns``: input column -> output column; ``sizes``: input column -> number of values; ``table``: (column, value, idx).
    """

    def __init__(self, columns: dict[str, str] | None = None, sizes: dict[str, int] | None = None, table: DataFrame | None = None):
        super().__init__()
        self.columns, self.sizes, self.table = columns or {}, sizes or {}, table

    @classmethod
    def fit(cls, df: DataFrame, columns: dict[str, str]) -> CategoryIndex:
        table = stage(numbered_values(df, list(columns)), "dictionary")
        found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a column
        return cls(columns, {c: found.get(c, 0) for c in columns}, table)

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, out in self.columns.items():
            values = self.table.where(F.col("column") == c).select(F.col("value").alias(c), F.col("idx").alias(out))
            df = K.lookup(df, values, c, [out], rows=self.sizes[c])
            df = df.withColumn(out, F.coalesce(F.col(out), F.lit(self.sizes[c])).cast("double"))
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: CategoryIndex):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802 (MLlib's name)
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"columns": self.instance.columns, "sizes": self.instance.sizes})
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class _Reader(MLReader):
    def load(self, path: str) -> CategoryIndex:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        metadata = json.loads(metadata) if isinstance(metadata, str) else metadata
        out = CategoryIndex(metadata["columns"], metadata["sizes"], spark.read.parquet(f"{path}/table"))
        out._resetUid(metadata["uid"])
        return out
