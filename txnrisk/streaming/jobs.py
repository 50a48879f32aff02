"""File streams of transactions: scoring, alerts, replay safety, live trends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txnrisk.functions.coerce import finite, safe_ratio
from txnrisk.operators import scoring as S
from txnrisk.plans.batch import Artifacts, score_transactions


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int | None = 1) -> DataFrame:
    """Directory stream with an explicit schema (for CSV the files must share one layout)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path)


def with_watermark(stream: DataFrame, delay: str, ts: str = "txn_ts") -> DataFrame:
    """Watermarks need a zoned timestamp; sessions run in UTC, so the cast keeps the wall time."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def drop_replays(stream: DataFrame, delay: str, key: str = "txn_id", ts: str = "txn_ts") -> DataFrame:
    """Each transaction ID once; state is kept no longer than the watermark delay."""
    return with_watermark(stream, delay, ts).dropDuplicatesWithinWatermark([key])


def score_stream(stream: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Scores, flags and review status per row; rows that fail the input checks are left out.

    Use ``rejected`` on the same stream to keep those rows.
    """
    good, _ = S.quarantine(stream)
    return score_transactions(good, artifacts, strict=False)


def rejected(stream: DataFrame) -> DataFrame:
    return S.quarantine(stream)[1]


def write_scored_and_rejected(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True,
) -> StreamingQuery:
    """One stream, two sinks: rows that pass the input checks are scored, the others are kept with their reasons.

    Every micro-batch is read and checked once and written to ``scored/batch=n`` and ``rejected/batch=n``.  A replayed one
    overwrites both of its folders, so a row is in exactly one sink, once, whatever failed in between.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = S.validate(batch).persist()  # read by both sinks; lost blocks are computed again from the batch
        try:
            good = checked.where(F.size("reasons") == 0).drop("reasons")
            score(S.conform(good)).write.mode("overwrite").parquet(f"{path}/scored/batch={batch_id}")
            checked.where(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{path}/rejected/batch={batch_id}")
        finally:
            checked.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_alert_stream(scored: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Alert records of every flagged row as JSON lines, one folder per micro-batch.

    A replayed micro-batch overwrites its own folder, so retries never duplicate alerts.
    """
    records = S.alert_records(scored)
    records = records.withColumn("fraud_score", finite(F.col("fraud_score")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/batch={batch_id}")

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_table_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def live_trend(stream: DataFrame, window: str, delay: str, ts: str = "txn_ts") -> DataFrame:
    """Counts, positives and amount per tumbling window; a window is emitted once it is closed."""
    w = F.window(ts, window)
    per = with_watermark(stream, delay, ts).groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("label").alias("positives"), F.sum("amount").alias("amount")
    )
    return per.select(
        F.col("w.start").cast("timestamp_ntz").alias("period"), "transactions", "positives", "amount",
        (safe_ratio(F.col("positives"), F.col("transactions")) * 100).alias("rate_percent"),
    )
