"""Sinks: partitioned tables, text exports, JSON documents and alert lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.coerce import finite, iso_text
from txnrisk.sources.schema import to_feed_names


def with_month(df: DataFrame, ts: str = "txn_ts") -> DataFrame:
    return df.withColumn("txn_month", F.date_format(ts, "yyyy-MM"))


def write_by_month(df: DataFrame, path: str, ts: str = "txn_ts") -> None:
    """Parquet partitioned by month, sorted by time and then ID inside files.

    The rebalance hint lets Spark split a busy month over many tasks and merge quiet
    ones, with no extra pass over the source; partition pruning and per-file min/max
    stand in for a date index.
    """
    df = with_month(df, ts)
    (
        df.hint("rebalance", "txn_month")
        .sortWithinPartitions("txn_month", ts, *[c for c in ("txn_id",) if c in df.columns])
        .write.mode("overwrite").partitionBy("txn_month").parquet(path)
    )


def write_clean(df: DataFrame, path: str, check: bool = True) -> int:
    """Replace the clean table, read it back and compare count and key uniqueness.

    The expected count is a count of ``df`` itself; give a staged table where computing it twice is dear.  (A count taken
    along the write would see the rows of repeated tasks again.)
    """
    expected = df.count()
    write_by_month(df, path)
    stored = df.sparkSession.read.parquet(path)
    rows = stored.count()
    if rows != expected:
        raise RuntimeError("Stored row count does not match the cleaned data.")
    if check and stored.groupBy("txn_id").count().where("count > 1").limit(1).count():
        raise ValueError("Stored keys are not unique.")
    return rows


def write_text(df: DataFrame, path: str) -> None:
    """CSV with the feed's headers and ISO date text; rows of a file by time and then ID where those columns exist."""
    order = [c for c in ("txn_ts", "txn_id") if c in df.columns]
    df = df.sortWithinPartitions(*order) if order else df
    times = {c: iso_text(F.col(c)) for c, t in df.dtypes if t.startswith("timestamp")}
    to_feed_names(df.withColumns(times)).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_scored(scored: DataFrame, path: str, test_path: str | None = None) -> None:
    """The full scored table and, as a filter on the stored table, its test part."""
    write_by_month(scored, path)
    if test_path:
        stored = scored.sparkSession.read.parquet(path)
        write_by_month(stored.where(F.col("split") == "test").drop("txn_month"), test_path)


def _finite_only(df: DataFrame) -> DataFrame:
    """JSON has no NaN or infinity: such numbers become null."""
    return df.withColumns({c: finite(F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def write_alerts(alerts: DataFrame, path: str) -> None:
    """One JSON object per line, every field present."""
    _finite_only(alerts).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_document(df: DataFrame, path: str) -> None:
    """A small result (an audit, a metric record, a selection) as one JSON file."""
    _finite_only(df).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
