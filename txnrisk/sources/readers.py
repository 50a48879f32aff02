"""Scans of feeds and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.session import stage
from txnrisk.sources import schema as S


def null_tokens(df: DataFrame) -> DataFrame:
    """Text cells that mean "no value" become null, as a delimited-file reader has them."""
    text = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(S.NULL_TOKENS), F.col(c)) for c in text})


MALFORMED = "_malformed"


def read_text_table(spark: SparkSession, path: str | list[str], malformed: str = "fail") -> DataFrame:
    """CSV as all-text columns under trimmed header names; no inference pass.

    The names come from one header line.  A schema binds by position, so Spark is told
    to check every file's own header against it: a file with another column order fails
    the read instead of swapping columns.  Give such files as separate entries of a list;
    entries are matched by name.

    A line with more or fewer fields than the header is malformed.  ``malformed="fail"`` ends the read at such a line,
    ``"keep"`` keeps it, its text in the column ``_malformed`` (null for good lines), to be counted or put aside.
    A line break inside quotes is not supported: it would keep Spark from splitting large files.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed must be 'fail' or 'keep'")
    if not isinstance(path, str):
        first, *rest = [read_text_table(spark, p, malformed) for p in path]
        for part in rest:
            first = first.unionByName(part)
        return first
    options = {"header": True, "quote": '"', "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    # Without column pruning the parser sees every field of a line, whatever a query selects.
    options |= {"enforceSchema": False, "columnPruning": False, "columnNameOfCorruptRecord": MALFORMED}
    options["mode"] = "FAILFAST" if malformed == "fail" else "PERMISSIVE"
    extra = [MALFORMED] if malformed == "keep" else []
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *extra]])
    df = spark.read.options(**options).schema(schema).csv(path)
    return null_tokens(df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in names], *extra))


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Training feed: exactly the contract's columns; a malformed line ends the read."""
    df = read_text_table(spark, path)
    S.check_feed_header(df.columns)
    return df.select(*S.FEED_COLUMNS)


def split_feed(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows of a feed, texts of its malformed lines), for runs that put such lines aside instead of failing.

    The parsed feed is staged once: Spark refuses queries that need only the malformed text of a raw file.
    """
    df = read_text_table(spark, path, malformed="keep")
    S.check_feed_header([c for c in df.columns if c != MALFORMED])
    parsed = stage(df, "feed")
    good = parsed.where(F.col(MALFORMED).isNull()).select(*S.FEED_COLUMNS)
    return good, parsed.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"))


def read_scoring_input(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scoring input under engine names: the seven inputs, extras passed through."""
    df = S.to_engine_names(read_text_table(spark, path))
    S.check_inputs(df.columns, S.SCORING_INPUTS)
    return df


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under ``path``, for the identity check of a fixed input."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def require_digest(spark: SparkSession, path: str, expected: str) -> None:
    found = [r["sha256"] for r in file_digests(spark, path).select("sha256").limit(2).collect()]
    if found != [expected]:
        raise ValueError("The input file is not the one expected: its SHA-256 differs.")


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def holds_csv(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a CSV file or a folder of such files, on whatever file system it lies."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return True
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.csv*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def read_scored(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Scored table from Parquet, or from CSV with the date parsed.  ``fmt`` (``csv``, ``parquet``): by default what lies there."""
    from txnrisk.functions.coerce import event_time

    if (fmt or ("csv" if holds_csv(spark, path) else "parquet")) == "csv":
        df = S.to_engine_names(read_text_table(spark, path))
        typed = {c: F.col(c).try_cast("double") for c in ("amount", "fraud_score", "anomaly_score") if c in df.columns}
        typed |= {c: F.col(c).try_cast("int") for c in ("label", "predicted_fraud", "anomaly_flag", "is_intl") if c in df.columns}
        return df.withColumns({**typed, "txn_ts": event_time(df, "txn_ts")})
    return spark.read.parquet(path)
