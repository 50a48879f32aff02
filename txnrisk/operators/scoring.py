"""Input checks, score columns, review status and alert records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import coerce as C
from txnrisk.sources import schema as S

# Fixed values of the alert record and the review texts.
ALERT_STATUS = "SIMULATED_ONLY"
ALERT_ACTION = "human_review_requested"
ALERT_MESSAGE = "Score exceeded the frozen validation threshold. This is not a confirmed fraud finding."
MODEL_REVIEW, ANOMALY_REVIEW, LOWER_SCORE = "Model review", "Anomaly review", "Lower score"


class InputError(ValueError):
    """Rows that cannot be scored."""


def validate(df: DataFrame) -> DataFrame:
    """Rows with ``reasons``: codes of everything wrong; an empty list means scorable.

    Blank numbers are allowed, they are imputed later.
    """
    S.check_inputs(df.columns, S.SCORING_INPUTS)

    def bad(name: str) -> Column:
        present = ~F.col(name).cast("string").isin(S.NULL_TOKENS)  # null for a null cell
        in_range = (F.col(f"_{name}") >= 0) & (F.col(f"_{name}") < F.lit(float("inf")))
        return present & ~F.coalesce(in_range, F.lit(False))

    df = df.withColumns({f"_{c}": C.number(df, c) for c in ("amount", "is_intl")} | {"_txn_ts": C.event_time(df, "txn_ts")})
    checks = F.array(
        F.when(F.col("_txn_ts").isNull(), "bad_date"),
        F.when(bad("amount"), "bad_amount"),
        F.when(bad("is_intl"), "bad_flag"),
        F.when((F.col("_is_intl") >= 0) & ~F.col("_is_intl").isin(0.0, 1.0), "flag_not_binary"),
    )
    return df.withColumn("reasons", F.array_compact(checks)).drop("_amount", "_is_intl", "_txn_ts")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scorable rows, rejected rows with reasons)."""
    checked = validate(df)
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def require_valid(df: DataFrame) -> DataFrame:
    """Strict mode: one bad row rejects the input, as does an empty one."""
    first = validate(df).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("reasons")))).alias("r")
    ).first()
    if not first["n"]:
        raise InputError("Supply at least one transaction.")
    if first["r"]:
        raise InputError(f"Rejected input rows: {first['r']}")
    return df


def conform(df: DataFrame) -> DataFrame:
    """Scoring inputs in the types the fitted pipelines expect; other columns untouched."""
    text = {c: C.clean_text(F.col(c)) for c in [*S.CATEGORICAL, "keyword"] if c in df.columns}
    out = df.withColumns({"txn_ts": C.event_time(df, "txn_ts"), **text})
    return C.with_numbers(out, [c for c in S.NUMERIC if c in df.columns])


def review_status(model_flag: Column, anomaly_flag: Column) -> Column:
    return F.when(model_flag == 1, MODEL_REVIEW).when(anomaly_flag == 1, ANOMALY_REVIEW).otherwise(LOWER_SCORE)


def with_flags(df: DataFrame, threshold: float, cutoff: float) -> DataFrame:
    """Flags and review status from ``fraud_score`` and ``anomaly_score``."""
    flagged = df.withColumns({
        "predicted_fraud": (F.col("fraud_score") >= F.lit(float(threshold))).cast("int"),
        "anomaly_flag": (F.col("anomaly_score") >= F.lit(float(cutoff))).cast("int"),
    })
    return flagged.withColumn("review_status", review_status(F.col("predicted_fraud"), F.col("anomaly_flag")))


def signal_counts(df: DataFrame) -> DataFrame:
    m, a = F.col("predicted_fraud") == 1, F.col("anomaly_flag") == 1
    return df.agg(
        F.count_if(m).alias("model_flags"), F.count_if(a).alias("anomaly_flags"), F.count_if(m & a).alias("both_signals")
    )


def _row_id(df: DataFrame) -> Column:
    if "txn_id" in df.columns:
        return F.col("txn_id").cast("string")
    # A row number means nothing on a distributed table: name the row by its content.
    return F.concat(F.lit("ROW-"), F.hex(F.xxhash64(*df.columns)))


def alert_records(df: DataFrame) -> DataFrame:
    """The eight-field record of every flagged row."""
    flagged = df.where(F.col("predicted_fraud") == 1)
    return flagged.select(
        F.lit(ALERT_STATUS).alias("status"),
        F.lit(ALERT_ACTION).alias("action"),
        _row_id(df).alias("transaction_id"),
        C.iso_text(F.col("txn_ts")).alias("transaction_date"),
        C.finite(F.col("amount").cast("double")).alias("amount"),
        F.col("fraud_score").cast("double").alias("fraud_score"),
        F.col("anomaly_flag").cast("int").alias("anomaly_flag"),
        F.lit(ALERT_MESSAGE).alias("message"),
    )


def alerts(df: DataFrame, limit: int | None = 25) -> DataFrame:
    """Highest scores first, at most ``limit`` (``None`` for all); ties by ID."""
    if limit is not None and limit < 0:
        raise ValueError("limit must be nonnegative")
    ranked = alert_records(df).orderBy(F.col("fraud_score").desc(), F.col("transaction_id"))
    return ranked if limit is None else ranked.limit(limit)


def review_queue(df: DataFrame, limit: int = 100) -> DataFrame:
    """Rows either detector flagged, highest model score first."""
    from txnrisk.operators.split import label_text

    queue = df.where((F.col("predicted_fraud") == 1) | (F.col("anomaly_flag") == 1))
    return queue.orderBy(F.col("fraud_score").desc(), F.col("txn_id")).limit(limit).select(
        "txn_id", "txn_ts", "amount", "fraud_score", "anomaly_score", "review_status",
        label_text(F.col("label")).alias("actual_label"), "score_context",
    )
