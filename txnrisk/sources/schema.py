"""Column contract of the transaction feed.

Fixed values: header names, scoring inputs and status texts are part of the
interface and are spelled exactly as callers expect them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Feed header -> engine column, in feed order.
FEED_TO_ENGINE = {
    "Transaction_ID": "txn_id",
    "Customer_ID": "customer_id",
    "Transaction_Date": "txn_ts",
    "Transaction_Amount": "amount",
    "Is_International": "is_intl",
    "Previous_Transactions": "previous_txns",
    "Average_Spend": "average_spend",
    "Account_Age_Days": "account_age_days",
    "Merchant_Category": "category",
    "Payment_Method": "method",
    "Device_Type": "device",
    "Location": "location",
    "Suspicious_Keyword": "keyword",
    "Fraudulent": "label",
}
SCORE_TO_ENGINE = {
    "Fraud_Score": "fraud_score",
    "Predicted_Fraud": "predicted_fraud",
    "Anomaly_Score": "anomaly_score",
    "Anomaly_Flag": "anomaly_flag",
    "Review_Status": "review_status",
    "Split": "split",
    "Score_Context": "score_context",
}
ENGINE_TO_FEED = {v: k for k, v in {**FEED_TO_ENGINE, **SCORE_TO_ENGINE}.items()}

FEED_COLUMNS = list(FEED_TO_ENGINE)
KEYS = ["txn_id", "customer_id"]
CATEGORICAL = ["category", "method", "device", "location"]
HISTORY = ["previous_txns", "average_spend", "account_age_days"]
NUMERIC = ["amount", "is_intl", *HISTORY]
TEXT = [*KEYS, *CATEGORICAL, "keyword"]
SCORING_INPUTS = ["txn_ts", "amount", "is_intl", *CATEGORICAL]

# Cell texts a delimited file uses for "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class SchemaError(ValueError):
    """The columns of an input do not fit the contract."""


def check_feed_header(columns: Iterable[str]) -> None:
    """A training feed must have exactly the contract's columns."""
    have = set(columns)
    missing = sorted(set(FEED_COLUMNS) - have)
    if missing:
        raise SchemaError(f"The feed lacks these columns: {missing}")
    extra = sorted(have - set(FEED_COLUMNS))
    if extra:
        raise SchemaError(f"The feed has columns outside the contract: {extra}")


def check_inputs(columns: Iterable[str], needed: Iterable[str]) -> None:
    """Other inputs need at least ``needed``; extra columns pass through."""
    missing = sorted(set(needed) - set(columns))
    if missing:
        raise SchemaError(f"Missing input columns: {[ENGINE_TO_FEED.get(c, c) for c in missing]}")


def to_engine_names(df: DataFrame) -> DataFrame:
    """Rename feed headers to engine names; other columns stay."""
    return df.withColumnsRenamed({k: v for k, v in {**FEED_TO_ENGINE, **SCORE_TO_ENGINE}.items() if k in df.columns})


def to_feed_names(df: DataFrame) -> DataFrame:
    """Rename engine columns to the headers the files carry."""
    return df.withColumnsRenamed({k: v for k, v in ENGINE_TO_FEED.items() if k in df.columns})
