"""Chronological split, its guards and summaries, and joins back to it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.operators import kernels as K

SPLITS = ["train", "validation", "test"]
CONTEXT = {"train": "in-sample", "validation": "selection/tuning", "test": "held-out evaluation"}
MIN_ROWS = 100


@dataclass(frozen=True)
class Cuts:
    """First timestamps of the validation and test periods."""

    rows: int
    validation: dt.datetime
    test: dt.datetime

    def condition(self, split: str, ts: str = "txn_ts") -> Column:
        """Predicate on time alone, so that it is pushed into the scan."""
        t, a, b = F.col(ts), K.ntz(self.validation), K.ntz(self.test)
        return {"train": t < a, "validation": (t >= a) & (t < b), "test": t >= b}[split]

    def tag(self, ts: str = "txn_ts") -> Column:
        t = F.col(ts)
        return F.when(t < K.ntz(self.validation), "train").when(t < K.ntz(self.test), "validation").otherwise("test")


def find_cuts(df: DataFrame, ts: str = "txn_ts") -> Cuts:
    """60/20/20 by time; rows with equal timestamps stay together in the later part."""
    n, (a, b) = K.times_at(df, ts, [0.6, 0.8])
    return Cuts(n, a, b)


def check_cuts(df: DataFrame, cuts: Cuts, label: str = "label") -> None:
    """At least 100 rows, and both classes in every part."""
    if cuts.rows < MIN_ROWS:
        raise ValueError(f"A split needs at least {MIN_ROWS} transactions.")
    seen = df.groupBy(cuts.tag().alias("split")).agg(F.min(label).alias("lo"), F.max(label).alias("hi")).collect()
    by = {r["split"]: (r["lo"], r["hi"]) for r in seen}
    for split in SPLITS:
        if by.get(split) != (0, 1):
            raise ValueError(f"The {split} part has rows of one class only.")


def with_split(df: DataFrame, cuts: Cuts) -> DataFrame:
    return df.withColumn("split", cuts.tag())


def assignments(df: DataFrame, cuts: Cuts) -> DataFrame:
    return with_split(df, cuts).select("txn_id", "customer_id", "txn_ts", "label", "split")


def split_summary(df: DataFrame, cuts: Cuts) -> DataFrame:
    return with_split(df, cuts).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("label").alias("positives"),
        F.avg("label").alias("rate"),
        F.min("txn_ts").alias("start"),
        F.max("txn_ts").alias("end"),
        F.countDistinct("customer_id").alias("customers"),
    )


def customer_overlap(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Customers present in both parts of each pair, from one pass per customer."""
    present = with_split(df, cuts).groupBy("customer_id").agg(
        *[F.max(F.col("split") == s).alias(s) for s in SPLITS]
    )
    return present.agg(
        *[F.count_if(F.col(a) & F.col(b)).alias(f"{a}_{b}") for a, b in combinations(SPLITS, 2)]
    )


def disjoint_check(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Per neighbouring pair: shared IDs (must be 0) and whether time is strictly increasing."""
    ends = (("lo", F.min), ("hi", F.max))
    ids = with_split(df, cuts).groupBy("txn_id").agg(
        *[F.max(F.col("split") == s).alias(s) for s in SPLITS],
        *[f(F.when(F.col("split") == s, F.col("txn_ts"))).alias(f"{s}_{n}") for s in SPLITS for n, f in ends],
    )
    total = ids.agg(
        *[F.count_if(F.col(a) & F.col(b)).alias(f"shared_{a}_{b}") for a, b in combinations(SPLITS, 2)],
        *[f(f"{s}_{n}").alias(f"{s}_{n}") for s in SPLITS for n, f in ends],
    )
    return total.select(
        *[f"shared_{a}_{b}" for a, b in combinations(SPLITS, 2)],
        (F.col("train_hi") < F.col("validation_lo")).alias("train_before_validation"),
        (F.col("validation_hi") < F.col("test_lo")).alias("validation_before_test"),
    )


def seen_flag(df: DataFrame, cuts: Cuts, split: str = "test") -> DataFrame:
    """Rows of ``split`` with ``seen``: whether the customer occurs in the training part."""
    return flag_seen(df.where(cuts.condition(split)), df.where(cuts.condition("train")))


def flag_seen(rows: DataFrame, train: DataFrame) -> DataFrame:
    """``rows`` (with txn_id, customer_id) and ``seen``: whether ``train`` has the customer."""
    known = train.select("customer_id").distinct().withColumn("seen", F.lit(True))
    out = K.lookup(rows, known, "customer_id", ["seen"])
    return out.withColumn("seen", F.coalesce("seen", F.lit(False)))


def check_unique(df: DataFrame, key: str) -> None:
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} is not unique")


def join_context(scored: DataFrame, split_table: DataFrame, validate: bool = True) -> DataFrame:
    """One-to-one join of scores to their part, with the context text of each part."""
    if validate:
        check_unique(scored, "txn_id")
        check_unique(split_table, "txn_id")
    return with_context(scored.join(split_table.select("txn_id", "split"), "txn_id"))


def with_context(df: DataFrame) -> DataFrame:
    """The context text of each row's part (column ``split``)."""
    text = F.lit(None).cast("string")
    for split, context in CONTEXT.items():
        text = F.when(F.col("split") == split, context).otherwise(text)
    return df.withColumn("score_context", text)


def label_text(col: Column) -> Column:
    return F.when(col == 0, "Legitimate").when(col == 1, "Fraudulent")
