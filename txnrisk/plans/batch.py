"""Batch scoring with saved models, and alert simulation on a scored table.

    python -m txnrisk.plans.batch score  --input in.csv --output out --model-dir run
    python -m txnrisk.plans.batch alerts --input out --output alerts --limit 25
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import models as MD
from txnrisk.operators import scoring as S
from txnrisk.operators.iforest import IsolationForest
from txnrisk.session import build_session, tune
from txnrisk.sources import readers as R
from txnrisk.sources import writers as W


@dataclass
class Artifacts:
    """Both fitted models with their frozen thresholds."""

    classifier: PipelineModel
    threshold: float
    forest: IsolationForest
    cutoff: float


def load_artifacts(spark: SparkSession, run_dir: str) -> Artifacts:
    """Saved models of one training run; load only folders you trust."""
    record = spark.read.json(f"{run_dir}/selection").select("threshold", "anomaly_cutoff").first()
    return Artifacts(
        MD.load_model(f"{run_dir}/models/classifier"), record["threshold"],
        IsolationForest.load(spark, f"{run_dir}/models/iforest"), record["anomaly_cutoff"],
    )


def score_transactions(df: DataFrame, artifacts: Artifacts, strict: bool = True) -> DataFrame:
    """All input columns as given, plus both scores, both flags and the review status.

    ``strict`` rejects the whole input if any row is bad; otherwise filter first with
    ``scoring.quarantine``.
    """
    if strict:
        S.require_valid(df)
    # The caller's cells travel along beside the cleaned ones, as one column.
    ready = S.conform(df.withColumn("_given", F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    scored = artifacts.forest.score(MD.score(artifacts.classifier, ready))
    flagged = S.with_flags(scored, artifacts.threshold, artifacts.cutoff)
    return flagged.select("_given.*", *[c for c in flagged.columns if c not in df.columns and c != "_given"])


def score_file(spark: SparkSession, source: str, target: str, run_dir: str, quarantine: str | None = None) -> None:
    tune(spark)
    df = R.read_scoring_input(spark, source)
    if quarantine:
        df, rejected = S.quarantine(df)
        W.write_table(rejected, quarantine)
    W.write_text(score_transactions(df, load_artifacts(spark, run_dir), strict=not quarantine), target)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    score = jobs.add_parser("score")
    score.add_argument("--input", required=True)
    score.add_argument("--output", required=True)
    score.add_argument("--model-dir", required=True)
    score.add_argument("--quarantine")
    alert = jobs.add_parser("alerts")
    alert.add_argument("--input", required=True)
    alert.add_argument("--output", required=True)
    alert.add_argument("--limit", type=int, default=25)
    alert.add_argument("--format", choices=["csv", "parquet"], help="of the input; by default what lies there")
    args = parser.parse_args()
    if args.job == "alerts" and args.limit < 0:
        parser.error("--limit must be nonnegative")
    spark = tune(build_session(f"txnrisk-{args.job}"))
    if args.job == "score":
        score_file(spark, args.input, args.output, args.model_dir, args.quarantine)
    else:
        W.write_alerts(S.alerts(R.read_scored(spark, args.input, args.format), args.limit), args.output)


if __name__ == "__main__":
    main()
