"""Full rebuild: audit, clean, split, fit, select, evaluate, score, alert.

    python -m txnrisk.plans.training --data feed.csv --output-dir out
"""

from __future__ import annotations

import argparse
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions.coerce import iso_text
from txnrisk.operators import clean as CL
from txnrisk.operators import diagnostics as D
from txnrisk.operators import kernels as K
from txnrisk.operators import metrics as M
from txnrisk.operators import models as MD
from txnrisk.operators import scoring as S
from txnrisk.operators import split as SP
from txnrisk.operators.analytics import template_rows
from txnrisk.operators.iforest import IsolationForest
from txnrisk.operators.boosting import bin_bounds
from txnrisk.operators.preprocess import fitted_variants
from txnrisk.session import build_session, stage, tune
from txnrisk.sources import readers as R
from txnrisk.sources import writers as W
from txnrisk.sources.schema import FEED_COLUMNS, SCORING_INPUTS

# Fixed values of the comparison table and the selection record.
DUMMY, ANOMALY = "Dummy prior / no fraud alerts", "Isolation Forest"
REVIEW_QUANTILE = 0.90
EXCLUDED = [
    "Transaction_ID", "Customer_ID", "Fraudulent", "Suspicious_Keyword", "Previous_Transactions", "Average_Spend",
    "Account_Age_Days",
]


SCORE_KEYS = ["txn_id", "customer_id", "split", "label"]


def score_wide(fitted: dict, forest: IsolationForest, parts: DataFrame, prior: float) -> DataFrame:
    """One row per transaction with a score column per model: one scan, no shuffle."""
    wide = forest.score(MD.score_wide(fitted, parts), ANOMALY).withColumn(DUMMY, F.lit(prior))
    return wide.select(*SCORE_KEYS, *[F.col(f"`{c}`") for c in (*fitted, ANOMALY, DUMMY)])


def long_form(wide: DataFrame) -> DataFrame:
    """(txn, split, label, model, kind, score) rows of a wide score table, without a shuffle."""
    kinds = {ANOMALY: "unsupervised", DUMMY: "baseline"}
    cells = [
        F.struct(F.lit(c).alias("model"), F.lit(kinds.get(c, "supervised")).alias("kind"), F.col(f"`{c}`").alias("score"))
        for c in wide.columns if c not in SCORE_KEYS
    ]
    return wide.select(*SCORE_KEYS, F.explode(F.array(*cells)).alias("m")).select(*SCORE_KEYS, "m.*")


def feature_bounds(table: DataFrame) -> list:
    """Bounds of bins of a feature table's columns."""
    rows = table.select(vector_to_array("features").alias("x"))
    return bin_bounds(rows, rows.select(F.size("x").alias("n")).first()["n"])


def scaled_preprocess(fitted: dict) -> PipelineModel | None:
    """The scaled preprocessing of the fitted candidates, if one has it: the isolation forest takes the same."""
    return next((PipelineModel(fitted[name].stages[:-1]) for name, c in MD.candidates().items() if c.scale and name in fitted), None)


def fit_all(train: DataFrame, names: list[str] | None = None, parallel: int = 4) -> dict:
    """Every candidate, ``parallel`` at a time.

    Preprocessing is fitted and the feature table written once per variant, not once per model; row and class counts are taken once.
    """
    chosen = {k: v for k, v in MD.candidates().items() if names is None or k in names}
    rows, weight = train.count(), MD.weight_column(train.select("label"))
    ready = fitted_variants(train, sorted({c.scale for c in chosen.values()}))
    tables = {scale: stage(MD.feature_table(train, model), "features") for scale, model in ready.items()}
    families = {name: c.family(rows) for name, c in chosen.items()}
    # Ensembles cut the features of a table into the same bins, so these are found once.
    binned = {chosen[name].scale for name, family in families.items() if MD.binned(family)} if rows else set()
    bounds = {scale: feature_bounds(tables[scale]) for scale in binned}
    for name, family in families.items():
        if MD.binned(family):
            family.bounds = bounds.get(chosen[name].scale)

    def fit(name: str):
        c = chosen[name]
        return MD.fit_on(tables[c.scale], rows, ready[c.scale], families[name], weight if c.balanced else None)

    # Ensembles take longest and start first; the models come in the order of the candidates.
    longest = sorted(chosen, key=lambda name: [MD.boosting, MD.forest].index(chosen[name].family) if chosen[name].family in (MD.boosting, MD.forest) else 2)
    with ThreadPoolExecutor(parallel) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fit), name) for name in longest}
        return {name: jobs[name].result() for name in chosen}


def run(
    spark: SparkSession, feed: DataFrame, out: str, names: list[str] | None = None, digest: DataFrame | None = None,
    diagnostics: bool = True, trees: int = 250, repeats: int = 400,
) -> dict:
    """Run the whole protocol and write every result under ``out``; returns the headline numbers."""
    tune(spark)
    # The feed is parsed and folded once; audit, key check and clean table read the result.
    parsed = stage(CL.typed(CL.distinct_rows(feed)), "parsed")
    W.write_clean(CL.require_unique(CL.valid_rows(parsed)), f"{out}/clean", check=False)
    W.write_text(R.read_clean(spark, f"{out}/clean").drop("txn_month"), f"{out}/clean_csv")
    # Everything below reads the stored table: no recomputation of the cleaning.
    df = R.read_clean(spark, f"{out}/clean").drop("txn_month")
    identity = CL.fingerprint(df).first().asDict()  # ties every model of this run to its rows
    if digest is not None:
        W.write_table(digest, f"{out}/source_files")  # one row per file, however many there are
    W.write_document(audit_document(parsed, df, identity, digest is not None), f"{out}/audit")

    cuts = SP.find_cuts(df)
    SP.check_cuts(df, cuts)
    W.write_document(split_document(df, cuts), f"{out}/split_summary")
    W.write_table(SP.assignments(df, cuts), f"{out}/split_assignments")
    train = df.where(cuts.condition("train"))
    tagged = SP.with_split(df, cuts)

    fitted = fit_all(train, names)
    forest = IsolationForest.fit(train, trees=trees, preprocess=scaled_preprocess(fitted))
    # Scored once, in Python; the quantile reads the result several times.
    anomalies = stage(forest.score(train).select("anomaly_score"), "anomaly-scores")
    cutoff = K.exact_quantiles(anomalies, {"a": (F.col("anomaly_score"), [REVIEW_QUANTILE])})["a"][0]
    prior = float(train.agg(F.avg("label")).first()[0])
    held_out = tagged.where(~cuts.condition("train"))
    W.write_table(score_wide(fitted, forest, held_out, prior), f"{out}/model_scores")
    wide = spark.read.parquet(f"{out}/model_scores")
    scores, models = long_form(wide), len(fitted) + 2

    # Selection sees validation rows only and is written before any test metric.
    val_scores = scores.where((F.col("split") == "validation") & (F.col("kind") == "supervised"))
    val_ranked = stage(M.ranking(val_scores, groups=["model"], group_limit=len(fitted)), "validation-ranking")
    tuned = M.choose_per_group(M.sweep(val_ranked, groups=["model"]), ["model"])
    thresholds = {r["model"]: r["threshold"] for r in tuned.collect()}
    val_table = M.compare(scores.where(F.col("split") == "validation"), fixed={ANOMALY: cutoff}, models=models)
    best = M.select_model(val_table).first()
    selected, threshold = best["model"], thresholds[best["model"]]
    selection = {
        "model": selected, "threshold": threshold, "validation": best.asDict(), "fit_partition": "train only",
        "criterion": "average precision on the validation part, the alphabetically first model among equals",
        "threshold_policy": "largest F1 on the validation part, the higher recall among equals",
        "data_identity": identity,
        "excluded_features": EXCLUDED, "input_columns": SCORING_INPUTS, "seed": MD.SEED, "anomaly_cutoff": cutoff,
    }
    W.write_document(json_document(spark, selection), f"{out}/selection")
    W.write_table(M.sweep(val_ranked.where(F.col("model") == selected)), f"{out}/validation_thresholds")
    MD.save_model(fitted[selected], f"{out}/models/classifier")
    forest.save(spark, f"{out}/models/iforest")

    W.write_table(M.compare(scores, fixed={ANOMALY: cutoff}, models=models), f"{out}/model_comparison")
    table = spark.read.parquet(f"{out}/model_comparison")
    test_scores = scores.where((F.col("split") == "test") & (F.col("model") != DUMMY))
    W.write_table(M.curves(M.ranking(test_scores, groups=["model"], group_limit=models), ["model"]), f"{out}/performance_curves")
    W.write_table(wide.where(F.col("split") == "test").drop(DUMMY), f"{out}/test_model_scores")
    chosen = test_scores.where(F.col("model") == selected).select("txn_id", "customer_id", "label", "score")
    intervals = D.grouped_bootstrap(chosen, threshold, repeats)
    W.write_table(intervals.withColumns({"method": F.lit(D.METHOD), "seed": F.lit(MD.SEED)}), f"{out}/test_confidence_intervals")
    # The scores carry the customer, so only the training part's customers are looked up.
    seen = SP.flag_seen(chosen, train).withColumn("customer_slice", F.when(F.col("seen"), "seen in training").otherwise("unseen in training"))
    W.write_table(M.evaluate(seen, threshold, groups=["customer_slice"], group_limit=2), f"{out}/customer_slices")
    W.write_document(metrics_document(spark, out, selected), f"{out}/metrics")
    if diagnostics:
        val = df.where(cuts.condition("validation"))
        W.write_table(D.sensitivity(train, val, MD.candidates()[selected], fitted[selected]), f"{out}/feature_sensitivity")
        W.write_table(D.permutation_importance(lambda d: MD.score(fitted[selected], d, "score"), val), f"{out}/feature_importance")

    # The part is a function of time alone: no join.
    scored = SP.with_context(S.with_flags(forest.score(MD.score(fitted[selected], tagged)), threshold, cutoff))
    W.write_scored(scored, f"{out}/scored", f"{out}/test_predictions")
    stored = spark.read.parquet(f"{out}/scored")
    W.write_alerts(S.alerts(stored.where(F.col("split") == "test")), f"{out}/alerts")
    W.write_text(template_rows(df, SCORING_INPUTS), f"{out}/input_template")
    test_row = table.where((F.col("model") == selected) & (F.col("split") == "test")).first()
    return {"selected_model": selected, "threshold": threshold, "anomaly_cutoff": cutoff, "test": test_row.asDict()}


def audit_document(parsed: DataFrame, clean: DataFrame, identity: dict, digested: bool = False) -> DataFrame:
    """One row: the audit counters, the history caution and the identity of the clean table (and where file digests lie)."""
    spark = parsed.sparkSession
    row = CL.summarize(parsed).withColumns({c: iso_text(F.col(c)) for c in ("min_date", "max_date")}).first().asDict(recursive=True)
    row["columns"] = FEED_COLUMNS
    row["history_caution"] = {**CL.history_decreases(clean).first().asDict(), "interpretation": CL.INTERPRETATION}
    row["data_identity"] = identity
    if digested:
        row["source_files"] = "source_files"
    return json_document(spark, row)


def split_document(df: DataFrame, cuts: SP.Cuts) -> DataFrame:
    spark = df.sparkSession
    rows = SP.split_summary(df, cuts).withColumns({c: iso_text(F.col(c)) for c in ("start", "end")}).collect()
    doc = {r["split"]: r.asDict() for r in rows}
    doc["customer_overlap"] = SP.customer_overlap(df, cuts).first().asDict()
    doc["policy"] = "Cut by time at 60 and 80 percent of the rows, equal times kept together; customers may recur, keys are no features."
    return json_document(spark, doc)


def metrics_document(spark: SparkSession, out: str, selected: str) -> DataFrame:
    """One nested record of the headline results, from the stored result tables (a few rows each)."""
    table = {(r["model"], r["split"]): r.asDict() for r in spark.read.parquet(f"{out}/model_comparison").collect()}
    intervals = spark.read.parquet(f"{out}/test_confidence_intervals").collect()
    return json_document(spark, {
        "final_model": selected,
        "test": table[selected, "test"],
        "validation": table[selected, "validation"],
        "isolation_forest_test": table[ANOMALY, "test"],
        "test_confidence_intervals": {
            "method": D.METHOD, "seed": MD.SEED, "repeats": intervals[0]["repeats"],
            "intervals_95": {r["metric"]: [r["lower"], r["upper"]] for r in intervals},
        },
        "customer_slices": [r.asDict() for r in spark.read.parquet(f"{out}/customer_slices").orderBy("customer_slice").collect()],
    })


def json_document(spark: SparkSession, doc: dict) -> DataFrame:
    """A nested record as a one-row DataFrame (schema taken from the JSON text)."""
    text = json.dumps(doc, allow_nan=False)
    schema = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    return spark.range(1).select(F.from_json(F.lit(text), schema).alias("d")).select("d.*")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--expected-sha256", help="digest of the one input file; another file ends the run")
    parser.add_argument("--digest", action="store_true", help="store the digest of every input file (reads the feed once more)")
    parser.add_argument("--no-diagnostics", action="store_true")
    args = parser.parse_args()
    spark = build_session("txnrisk-training")
    if args.expected_sha256:
        R.require_digest(spark, args.data, args.expected_sha256)
    digest = R.file_digests(spark, args.data) if args.digest or args.expected_sha256 else None
    print(json.dumps(run(spark, R.read_feed(spark, args.data), args.output_dir, digest=digest, diagnostics=not args.no_diagnostics), indent=2, default=str))


if __name__ == "__main__":
    main()
