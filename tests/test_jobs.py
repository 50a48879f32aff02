"""End-to-end jobs: training run, batch scoring, streams."""

import json

import pytest
from pyspark.sql import functions as F

from txnrisk.operators import analytics as A
from txnrisk.operators import clean as CL
from txnrisk.operators import metrics as M
from txnrisk.operators import scoring as S
from txnrisk.plans import batch as B
from txnrisk.plans import training as TR
from txnrisk.sources import readers as R
from txnrisk.sources import schema as SC
from txnrisk.sources import tables as T
from txnrisk.sources import writers as W
from txnrisk.streaming import jobs as J

NAMES = ["Logistic Regression (unweighted)", "Decision Tree (balanced)"]


@pytest.fixture(scope="module")
def run(spark, sf, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    source = f"{out}/feed"
    T.raw_feed(spark, sf).write.option("header", True).csv(source)
    feed = R.read_feed(spark, source)
    head = TR.run(spark, feed, f"{out}/a", NAMES, R.file_digests(spark, source), trees=20, repeats=25)
    return out, feed, head


def test_run_writes_every_result(spark, run):
    out, feed, head = run
    table = spark.read.parquet(f"{out}/a/model_comparison").toPandas()
    assert len(table) == (len(NAMES) + 2) * 2 and set(table.model[table.selected]) == {head["selected_model"]}
    dummy = table[(table.kind == "baseline")].iloc[0]
    assert dummy.average_precision == pytest.approx(dummy.prevalence) and dummy.alert_count == 0
    scored = spark.read.parquet(f"{out}/a/scored")
    clean = CL.clean_rows(feed)
    assert scored.count() == clean.count()
    test_rows = spark.read.parquet(f"{out}/a/test_predictions")
    assert test_rows.count() == scored.where("split = 'test'").count() and {r[0] for r in test_rows.select("score_context").distinct().collect()} == {"held-out evaluation"}
    # The stored scores give the reported test metrics.
    again = M.evaluate(test_rows.withColumnRenamed("fraud_score", "score"), head["threshold"]).first()
    for m in ("precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc", "tp", "fp", "fn", "tn"):
        assert again[m] == pytest.approx(head["test"][m], abs=1e-12), m
    selection = spark.read.json(f"{out}/a/selection").first()
    assert selection["model"] == head["selected_model"] and selection["fit_partition"] == "train only"
    record = spark.read.json(f"{out}/a/metrics").first()
    assert record["final_model"] == head["selected_model"] and record["test"]["tp"] == head["test"]["tp"]
    assert len(record["test_confidence_intervals"]["intervals_95"]["f1"]) == 2 and len(record["customer_slices"]) >= 1
    audit = spark.read.json(f"{out}/a/audit").first()
    assert audit["rows_clean"] == clean.count() and audit["source_files"] == "source_files"
    assert len(spark.read.parquet(f"{out}/a/source_files").first()["sha256"]) == 64
    assert selection["data_identity"]["rows"] == audit["rows_clean"]
    split = spark.read.json(f"{out}/a/split_summary").first()
    assert split["train"]["rows"] + split["validation"]["rows"] + split["test"]["rows"] == clean.count()
    for name in ("performance_curves", "test_model_scores", "test_confidence_intervals", "customer_slices", "feature_sensitivity",
                 "feature_importance", "validation_thresholds", "split_assignments"):
        assert spark.read.parquet(f"{out}/a/{name}").count() > 0, name
    assert R.read_text_table(spark, f"{out}/a/input_template").count() == 8
    slices = spark.read.parquet(f"{out}/a/customer_slices").agg(F.sum("n")).first()[0]
    assert slices == head["test"]["n"]


def test_second_run_reproduces_the_first(spark, run):
    out, feed, head = run
    again = TR.run(spark, feed.repartition(3), f"{out}/b", NAMES, diagnostics=False, trees=20, repeats=5)
    assert again["selected_model"] == head["selected_model"]
    a, b = (spark.read.parquet(f"{out}/{x}/scored") for x in "ab")
    # Solver sums depend on partitioning in the last digits.
    assert M.score_diff(a, b, "txn_id", ["fraud_score", "anomaly_score", "predicted_fraud", "anomaly_flag"], 1e-6).count() == 0


def test_batch_job(spark, run, tmp_path):
    out, _, _ = run
    source = spark.read.parquet(f"{out}/a/scored").where("split = 'test'").orderBy("txn_id")
    W.write_text(source.select("txn_id", *SC.SCORING_INPUTS), str(tmp_path / "in"))
    B.score_file(spark, str(tmp_path / "in"), str(tmp_path / "out.csv"), f"{out}/a")
    back = R.read_scored(spark, str(tmp_path / "out.csv")).withColumn("txn_id", F.col("txn_id"))
    assert M.score_diff(back, source, "txn_id", ["fraud_score", "anomaly_score", "predicted_fraud", "anomaly_flag"]).count() == 0
    assert S.alerts(back, 5).count() <= 5


def test_batch_job_quarantine(spark, run, tmp_path):
    out, _, _ = run
    rows = spark.read.parquet(f"{out}/a/scored").where("split = 'test'").limit(30).select("txn_id", *SC.SCORING_INPUTS)
    rows = rows.withColumn("amount", F.when(F.col("txn_id") == rows.agg(F.min("txn_id")).first()[0], F.lit("bad")).otherwise(F.col("amount").cast("string")))
    W.write_text(rows, str(tmp_path / "in"))
    with pytest.raises(S.InputError):
        B.score_file(spark, str(tmp_path / "in"), str(tmp_path / "o1"), f"{out}/a")
    B.score_file(spark, str(tmp_path / "in"), str(tmp_path / "o2"), f"{out}/a", str(tmp_path / "rejected"))
    assert R.read_text_table(spark, str(tmp_path / "o2")).count() == 29
    assert spark.read.parquet(str(tmp_path / "rejected")).first()["reasons"] == ["bad_amount"]


# -------------------------------------------------------------------------- streaming

@pytest.fixture(scope="module")
def feed_dir(spark, sf, tmp_path_factory):
    """The event table in time order as four files, a replayed file and a late file."""
    path = tmp_path_factory.mktemp("stream")
    evt = T.events(spark, sf).orderBy("txn_ts").toPandas()
    n = len(evt)
    pieces = [evt.iloc[i * n // 4:(i + 1) * n // 4] for i in range(4)]
    late = evt.iloc[:20].assign(txn_id=lambda d: d.txn_id + 10**9)
    schema = T.events(spark, sf).schema
    import os
    import time

    for i, p in enumerate([*pieces, evt.iloc[-50:], late]):
        spark.createDataFrame(p, schema).coalesce(1).write.parquet(str(path / f"tmp{i}"))
        file = next((path / f"tmp{i}").glob("*.parquet"))
        (path / "in").mkdir(exist_ok=True)
        target = path / "in" / f"{i}.parquet"
        target.write_bytes(file.read_bytes())
        os.utime(target, (time.time() - 100 + i, time.time() - 100 + i))  # file age orders the stream
    return str(path / "in"), evt, schema


def test_stream_scores_and_alerts_equal_the_batch(spark, run, parts, tmp_path):
    out, _, _ = run
    art = B.load_artifacts(spark, f"{out}/a")
    rows = parts["test"].select("txn_id", *SC.SCORING_INPUTS)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = J.read_stream(spark, str(tmp_path / "in"), rows.schema)
    J.write_table_stream(J.score_stream(stream, art), str(tmp_path / "t"), str(tmp_path / "c1")).awaitTermination()
    want = B.score_transactions(rows, art)
    got = spark.read.parquet(str(tmp_path / "t"))
    assert M.score_diff(got, want, "txn_id", ["fraud_score", "anomaly_score", "predicted_fraud", "anomaly_flag"]).count() == 0
    J.write_alert_stream(J.score_stream(J.read_stream(spark, str(tmp_path / "in"), rows.schema), art), str(tmp_path / "a"), str(tmp_path / "c2")).awaitTermination()
    lines = [json.loads(x) for f in (tmp_path / "a").glob("batch=*/*.json") for x in f.read_text().splitlines()]
    assert {r["transaction_id"] for r in lines} == {r["transaction_id"] for r in S.alerts(want, None).collect()}
    assert len(lines) == len({r["transaction_id"] for r in lines})


def test_replays_are_dropped(spark, feed_dir, tmp_path):
    path, evt, schema = feed_dir
    stream = J.drop_replays(J.read_stream(spark, path, schema), "60 days")
    J.write_table_stream(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.where("txn_id < 1000000000").count() == len(evt) == got.where("txn_id < 1000000000").select("txn_id").distinct().count()


def test_closed_days_equal_the_batch_trend(spark, sf, feed_dir, tmp_path):
    path, evt, schema = feed_dir
    once = J.drop_replays(J.read_stream(spark, path, schema), "2 days").drop("w")
    per = J.live_trend(J.read_stream(spark, path, schema).where("txn_id < 1000000000"), "1 day", "2 days")
    J.write_table_stream(per, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    got = {r["period"].date(): (r["transactions"], r["positives"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    want = {r["period"]: (r["transactions"], r["positives"]) for r in A.trend(T.events(spark, sf), "day").collect()}
    last = max(want)
    closed = {d: v for d, v in want.items() if (last - d).days > 3}
    assert closed and all(got[d] == v for d, v in closed.items())
    assert once.isStreaming


def test_two_sinks_survive_a_replayed_batch(spark, parts, tmp_path):
    """The same micro-batches again, as after a lost checkpoint: no row is doubled and none is in both sinks."""
    from txnrisk.streaming import jobs as J

    rows = parts["test"].withColumn("txn_ts", F.when(F.col("txn_id") % 5 != 0, F.col("txn_ts")))
    rows.repartition(4, "txn_id").write.parquet(str(tmp_path / "in"))
    for k in range(2):
        stream = J.read_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=2)
        J.write_scored_and_rejected(stream, lambda d: d.select("txn_id", "amount"), str(tmp_path / "out"), str(tmp_path / f"checkpoint{k}")).awaitTermination()
    good, bad = (spark.read.parquet(str(tmp_path / "out" / s)) for s in ("scored", "rejected"))
    assert good.count() + bad.count() == rows.count() and good.join(bad, "txn_id").count() == 0
    assert bad.select("txn_id").distinct().count() == bad.count() == rows.where("txn_id % 5 = 0").count()
