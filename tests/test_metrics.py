import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.operators import analytics as A
from txnrisk.operators import metrics as M
from txnrisk.operators import scoring as S

# Published (tn, fp, fn, tp) with their precision, recall and F1.
CONFUSIONS = [
    (792, 100, 46, 62, 0.38271604938271603, 0.5740740740740741, 0.45925925925925926),
    (677, 215, 16, 92, 0.2996742671009772, 0.8518518518518519, 0.4433734939759036),
    (798, 114, 44, 44, 0.27848101265822783, 0.5, 0.35772357723577236),
    (843, 69, 59, 29, 0.29591836734693877, 0.32954545454545453, 0.3118279569892473),
    (912, 0, 88, 0, 0.0, 0.0, 0.0),
]
# Published validation average precision per candidate; the first must be selected.
VALIDATION_AP = {
    "Logistic Regression (unweighted)": 0.3946805450491883,
    "Decision Tree (unweighted)": 0.33538768836365196,
    "Random Forest (unweighted)": 0.38475593861250756,
    "Histogram Gradient Boosting (unweighted)": 0.32345375451559155,
    "Logistic Regression (balanced)": 0.38408497190323393,
    "Decision Tree (balanced)": 0.33324596077281676,
    "Random Forest (balanced)": 0.38396123680741556,
    "Histogram Gradient Boosting (balanced)": 0.34102952633239497,
}


def rows(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def brute(y, s, t):
    """Plain definition of the metrics, threshold by threshold."""
    y, s = np.asarray(y), np.asarray(s)
    cuts = np.sort(np.unique(s))[::-1]
    p = np.array([y[s >= c].mean() for c in cuts])
    r = np.array([y[s >= c].sum() / y.sum() for c in cuts])
    ap = np.sum(np.diff(np.r_[0, r]) * p)
    area = np.trapezoid(np.r_[1, p], np.r_[0, r])
    gt = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    tp = int(((s >= t) & (y == 1)).sum())
    return {"roc_auc": gt, "average_precision": ap, "pr_auc": area, "tp": tp, "alert_count": int((s >= t).sum())}


@pytest.mark.parametrize("tn,fp,fn,tp,precision,recall,f1", CONFUSIONS)
def test_published_confusions(spark, tn, fp, fn, tp, precision, recall, f1):
    pairs = spark.createDataFrame([(0, 0.0, tn), (0, 1.0, fp), (1, 0.0, fn), (1, 1.0, tp)], "label int, score double, w int")
    df = pairs.withColumn("i", F.explode(F.expr("if(w > 0, sequence(1, w), array())")))
    for m in (M.evaluate(df, 0.5).first(), M.at_threshold(df, 0.5).first()):
        assert (m["tn"], m["fp"], m["fn"], m["tp"], m["n"]) == (tn, fp, fn, tp, 1000)
        np.testing.assert_allclose([m["precision"], m["recall"], m["f1"]], [precision, recall, f1], rtol=1e-12)


@pytest.mark.parametrize("positives", [108, 88])
def test_constant_score(spark, positives):
    m = M.evaluate(rows(spark, [(i < positives, 0.1) for i in range(1000)]), 0.5).first()
    prevalence = positives / 1000
    assert m["roc_auc"] == 0.5 and m["average_precision"] == pytest.approx(prevalence)
    assert m["pr_auc"] == pytest.approx((1 + prevalence) / 2) and m["alert_count"] == 0


def test_random_scores_against_definition(spark):
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    m = M.evaluate(rows(spark, zip(y, s)), 0.4).first().asDict()
    for k, v in brute(y, s, 0.4).items():
        assert m[k] == pytest.approx(v, rel=1e-12), k


def test_one_class_has_no_ranking_metrics(spark):
    m = M.evaluate(rows(spark, [(0, 0.2), (0, 0.9)]), 0.5).first()
    assert m["roc_auc"] is m["average_precision"] is m["pr_auc"] is None
    assert (m["fp"], m["tn"], m["recall"]) == (1, 1, 0.0)


def test_threshold_ties(spark):
    # Thresholds .9 and .5 share the best F1 of 2/3; recall decides for .5.
    best = M.choose(M.sweep(M.ranking(rows(spark, [(1, 0.9), (0, 0.7), (1, 0.5), (0, 0.5), (0, 0.1)])))).first()
    assert best["threshold"] == 0.5 and best["recall"] == 1.0 and best["f1"] == pytest.approx(2 / 3)


def test_roc_points(spark):
    pts = M.roc_curve(M.ranking(rows(spark, [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]))).collect()
    # (0, .5) lies on a line between its neighbours and is left out, as is (.5, .75).
    assert sorted((r["x"], r["y"]) for r in pts) == [(0.0, 0.0), (0.0, 0.25), (0.0, 0.75), (1.0, 0.75), (1.0, 1.0)]


def test_selection_uses_published_validation_rows(spark):
    table = spark.createDataFrame([(m, "supervised", "validation", ap) for m, ap in VALIDATION_AP.items()] +
                                  [("Other", "unsupervised", "validation", 0.9), ("Random Forest (balanced)", "supervised", "test", 0.95)],
                                  "model string, kind string, split string, average_precision double")
    assert M.select_model(table).first()["model"] == "Logistic Regression (unweighted)"
    tied = table.withColumn("average_precision", F.lit(0.3))
    assert M.select_model(tied).first()["model"] == "Decision Tree (balanced)"


def test_score_diff(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, None), (4, 0.1)], "id int, s double")
    b = spark.createDataFrame([(1, 0.5 + 1e-14), (2, 0.6), (3, 0.2), (5, 0.1)], "id int, s double")
    found = {r["id"]: r["reason"] for r in M.score_diff(a, b, "id", ["s"]).collect()}
    assert found == {2: "differs", 3: "differs", 4: "missing right", 5: "missing left"}
    assert M.metric_diff(a.where("id < 3"), a.where("id < 3"), ["id"], ["s"]).count() == 0


def scored(spark, n=60):
    return spark.range(n).select(
        F.col("id").alias("txn_id"), F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id as int))").alias("txn_ts"),
        F.when(F.col("id") % 10 == 3, None).otherwise(F.col("id") * 1.5).alias("amount"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") % 20 / 20).alias("fraud_score"), (F.col("id") % 7 / 7).alias("anomaly_score"), F.lit("test").alias("split"),
        F.lit("held-out evaluation").alias("score_context"), F.lit("Pune").alias("location"), F.lit("POS").alias("device"), F.lit("Travel").alias("category"),
    ).transform(lambda d: S.with_flags(d, 0.5, 0.8))


def test_alert_contract(spark, tmp_path):
    import json

    from txnrisk.sources.writers import write_alerts

    df = scored(spark)
    top = S.alerts(df, 25)
    write_alerts(top, str(tmp_path / "a"))
    records = [json.loads(line) for f in sorted((tmp_path / "a").glob("part*")) for line in f.read_text().splitlines()]
    assert len(records) == 25
    assert all(set(r) == {"status", "action", "transaction_id", "transaction_date", "amount", "fraud_score", "anomaly_flag", "message"} for r in records)
    assert all(r["fraud_score"] >= 0.5 and r["status"] == "SIMULATED_ONLY" for r in records)
    values = [r["fraud_score"] for r in top.collect()]
    assert values == sorted(values, reverse=True)
    assert any(r["amount"] is None for r in records)
    assert S.alerts(df, None).count() == df.where("predicted_fraud = 1").count()
    assert S.alerts(df, 0).count() == 0
    with pytest.raises(ValueError, match="nonnegative"):
        S.alerts(df, -1)
    nameless = S.alerts(df.drop("txn_id"), 5).collect()
    assert all(r["transaction_id"].startswith("ROW-") for r in nameless)


def test_empty_filter_gives_empty_tables(spark):
    none = A.filtered(scored(spark), location="Nowhere")
    assert A.kpis(none).first()["transactions"] == 0
    assert A.trend(none, "week").count() == 0 and A.category_stats(none, "category").count() == 0
    assert S.review_queue(none).count() == 0
    grid = A.heatmap(none).toPandas()
    assert grid.shape == (7, 25) and grid.drop(columns="weekday").to_numpy().sum() == 0


def test_filter_bounds_are_inclusive_days(spark):
    df = scored(spark)
    day = dt.date(2024, 1, 5)
    assert [r["txn_id"] for r in A.filtered(df, start=day, end=day).collect()] == [4]
    assert A.filtered(df, "test", dt.date(2024, 1, 1), dt.date(2024, 1, 3), "Pune", "POS", "Travel").count() == 3


def test_trend_fills_gap_weeks(spark):
    df = spark.sql("select timestamp_ntz'2024-01-03 10:00:00' txn_ts, 1 label, 2.0D amount union all select timestamp_ntz'2024-01-24 10:00:00', 0, 3.0D")
    got = {str(r["period"]): (r["transactions"], r["rate_percent"]) for r in A.trend(df, "week").collect()}
    assert got == {"2024-01-07": (1, 100.0), "2024-01-14": (0, None), "2024-01-21": (0, None), "2024-01-28": (1, 0.0)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0, float(x)) for x in (0, 5, 10)] + [(1, 10.0)], "label int, v double")
    got = {(r["label"], r["bin"]): r["n"] for r in A.histogram(df, "v", 10).collect()}
    assert got == {(0, 1): 1, (0, 6): 1, (0, 10): 1, (1, 10): 1}
    dens = A.histogram(df, "v", 4, density=True, per_group=True).toPandas()
    for _, p in dens.groupby("label"):
        assert (p.density * (p.right_edge - p.left_edge)).sum() == pytest.approx(1.0)


def test_null_category_is_a_group(spark):
    df = spark.createDataFrame([("a", 1, 1.0), (None, 0, 2.0), (None, 1, 4.0)], "category string, label int, amount double")
    got = {r["category"]: (r["transactions"], r["positives"], r["amount"], r["rate_percent"]) for r in A.category_stats(df, "category").collect()}
    assert got == {"a": (1, 1, 1.0, 100.0), None: (2, 1, 6.0, 50.0)}
