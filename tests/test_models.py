import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnrisk.functions import features as FT
from txnrisk.operators import diagnostics as D
from txnrisk.operators import metrics as M
from txnrisk.operators import models as MD
from txnrisk.operators import scoring as S
from txnrisk.operators.boosting import HistogramBoosting
from txnrisk.operators.forest import HistogramForest
from txnrisk.operators.iforest import IsolationForest, average_path, score_matrix, tree_samples
from txnrisk.operators.preprocess import Preprocess
from txnrisk.plans.batch import Artifacts, score_transactions
from txnrisk.sources.schema import SCORING_INPUTS, SchemaError


@pytest.fixture(scope="module")
def scaled(parts):
    return Preprocess(scale=True).fit(parts["train"])


@pytest.fixture(scope="module")
def lr(parts, scaled):
    return MD.fit_estimator(parts["train"], MD.logistic, scaled)


@pytest.fixture(scope="module")
def forest(parts, scaled):
    return IsolationForest.fit(parts["train"], trees=25, sample_size=64, preprocess=scaled)


@pytest.fixture(scope="module")
def bundle(lr, forest):
    return Artifacts(lr, 0.15, forest, 0.5)


def matrix(model, df):
    rows = model.transform(df).select(vector_to_array("features").alias("x"), "label").collect()
    return np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], float)


def test_statistics_come_from_the_training_part(parts):
    stats = Preprocess(scale=True).statistics(parts["train"])
    feats = parts["train"].select(*[F.expr(e).alias(n) for n, e in FT.feature_sql().items()]).toPandas()
    for name, s in stats.items():
        assert s["median"] == pytest.approx(feats[name].median(), abs=1e-12), name
        assert s["mean"] == pytest.approx(feats[name].mean(), abs=1e-9)
        assert s["std"] == pytest.approx(feats[name].std(ddof=0), abs=1e-9)


def test_all_null_and_constant_columns(parts):
    df = parts["train"].withColumn("amount", F.lit(None).cast("double")).withColumn("is_intl", F.lit(1))
    x, _ = matrix(Preprocess(scale=True).fit(df), df)
    assert np.isfinite(x).all()
    assert (x[:, 0] == 0).all() and (x[:, 1] == 0).all()  # filled with 0, and centred constant


def test_sensitivity_variants_have_more_columns(parts):
    width = {}
    for history, keyword in [(False, False), (True, False), (False, True)]:
        x, _ = matrix(Preprocess(False, history, keyword).fit(parts["train"]), parts["train"].limit(5))
        width[history, keyword] = x.shape[1]
    assert width[True, False] == width[False, False] + 8 and width[False, True] == width[False, False] + 2
    with pytest.raises(SchemaError, match="Missing input columns"):
        Preprocess(include_history=True).fit(parts["train"].drop("average_spend"))


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_regression_is_the_penalised_optimum(parts, scaled, balanced):
    model = MD.fit_estimator(parts["train"], MD.logistic, scaled, balanced)
    x, y = matrix(scaled, parts["train"])
    w = np.ones(len(y))
    if balanced:
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    design = np.c_[x, np.ones(len(y))]
    beta, ridge = np.zeros(design.shape[1]), np.r_[np.ones(x.shape[1]), 0.0]
    for _ in range(60):  # Newton steps on the weighted log loss with unit L2 penalty
        p = 1 / (1 + np.exp(-design @ beta))
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        beta -= np.linalg.solve(hess, design.T @ (w * (p - y)) + ridge * beta)
    got = np.r_[model.stages[-1].coefficients.toArray(), model.stages[-1].intercept]
    np.testing.assert_allclose(got, beta, atol=1e-5)


def test_registry_has_eight_candidates():
    names = list(MD.candidates())
    assert len(names) == 8 and names[0] == "Logistic Regression (unweighted)"
    assert {n.split(" (")[0] for n in names} == set(MD.FAMILIES)


def test_tree_families_fit_and_save(spark, parts, tmp_path):
    pre = Preprocess().fit(parts["train"])
    small = {
        "tree": MD.tree(1), "forest": HistogramForest(trees=5, depth=4), "boosting": HistogramBoosting(max_iter=3),
    }
    for name, est in small.items():
        model = MD.fit_estimator(parts["train"], est, pre, balanced=name == "forest")
        MD.save_model(model, str(tmp_path / name))
        again = MD.load_model(str(tmp_path / name))
        a, b = MD.score(model, parts["test"], "score"), MD.score(again, parts["test"], "score")
        assert M.score_diff(a, b, "txn_id", ["score"]).count() == 0
        lo, hi = a.agg(F.min("score"), F.max("score")).first()
        assert 0 <= lo < hi <= 1


def test_saved_models_reproduce_scores(spark, parts, bundle, tmp_path):
    MD.save_model(bundle.classifier, str(tmp_path / "c"))
    bundle.forest.save(spark, str(tmp_path / "f"))
    again = Artifacts(MD.load_model(str(tmp_path / "c")), 0.15, IsolationForest.load(spark, str(tmp_path / "f")), 0.5)
    a, b = (score_transactions(parts["test"], x) for x in (bundle, again))
    assert M.score_diff(a, b, "txn_id", ["fraud_score", "anomaly_score", "predicted_fraud", "anomaly_flag"]).count() == 0


def test_single_rows_score_like_the_batch(parts, bundle):
    rows = parts["test"].orderBy("txn_id").limit(3)
    batch = {r["txn_id"]: r for r in score_transactions(rows, bundle).collect()}
    for key, want in batch.items():
        got = score_transactions(parts["test"].where(F.col("txn_id") == key), bundle).first()
        assert got["fraud_score"] == pytest.approx(want["fraud_score"], abs=1e-12)
        assert got["anomaly_score"] == pytest.approx(want["anomaly_score"], abs=1e-12)


def test_excluded_fields_cannot_change_scores(parts, bundle):
    rows = parts["test"].limit(20).cache()
    changed = rows.withColumns({
        "label": 1 - F.col("label"), "customer_id": F.lit(-1).cast("bigint"), "keyword": F.lit("changed"), "average_spend": F.lit(999999.0),
        "previous_txns": F.lit(999999.0), "account_age_days": F.lit(999999.0),
    })
    a, b = score_transactions(rows, bundle), score_transactions(changed, bundle)
    assert M.score_diff(a, b, "txn_id", ["fraud_score", "anomaly_score"], 0.0).count() == 0


def test_missing_and_unseen_inputs_score_finite(parts, bundle):
    rows = parts["test"].limit(4).withColumns({
        "amount": F.lit(None).cast("double"), "is_intl": F.lit(None).cast("int"), "device": F.lit(None).cast("string"), "location": F.lit("Previously unseen"),
    })
    for r in score_transactions(rows, bundle).collect():
        assert np.isfinite([r["fraud_score"], r["anomaly_score"]]).all()


def test_text_inputs_score_like_typed_ones(parts, bundle):
    rows = parts["test"].limit(10).cache()
    text = rows.withColumns({"amount": F.col("amount").cast("string"), "is_intl": F.col("is_intl").cast("string"),
                             "txn_ts": F.date_format("txn_ts", "dd-MM-yyyy HH:mm"), "category": F.concat(F.lit(" "), "category")})
    a, b = score_transactions(rows, bundle), score_transactions(text, bundle)
    assert M.score_diff(a, b, "txn_id", ["fraud_score", "anomaly_score"]).count() == 0


@pytest.mark.parametrize("column,value,reason", [
    ("amount", "-1", "bad_amount"), ("amount", "bad", "bad_amount"), ("amount", "inf", "bad_amount"), ("is_intl", "2", "flag_not_binary"),
    ("is_intl", "x", "bad_flag"), ("txn_ts", "not-a-date", "bad_date"),
])
def test_bad_rows_are_rejected(parts, bundle, column, value, reason):
    row = parts["test"].limit(1).withColumn(column, F.lit(value))
    with pytest.raises(S.InputError, match=reason):
        score_transactions(row, bundle)
    good, bad = S.quarantine(row)
    assert good.count() == 0 and bad.first()["reasons"] == [reason]


def test_missing_columns_and_empty_input(parts, bundle):
    with pytest.raises(SchemaError, match="Device_Type"):
        score_transactions(parts["test"].drop("device"), bundle)
    with pytest.raises(S.InputError, match="at least one"):
        score_transactions(parts["test"].where("false"), bundle)


def test_blank_numbers_are_allowed(parts):
    row = parts["test"].limit(1).withColumns({"amount": F.lit(""), "is_intl": F.lit(None).cast("string")})
    assert S.validate(row).first()["reasons"] == []


# ------------------------------------------------------------------ isolation forest

def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "txn_id")
    a = tree_samples(df.repartition(3), "txn_id", 10, 32, 7, 5000).toPandas()
    b = tree_samples(df.repartition(7), "txn_id", 10, 32, 7, 5000).toPandas()
    key = ["tree", "txn_id"]
    assert a.sort_values(key)[key].values.tolist() == b.sort_values(key)[key].values.tolist()
    assert (a.groupby("tree").size() == 32).all() and not a.duplicated(key).any()


def test_forest_is_reproducible(parts, scaled, forest):
    again = IsolationForest.fit(parts["train"].repartition(5), trees=25, sample_size=64, preprocess=scaled)
    assert again.nodes.equals(forest.nodes)
    roots = forest.nodes[forest.nodes.node == 0]
    assert len(roots) == 25 and (roots["size"] == 64).all() and forest.nodes.depth.max() <= 6
    leaves = forest.nodes[forest.nodes.feature < 0]
    assert (leaves.groupby("tree")["size"].sum() == 64).all()


def test_scorer_equals_a_plain_walk(forest):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 46))
    a = forest.arrays()
    got = score_matrix(x, a, chunk=7)
    for i in range(len(x)):
        depths = []
        for _, tree in forest.nodes.groupby("tree"):
            nodes = tree.set_index("node")
            at = 0
            while nodes.feature[at] >= 0:
                at = nodes.left[at] if x[i, nodes.feature[at]] <= nodes.split[at] else nodes.right[at]
            depths.append(nodes.depth[at] + float(average_path(nodes["size"][at])))
        assert got[i] == pytest.approx(2 ** (-np.mean(depths) / float(average_path(64))), rel=1e-12)


def test_planted_outliers_rank_first(parts):
    odd = parts["train"].limit(2).withColumns({"txn_id": -F.col("txn_id") - 1, "amount": F.lit(5e7), "average_spend": F.lit(1e5)})
    df = parts["train"].unionByName(odd)
    # Few columns: among 46 mostly one-hot ones two odd cells are no more unusual than a rare category.
    ready = PipelineModel([VectorAssembler(inputCols=["amount", "average_spend", "account_age_days"], outputCol="features")])
    scored = IsolationForest.fit(df, trees=100, preprocess=ready).score(df).select("txn_id", "anomaly_score")
    top = [r["txn_id"] for r in scored.orderBy(F.col("anomaly_score").desc()).limit(2).collect()]
    assert all(t < 0 for t in top)
    lo, hi = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < lo < hi < 1


def test_average_path():
    assert list(average_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.244770920, rel=1e-8)


# ----------------------------------------------------------------------- diagnostics

def test_bootstrap_equals_plain_resampling_of_the_same_draws(parts):
    test = parts["test"].select("customer_id", "label", F.col("pseudo_score").alias("score")).cache()
    weights = D.draw_weights(test.select("customer_id").distinct(), 20, 42).toPandas()
    pdf = test.toPandas()
    total = pdf.customer_id.nunique()
    per = [{r["customer_id"]: list(r["drawn"]).count(b) for _, r in weights.iterrows()} for b in range(20)]
    assert all(sum(p.values()) == total for p in per)
    got = D.repeat_metrics(test, 0.5, 20, 42, rows_per_bucket=100).toPandas().set_index("repeat")
    from test_metrics import brute

    for b in (0, 7, 19):
        times = pdf.customer_id.map(per[b]).fillna(0).astype(int)
        rows = pdf.loc[pdf.index.repeat(times)]
        for k, v in brute(rows.label, rows.score, 0.5).items():
            assert got.loc[b, k] == pytest.approx(v, rel=1e-9), k
    ci = D.grouped_bootstrap(test, 0.5, 20).toPandas().set_index("metric")
    want = np.percentile(got["roc_auc"], [2.5, 97.5])
    np.testing.assert_allclose(ci.loc["roc_auc", ["lower", "upper"]].astype(float), want, rtol=1e-12)
    assert (ci.lower <= ci.upper).all() and (ci.repeats == 20).all()


def test_hot_customer_draws_are_the_same(parts):
    test = parts["test"].select(F.when(F.col("txn_id") % 3 == 0, -1).otherwise(F.col("customer_id")).alias("customer_id"), "label", F.col("pseudo_score").alias("score"))
    rows = D.resampled(test, 5, 1).select("pos", "alerts", F.explode("drawn").alias("repeat"))
    got = rows.groupBy("repeat").agg(F.sum("alerts").alias("n"), F.sum("pos").alias("p")).orderBy("repeat").collect()
    drawn = D.draw_weights(test.select("customer_id").distinct(), 5, 1).select("customer_id", F.explode("drawn").alias("repeat"))
    plain = test.join(drawn, "customer_id").groupBy("repeat").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    assert got == plain.orderBy("repeat").collect()


def test_bootstrap_with_ties_and_small_batches(spark, parts):
    test = parts["test"].select("customer_id", "label", F.round("pseudo_score", 1).alias("score"))
    whole = D.repeat_metrics(test, 0.5, 10, 3).orderBy("repeat").collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = D.repeat_metrics(test, 0.5, 10, 3, rows_per_bucket=50).orderBy("repeat").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(whole) == 10 and [r["n"] for r in whole] == [r["n"] for r in again]
    for a, b in zip(whole, again):
        assert tuple(a) == pytest.approx(tuple(b))


def test_permutation_moves_one_column_only(parts):
    val = parts["validation"].cache()
    moved = D.permuted(val, SCORING_INPUTS, 2, 42, rows_per_bucket=30).toPandas()
    plain = val.select("txn_id", *SCORING_INPUTS).toPandas().set_index("txn_id").sort_index()
    assert len(moved) == len(plain) * len(SCORING_INPUTS) * 2
    for (feature, _), part in moved.groupby(["feature", "repeat"]):
        part = part.set_index("txn_id").sort_index()
        for c in SCORING_INPUTS:
            same = (part[c] == plain[c]).all()
            if c != feature:
                assert same, (feature, c)
        assert sorted(part[feature]) == sorted(plain[feature])
        if feature == "amount":
            assert (part[feature] != plain[feature]).mean() > 0.9


def test_features_are_shuffled_apart(spark):
    """Every (feature, repeat) draws its donors by itself: two columns with the same values end up in different orders."""
    rows = spark.range(200).select(F.col("id").alias("txn_id"), F.lit(0).alias("label"), F.col("id").alias("a"), F.col("id").alias("b"))
    moved = D.permuted(rows, ["a", "b"], 2, 42, rows_per_bucket=30).toPandas()
    orders = {tuple(part.sort_values("txn_id")[f]) for (f, _), part in moved.groupby(["feature", "repeat"])}
    assert len(orders) == 4


def test_importance_finds_the_signal(parts, lr):
    got = D.permutation_importance(lambda df: MD.score(lr, df, "score"), parts["validation"], repeats=3).toPandas()
    assert set(got.feature) == set(SCORING_INPUTS)
    assert got.feature.iloc[0] in ("method", "category", "amount")
    assert list(got.validation_ap_drop_mean) == sorted(got.validation_ap_drop_mean, reverse=True)


def test_sensitivity_rows(parts, lr):
    got = D.sensitivity(parts["train"], parts["validation"], MD.candidates()["Logistic Regression (unweighted)"], lr).toPandas()
    assert len(got) == 3 and got.validation_ap.between(0, 1).all()
