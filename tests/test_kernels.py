import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnrisk.operators import analytics as A
from txnrisk.operators import clean as CL
from txnrisk.operators import kernels as K
from txnrisk.operators import metrics as M


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(1)
    n = 4000
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b"], n, p=[0.8, 0.2]),
        # Group b lives in another score range; a third of all rows share one score.
        "score": np.round(rng.random(n), 3),
        "label": rng.integers(0, 2, n),
    })
    pdf.loc[pdf.g == "b", "score"] += 5
    pdf.loc[rng.random(n) < 1 / 3, "score"] = 0.5
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("per_bucket", [50, 10**6])
@pytest.mark.parametrize("descending", [True, False])
def test_cumulate_equals_one_big_window(scores, per_bucket, descending):
    pdf, df = scores
    bounds = K.value_bounds(df, "score", ["g"], per_bucket)
    assert (len(bounds) > 20) == (per_bucket == 50)
    out = K.cumulate(df, "score", {"pos": F.col("label"), "n": F.lit(1)}, ["g"], bounds, descending, group_limit=2).toPandas()
    want = pdf.groupby(["g", "score"]).agg(pos=("label", "sum"), n=("label", "size")).reset_index()
    want = want.sort_values(["g", "score"], ascending=[True, not descending])
    for c in ("pos", "n"):
        want[f"cum_{c}"] = want.groupby("g")[c].cumsum()
        want[f"all_{c}"] = want.groupby("g")[c].transform("sum")
        want[f"next_{c}"] = want.groupby("g")[c].shift(-1)
    out = out.sort_values(["g", "score"], ascending=[True, not descending])[want.columns]
    np.testing.assert_array_equal(out.fillna(-1).to_numpy(), want.fillna(-1).to_numpy())


def test_metrics_do_not_depend_on_buckets(scores):
    _, df = scores
    a = M.evaluate(df, 0.5, groups=["g"], rows_per_bucket=40, group_limit=2).toPandas().sort_values("g")
    b = M.evaluate(df, 0.5, groups=["g"]).toPandas().sort_values("g")
    np.testing.assert_allclose(a.drop(columns="g").to_numpy(float), b.drop(columns="g").to_numpy(float), rtol=1e-12)


def test_roc_curve_keeps_only_bends_across_buckets(scores):
    _, df = scores
    one = M.roc_curve(M.ranking(df, groups=["g"]), ["g"]).toPandas()
    many = M.roc_curve(M.ranking(df, groups=["g"], rows_per_bucket=40), ["g"]).toPandas()
    key = ["g", "x", "y"]
    np.testing.assert_array_equal(one.sort_values(key).to_numpy(), many.sort_values(key).to_numpy())


@pytest.mark.parametrize("n,limit,accuracy", [(1, 10, 100), (2, 10, 100), (999, 10**6, 1000), (30_000, 300, 500), (30_000, 10**6, 10_000)])
def test_exact_quantiles(spark, n, limit, accuracy):
    rng = np.random.default_rng(n)
    x = rng.lognormal(3, 2, n)
    y = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = K.exact_quantiles(df, {"x": (F.col("x"), ps), "y": (F.col("y"), ps), "z": (F.lit(None), [0.5])}, limit, accuracy)
    np.testing.assert_allclose(got["x"], np.quantile(x, ps), rtol=1e-13)
    np.testing.assert_allclose(got["y"], np.quantile(y, ps), rtol=1e-13)
    assert got["z"] == [None]


def test_times_at_equals_full_sort(spark):
    rng = np.random.default_rng(5)
    base = dt.datetime(2024, 2, 28, 23, 59, 59)
    # Half of the rows fall within one second, at microsecond grain.
    ts = [base + dt.timedelta(microseconds=int(m)) for m in rng.integers(0, 900_000, 400)]
    ts += [base + dt.timedelta(minutes=int(m)) for m in rng.integers(-9000, 9000, 400)]
    df = spark.createDataFrame(pd.DataFrame({"t": ts})).select(F.col("t").cast("timestamp_ntz").alias("t"))
    n, got = K.times_at(df, "t", [0.0, 0.3, 0.6, 0.8, 0.999])
    assert n == 800
    assert got == [sorted(ts)[int(n * f)] for f in [0.0, 0.3, 0.6, 0.8, 0.999]]


@pytest.mark.parametrize("per_bucket", [7, 10**6])
def test_dense_index_is_a_numbering(spark, per_bucket):
    df = spark.range(300).withColumn("g", F.col("id") % 3)
    out = K.dense_index(df, F.xxhash64("id", F.lit(3)), ["id"], ["g"], rows=100, rows_per_bucket=per_bucket).toPandas()
    for _, part in out.groupby("g"):
        assert sorted(part["idx"]) == list(range(100))
        assert list(part.sort_values("idx")["id"]) != list(range(len(part)))
    other = K.dense_index(df.repartition(5), F.xxhash64("id", F.lit(3)), ["id"], ["g"], rows=100).toPandas()
    merged = out.merge(other, on="id")
    assert (merged.idx_x == merged.idx_y).all()


@pytest.mark.parametrize("how", [{}, {"heavy_rows": 15}, {"heavy_rows": 0}, {"rows": 30}])
def test_lookup_treats_heavy_keys_apart(spark, how):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert K.heavy_keys(left, "k", 15)[0] == 0 and None not in K.heavy_keys(left, "k", 0)
    got = K.lookup(left, right, "k", ["v"], **how).toPandas().set_index("id")["v"].sort_index()
    want = left.join(right, "k", "left").toPandas().set_index("id")["v"].sort_index()
    pd.testing.assert_series_equal(got, want, check_dtype=False)


def test_quantile_fetch_is_bounded_by_the_limit(spark, monkeypatch):
    """Half zeros, half ones and a little in between: neither rows nor ties may carry more than the limit to the driver."""
    rng = np.random.default_rng(4)
    x = np.concatenate([np.zeros(14_850), np.ones(14_850), rng.random(300), -rng.lognormal(0, 20, 50)])
    fetched, plain = [], K._fetch
    monkeypatch.setattr(K, "_fetch", lambda hits: fetched.append(rows := plain(hits)) or rows)
    ps = [0.001, 0.25, 0.495, 0.5, 0.504, 0.75, 1.0]
    got = K.exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": x})), {"x": (F.col("x"), ps)}, collect_limit=50)
    np.testing.assert_allclose(got["x"], np.quantile(x, ps), rtol=1e-13)
    assert all(len([r for r in rows if r["task"] == task]) <= 50 for rows in fetched for task in {r["task"] for r in rows})


def test_many_ranges_come_from_two_levels(spark, monkeypatch):
    monkeypatch.setattr(K, "SKETCH_BUCKETS", 10)
    bounds = K.value_bounds(spark.range(5000).withColumn("v", F.col("id").cast("double")), "v", rows_per_bucket=50)
    assert len(bounds) > 80 and max(np.diff([0, *bounds, 5000])) < 200


@pytest.mark.parametrize("query", ["metric_record", "pr_curve", "spearman", "threshold_sweep", "model_comparison"])
def test_no_single_task_over_rows(spark, sf, query):
    """Windows run inside ranges of values; only those over cells (one row per range) span them."""
    from txnrisk.plans.registry import QUERIES

    plan = QUERIES[query](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(" in line]
    assert any("(_bucket#" in line for line in windows)
    assert all("_cell_" in line or "normalizenanandzero(_bucket#" in line for line in windows), windows


@pytest.mark.parametrize("per_bucket", [20, 10**6])
def test_history_decreases_across_ranges(spark, per_bucket):
    rng = np.random.default_rng(9)
    n = 600
    pdf = pd.DataFrame({
        "txn_id": np.arange(n), "customer_id": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 20, n)),
        "txn_ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 500, n), unit="h"),
        "account_age_days": rng.integers(0, 9, n).astype(float), "previous_txns": rng.integers(0, 9, n).astype(float),
    })
    pdf.loc[rng.random(n) < 0.1, "previous_txns"] = np.nan
    df = spark.createDataFrame(pdf).withColumns({
        "txn_ts": F.col("txn_ts").cast("timestamp_ntz"), "previous_txns": F.expr("nanvl(previous_txns, null)"),
    })
    got = CL.history_decreases(df, per_bucket).first()
    by = pdf.sort_values(["txn_ts", "txn_id"]).groupby("customer_id")
    assert got["account_age_decreases"] == by["account_age_days"].diff().lt(0).sum()
    assert got["previous_txns_decreases"] == by["previous_txns"].diff().lt(0).sum()


@pytest.mark.parametrize("per_bucket", [25, 10**6])
def test_spearman_against_pandas(spark, per_bucket):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": np.round(rng.random(500), 2), "b": rng.integers(0, 2, 500)})
    pdf["c"] = (pdf.a + rng.random(500) > 1).astype(int)
    got = A.spearman(spark.createDataFrame(pdf), ["a", "b", "c"], per_bucket).toPandas().pivot(index="a", columns="b", values="rho")
    np.testing.assert_allclose(got.to_numpy(), pdf.corr("spearman").to_numpy(), atol=1e-12)
