"""Ranking and threshold metrics from (label, score) rows.

Everything derives from one cumulative table per group with a row per distinct
score (``ranking``).  Equal scores share a row, so ties are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.coerce import safe_ratio
from txnrisk.operators import kernels as K

FLOOR = 1e-12  # fixed value: smallest precision + recall used as an F1 denominator
INTERVAL_METRICS = ["precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc"]


def ranking(
    df: DataFrame, score: str = "score", label: str = "label", groups: list[str] | None = None,
    weight: str | None = None, bounds: list[float] | None = None, rows_per_bucket: int = K.ROWS_PER_BUCKET,
    group_limit: int | None = None, rows: int | None = None,
) -> DataFrame:
    """Per (group, distinct score), best score first: ``pos``, ``alerts`` and their running sums.

    ``cum_pos`` and ``cum_alerts`` are the true positives and alerts of the threshold
    "score or higher"; ``all_pos`` and ``all_alerts`` are the group's totals.  ``rows`` is an
    upper bound on a group's size, if one is known; it saves a counting pass.
    """
    w = F.col(weight) if weight else F.lit(1)
    df = df.where(F.col(score).isNotNull())
    if bounds is None:
        bounds = K.value_bounds(df, score, groups, rows_per_bucket, rows)
    measures = {"pos": (F.col(label) * w).cast("bigint"), "alerts": w.cast("bigint")}
    return K.cumulate(df, score, measures, groups, bounds, group_limit=group_limit)


def _tp() -> Column:
    return F.col("cum_pos").cast("double")


def _precision() -> Column:
    return _tp() / F.col("cum_alerts")


def metrics(ranked: DataFrame, threshold: Column, score: str = "score", groups: list[str] | None = None) -> DataFrame:
    """The sixteen-number metric record of each group.

    ``threshold`` is a literal or a column constant within each group.
    """
    groups = list(groups or [])
    flagged = F.col(score) >= F.col("_t")
    neg = F.col("alerts") - F.col("pos")
    prev_alerts, prev_pos = F.col("cum_alerts") - F.col("alerts"), F.col("cum_pos") - F.col("pos")
    # The curve starts at recall 0 with precision 1.
    prev_precision = F.when(prev_alerts > 0, prev_pos.cast("double") / F.nullif(prev_alerts, F.lit(0))).otherwise(1.0)
    sums = ranked.withColumn("_t", threshold).groupBy(*groups).agg(
        F.sum("alerts").alias("n"),
        F.sum("pos").alias("positives"),
        F.max("_t").alias("threshold"),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("alerts"))), F.lit(0)).alias("alert_count"),
        # True positives ranked above each negative, ties counted half.
        F.sum(neg.cast("double") * (_tp() - F.col("pos") / F.lit(2.0))).alias("_auc"),
        F.sum(F.col("pos") * _precision()).alias("_ap"),
        F.sum(F.col("pos") * (_precision() + prev_precision) / F.lit(2.0)).alias("_area"),
    )
    return record(sums, groups)


def record(sums: DataFrame, groups: list[str]) -> DataFrame:
    """The metric record from each group's totals and sums over its curve."""
    n, p, tp, alerts = (F.col(c) for c in ("n", "positives", "tp", "alert_count"))
    both = (p > 0) & (p < n)
    counts = sums.select(
        "*",
        (alerts - tp).alias("fp"),
        (p - tp).alias("fn"),
        (n - p - alerts + tp).alias("tn"),
        F.coalesce(safe_ratio(tp, alerts), F.lit(0.0)).alias("precision"),
        F.coalesce(safe_ratio(tp, p), F.lit(0.0)).alias("recall"),
    )
    return counts.select(
        *groups,
        "n",
        "positives",
        safe_ratio(p, n).alias("prevalence"),
        "threshold",
        "precision",
        "recall",
        F.coalesce(safe_ratio(2 * tp, alerts + p), F.lit(0.0)).alias("f1"),
        F.when(both, F.col("_auc") / F.nullif(p.cast("double") * (n - p), F.lit(0.0))).alias("roc_auc"),
        F.when(both, F.col("_ap") / F.nullif(p.cast("double"), F.lit(0.0))).alias("average_precision"),
        F.when(both, F.col("_area") / F.nullif(p.cast("double"), F.lit(0.0))).alias("pr_auc"),
        "tn", "fp", "fn", "tp", "alert_count",
        safe_ratio(alerts, n).alias("alert_rate"),
    )


def evaluate(
    df: DataFrame, threshold: Column | float, score: str = "score", label: str = "label",
    groups: list[str] | None = None, **kw,
) -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return metrics(ranking(df, score, label, groups, **kw), t, score, groups)


def at_threshold(df: DataFrame, threshold: float, score: str = "score", label: str = "label", groups: list[str] | None = None) -> DataFrame:
    """Counts and rates at one threshold: a single aggregate, no ranking."""
    y, flagged = F.col(label) == 1, F.col(score) >= F.lit(float(threshold))
    c = df.groupBy(*(groups or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y).alias("positives"),
        F.count_if(flagged).alias("alert_count"),
        F.count_if(y & flagged).alias("tp"),
        F.count_if(~y & flagged).alias("fp"),
        F.count_if(y & ~flagged).alias("fn"),
        F.count_if(~y & ~flagged).alias("tn"),
    )
    zero = F.lit(0.0)
    return c.select(
        "*",
        safe_ratio(F.col("positives"), F.col("n")).alias("prevalence"),
        safe_ratio(F.col("alert_count"), F.col("n")).alias("alert_rate"),
        F.coalesce(safe_ratio(F.col("tp"), F.col("alert_count")), zero).alias("precision"),
        F.coalesce(safe_ratio(F.col("tp"), F.col("positives")), zero).alias("recall"),
        F.coalesce(safe_ratio(2 * F.col("tp"), F.col("alert_count") + F.col("positives")), zero).alias("f1"),
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """The four counts as a 2 x 2 table."""
    return counts.selectExpr(
        "stack(2, 'Legitimate', tn, fp, 'Fraudulent', fn, tp) as (actual, predicted_legitimate, predicted_review)"
    )


def sweep(ranked: DataFrame, score: str = "score", groups: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 at every distinct score used as threshold."""
    p = _precision()
    r = _tp() / F.nullif(F.col("all_pos").cast("double"), F.lit(0.0))
    t = ranked.select(*(groups or []), F.col(score).alias("threshold"), p.alias("precision"), r.alias("recall"))
    total = F.col("precision") + F.col("recall")
    return t.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(total, F.lit(FLOOR)))


def choose(swept: DataFrame) -> DataFrame:
    """The threshold with the highest F1; ties prefer recall, precision, then the higher threshold."""
    return swept.orderBy(*[F.col(c).desc_nulls_last() for c in ("f1", "recall", "precision", "threshold")]).limit(1)


def choose_per_group(swept: DataFrame, groups: list[str]) -> DataFrame:
    """``choose`` for every group at once, as an aggregate."""
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", "recall", "precision", "threshold"))
    return swept.groupBy(*groups).agg(best.alias("_b")).select(*groups, "_b.*")


def pr_curve(ranked: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Points (x = recall, y = precision) of every threshold, and the end point (0, 1)."""
    groups = list(groups or [])
    pos = F.nullif(F.col("all_pos").cast("double"), F.lit(0.0))
    point = F.struct((_tp() / pos).alias("x"), _precision().alias("y"))
    # The last running row is the group's single complete one, so it carries the end point along.
    last = F.col("cum_alerts") == F.col("all_alerts")
    return _with_ends(ranked, groups, point, last, (0.0, 1.0))


def _with_ends(rows: DataFrame, groups: list[str], point: Column, last: Column, end: tuple[float, float]) -> DataFrame:
    """A point per row, and one more for the row that is ``last``: one read of ``rows``."""
    extra = F.struct(F.lit(end[0]).alias("x"), F.lit(end[1]).alias("y"))
    return rows.select(*groups, F.explode(F.when(last, F.array(point, extra)).otherwise(F.array(point))).alias("p")).select(*groups, "p.x", "p.y")


def roc_curve(ranked: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """ROC points from the origin on; inner points on a straight line are left out."""
    groups = list(groups or [])
    fp, neg = F.col("cum_alerts") - F.col("cum_pos"), F.col("alerts") - F.col("pos")
    next_neg = F.col("next_alerts") - F.col("next_pos")
    first = F.col("cum_alerts") == F.col("alerts")
    last = F.col("next_alerts").isNull()
    bends = (F.col("next_pos") != F.col("pos")) | (next_neg != neg)
    all_neg = F.nullif((F.col("all_alerts") - F.col("all_pos")).cast("double"), F.lit(0.0))
    all_pos = F.nullif(F.col("all_pos").cast("double"), F.lit(0.0))
    kept = ranked.where(first | last | bends)
    point = F.struct((fp / all_neg).alias("x"), (_tp() / all_pos).alias("y"))
    return _with_ends(kept, groups, point, last, (0.0, 0.0))


def curves(ranked: DataFrame, groups: list[str]) -> DataFrame:
    """Both curves in long form: groups, curve, x, y."""
    return (
        roc_curve(ranked, groups).withColumn("curve", F.lit("ROC"))
        .unionByName(pr_curve(ranked, groups).withColumn("curve", F.lit("PR")))
        .select(*groups, "curve", "x", "y")
    )


def compare(
    scores: DataFrame, baseline_threshold: float = 0.5, fixed: dict[str, float] | None = None, models: int = 16,
    rows_per_bucket: int = K.ROWS_PER_BUCKET, rows: int | None = None,
) -> DataFrame:
    """Comparison table of every (model, split) from one long score table.

    Input columns: model, kind, split, label, score.  Supervised models use the
    threshold chosen on validation; ``fixed`` gives others (the anomaly cutoff),
    baselines use ``baseline_threshold``.
    """
    groups = ["model", "kind", "split"]
    limit = models * 2
    ranked = ranking(scores, groups=groups, rows_per_bucket=rows_per_bucket, group_limit=limit, rows=rows)
    tuned = choose_per_group(
        sweep(ranked.where((F.col("split") == "validation") & (F.col("kind") == "supervised")), groups=["model"]), ["model"]
    ).select("model", F.col("threshold").alias("_tuned"))
    other = F.when(F.col("kind") == "baseline", F.lit(float(baseline_threshold)))
    for model, t in (fixed or {}).items():
        other = other.when(F.col("model") == model, F.lit(float(t)))
    with_t = ranked.join(K.small(tuned, models), "model", "left")
    table = metrics(with_t, F.coalesce("_tuned", other), groups=groups)
    # A handful of rows from here on, so plain windows are fine.
    place = F.row_number().over(
        Window.partitionBy("kind", "split").orderBy(F.col("average_precision").desc_nulls_last(), "model")
    )
    best = (F.col("kind") == "supervised") & (F.col("split") == "validation") & (place == 1)
    return table.withColumn("_best", best).select(
        *table.columns, F.max("_best").over(Window.partitionBy("model")).alias("selected")
    )


def select_model(table: DataFrame) -> DataFrame:
    """Best supervised validation row by average precision; the name breaks ties."""
    rows = table.where((F.col("split") == "validation") & (F.col("kind") == "supervised"))
    return rows.orderBy(F.col("average_precision").desc_nulls_last(), F.col("model").asc()).limit(1)


def wide_scores(scores: DataFrame, models: list[str], keys: list[str]) -> DataFrame:
    """One row per transaction with a column per model."""
    return scores.groupBy(*keys).pivot("model", models).agg(F.first("score"))


def score_diff(a: DataFrame, b: DataFrame, key: str, cols: list[str], tol: float = 1e-12) -> DataFrame:
    """Rows that are missing on one side or differ by more than ``tol``; empty means equal."""
    left = a.select(key, *[F.col(c).cast("double").alias(f"a_{c}") for c in cols], F.lit(1).alias("_a"))
    right = b.select(key, *[F.col(c).cast("double").alias(f"b_{c}") for c in cols], F.lit(1).alias("_b"))
    both = left.join(right, key, "full_outer")
    differs = F.col("_a").isNull() | F.col("_b").isNull()
    for c in cols:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        differs = differs | (F.abs(x - y) > tol) | (x.isNull() != y.isNull())
    return both.where(differs).select(
        key,
        F.when(F.col("_a").isNull(), "missing left").when(F.col("_b").isNull(), "missing right").otherwise("differs").alias("reason"),
        *[f"{s}_{c}" for c in cols for s in ("a", "b")],
    )


def metric_diff(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str], tol: float = 1e-12) -> DataFrame:
    """``score_diff`` for metric tables with a compound key."""
    key = F.to_json(F.struct(*keys)).alias("key")
    return score_diff(a.select(key, *cols), b.select(key, *cols), "key", cols, tol)
