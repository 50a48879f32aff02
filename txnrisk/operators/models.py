"""Supervised candidates, class weights and model fitting on MLlib."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators.boosting import HistogramBoosting
from txnrisk.operators.forest import KEY, HistogramForest, row_key, scored
from txnrisk.operators.preprocess import Preprocess
from txnrisk.session import shared_folder, stage, working_path

SEED = 42
WEIGHT = "_weight"
ROWS_PER_PARTITION = 1_000_000
SMALL_PARTITION = 20_000  # up to 256 partitions; larger tables fill them to ROWS_PER_PARTITION


def logistic(rows: int) -> Estimator:
    # L2 penalty of strength 1 on the summed loss; MLlib averages the loss over rows.
    return LogisticRegression(
        regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, maxIter=2000, tol=1e-10
    )


# MLlib's classification trees merge sibling leaves that vote for the same class, which
# erases the leaf probabilities of a rare class.  Regression trees on the 0/1 label split
# identically (variance is half the Gini impurity) and keep each leaf's positive share.

def tree(rows: int) -> Estimator:
    return DecisionTreeRegressor(maxDepth=5, minInstancesPerNode=25, maxBins=255, impurity="variance", seed=SEED)


def forest(rows: int) -> HistogramForest:
    return HistogramForest(trees=250, depth=10, min_rows=8, seed=SEED)


def boosting(rows: int) -> HistogramBoosting:
    return HistogramBoosting(max_iter=160, step=0.06, max_leaves=15, min_rows=25, l2=2.0)


@dataclass(frozen=True)
class Candidate:
    """One model family with its preprocessing and weighting."""

    family: Callable[[int], Estimator]
    scale: bool = False
    balanced: bool = False


FAMILIES = {
    # The model names are part of the result tables.
    "Logistic Regression": (logistic, True),
    "Decision Tree": (tree, False),
    "Random Forest": (forest, False),
    "Histogram Gradient Boosting": (boosting, False),
}


def candidates() -> dict[str, Candidate]:
    """Every family, unweighted and with balanced class weights."""
    return {
        f"{name} ({'balanced' if balanced else 'unweighted'})": Candidate(family, scale, balanced)
        for balanced in (False, True)
        for name, (family, scale) in FAMILIES.items()
    }


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Per class: rows and the weight n / (2 * rows of the class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = train.count()
    return counts.withColumn("weight", F.lit(float(total)) / (2 * F.col("n")))


def weight_column(train: DataFrame, label: str = "label") -> Column:
    """The class weights as a literal expression (two values, no join)."""
    out = F.lit(1.0)
    for r in class_weights(train, label).collect():
        out = F.when(F.col(label) == r[label], r["weight"]).otherwise(out)
    return out


def feature_table(train: DataFrame, ready: PipelineModel, label: str = "label") -> DataFrame:
    """Feature vectors, labels and row keys, as the estimators take them."""
    return ready.transform(train).select("features", F.col(label).cast("double").alias("label"), row_key(train).alias(KEY))


def fit_on(
    table: DataFrame, rows: int, ready: PipelineModel, family: Callable[[int], Estimator] | Estimator, weight: Column | None = None,
) -> PipelineModel:
    """Fit an estimator on a ``feature_table`` of ``rows`` rows; ``weight`` is an expression of ``label``."""
    spark = table.sparkSession
    _use_checkpoints(spark)
    estimator = (family if hasattr(family, "fit") else family(rows)).copy()
    estimator.setFeaturesCol("features").setLabelCol("label")
    if weight is not None and isinstance(estimator, HistogramForest):
        estimator.balanced = True  # within each tree's sample
    elif weight is not None:
        table = table.withColumn(WEIGHT, weight)
        estimator.setWeightCol(WEIGHT)
    if not binned(estimator):
        table = table.repartition(_partitions(rows))
    return PipelineModel([*ready.stages, _without_summary(estimator.fit(table), spark)])


def fit_estimator(
    train: DataFrame, family: Callable[[int], Estimator] | Estimator, preprocess: Preprocess | PipelineModel,
    balanced: bool = False, label: str = "label",
) -> PipelineModel:
    """Fit preprocessing (unless given fitted) and estimator on ``train`` only."""
    ready = preprocess if isinstance(preprocess, PipelineModel) else preprocess.fit(train)
    weight = weight_column(train.select(F.col(label).alias("label"))) if balanced else None
    rows = train.count()
    estimator = family if hasattr(family, "fit") else family(rows)
    table = feature_table(train, ready, label)
    return fit_on(stage(table, "features") if binned(estimator) else table, rows, ready, estimator, weight)


def binned(estimator: Estimator) -> bool:
    """Whether the estimator makes a table of its own, which does not depend on partitions, from a few passes."""
    return isinstance(estimator, (HistogramBoosting, HistogramForest))


def _without_summary(model, spark: SparkSession):
    """A training summary would ship its table's plan and session with every scoring task; storing drops it."""
    if not getattr(model, "hasSummary", False):
        return model
    path = working_path(spark, "model")
    model.write().overwrite().save(path)
    return type(model).load(path)


def _partitions(rows: int) -> int:
    """Solvers pass over the training table many times, so one shuffle evens it out first.

    The number depends on the rows alone: forests draw their samples per partition, and a model must not change with
    the cluster.
    """
    return max(1, min(-(-rows // SMALL_PARTITION), max(256, -(-rows // ROWS_PER_PARTITION))))


def fit_candidate(train: DataFrame, candidate: Candidate, include_history: bool = False, include_keyword: bool = False) -> PipelineModel:
    pre = Preprocess(candidate.scale, include_history, include_keyword)
    return fit_estimator(train, candidate.family, pre, candidate.balanced)


def score(model: PipelineModel, df: DataFrame, name: str = "fraud_score") -> DataFrame:
    """All columns of ``df`` plus the probability of the positive class."""
    if hasattr(model.stages[-1], "tables"):  # a forest's trees are large: all rows of a batch pass one tree before the next
        out = PipelineModel(model.stages[:-1]).transform(df)
        return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], scored(out, model.stages[-1].tables).alias(name))
    out = model.transform(df)
    positive = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], positive.alias(name))


def score_wide(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``df`` with one probability column per model, in one narrow pass.

    Models that share their fitted preprocessing share the feature vector too.
    """
    families: dict[int, list[str]] = {}
    for name, model in models.items():
        families.setdefault(id(model.stages[0]), []).append(name)
    out = df
    for names in families.values():
        keep = out.columns
        out = PipelineModel(models[names[0]].stages[:-1]).transform(out).select(*[F.col(f"`{c}`") for c in keep], "features")
        for name in names:
            out = score(PipelineModel(models[name].stages[-1:]), out, name)
        out = out.drop("features")
    return out


def _use_checkpoints(spark: SparkSession) -> None:
    """Boosting cuts its lineage every few rounds once a shared folder is set."""
    folder = f"{shared_folder(spark)}/txnrisk/checkpoints"
    if folder not in (spark.sparkContext.getCheckpointDir() or ""):
        spark.sparkContext.setCheckpointDir(folder)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; load only folders you trust."""
    return PipelineModel.load(path)
