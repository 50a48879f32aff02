"""Learned preprocessing: imputation, scaling and one-hot encoding fitted on the training part.

Fitting yields a ``PipelineModel`` made only of built-in JVM stages, unless a category column has more values than
a stage should list (see ``categories``).  Learned numbers are literals in SQL text, so a saved model needs no Python
code to be loaded and every transform is a plain projection.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import features as FT
from txnrisk.operators import kernels as K
from txnrisk.operators.categories import CategoryIndex, many_valued
from txnrisk.sources.schema import check_inputs

UNKNOWN = "Unknown"  # fixed value: stands for a missing category


def fitted_variants(df: DataFrame, scales: list[bool]) -> dict[bool, PipelineModel]:
    """``Preprocess(scale)`` fitted for every wanted ``scale``: statistics and categories do not depend on it and are learned once."""
    out: dict[bool, PipelineModel] = {}
    stats = Preprocess().statistics(df) if scales else {}
    for scale in scales:
        out[scale] = Preprocess(scale).assembled(df, stats, next(iter(out.values()), None))
    return out


def number_sql(x: float) -> str:
    return f"{float(x)!r}D"


class Preprocess(Estimator):
    """Features -> median imputation (+ missing indicators) -> optional scaling -> one-hot -> vector."""

    def __init__(self, scale: bool = False, include_history: bool = False, include_keyword: bool = False, output: str = "features"):
        super().__init__()
        self.scale, self.include_history, self.include_keyword, self.output = scale, include_history, include_keyword, output

    def inputs(self) -> list[str]:
        return ["txn_ts", *FT.numeric_inputs(self.include_history), *FT.categorical_features(self.include_keyword)]

    def statistics(self, df: DataFrame) -> dict[str, dict]:
        """Median, null count, mean and population deviation of every numeric feature of ``df``."""
        check_inputs(df.columns, self.inputs())
        names = FT.numeric_features(self.include_history)
        feats = self._features().transform(df.select(*self.inputs()))
        # Exact medians: MLlib's imputer returns a data point, never the midpoint of two.
        medians = K.exact_quantiles(feats, {n: (F.col(FT.PREFIX + n), [0.5]) for n in names})
        fill = {n: medians[n][0] if medians[n][0] is not None else 0.0 for n in names}
        aggs = [F.count(F.lit(1)).alias("n")]
        for n in names:
            c = F.col(FT.PREFIX + n)
            full = F.coalesce(c, F.lit(fill[n]))
            aggs += [F.count_if(c.isNull()).alias(f"{n}__nulls"), F.avg(full).alias(f"{n}__mean"), F.stddev_pop(full).alias(f"{n}__std")]
        row = feats.agg(*aggs).first()
        return {
            n: {"median": fill[n], "nulls": row[f"{n}__nulls"], "rows": row["n"], "mean": row[f"{n}__mean"], "std": row[f"{n}__std"]}
            for n in names
        }

    def _features(self) -> SQLTransformer:
        return SQLTransformer(statement=FT.feature_select(self.include_history, self.include_keyword))

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.assembled(df, self.statistics(df))

    def assembled(self, df: DataFrame, stats: dict[str, dict], like: PipelineModel | None = None) -> PipelineModel:
        """The stages from known statistics; the category stages are those of ``like``, a fit of the same inputs, if given."""
        cats = FT.categorical_features(self.include_keyword)
        select, vector = [], []
        for n, s in stats.items():
            value = f"coalesce({FT.PREFIX}{n}, {number_sql(s['median'])})"
            select.append(f"{self._scaled(value, s['mean'], s['std'])} AS p_{n}")
            vector.append(f"p_{n}")
        for n, s in stats.items():
            if s["nulls"]:  # an indicator only where the training part had gaps
                share = s["nulls"] / s["rows"]
                gap = f"if({FT.PREFIX}{n} IS NULL, 1D, 0D)"
                select.append(f"{self._scaled(gap, share, math.sqrt(share * (1 - share)))} AS m_{n}")
                vector.append(f"m_{n}")
        select += [f"coalesce({FT.PREFIX}{c}, '{UNKNOWN}') AS c_{c}" for c in cats]
        features = self._features()
        filled = SQLTransformer(statement=f"SELECT *, {', '.join(select)} FROM __THIS__")
        join = VectorAssembler(inputCols=vector + [f"o_{c}" for c in cats], outputCol=self.output)
        if like is not None:
            return PipelineModel([features, filled, *like.stages[2:-1], join])
        ready = filled.transform(features.transform(df.select(*self.inputs())))
        # Columns with very many values are numbered by a stored dictionary instead of a list in the stage.
        many = many_valued(ready, [f"c_{c}" for c in cats])
        listed = [c for c in cats if f"c_{c}" not in many]
        stages = [features, filled]
        if listed:
            # The extra "unseen" index is the one dropped, so an unseen category is all zeros.
            index = StringIndexer(
                inputCols=[f"c_{c}" for c in listed], outputCols=[f"i_{c}" for c in listed],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ).fit(ready)
            hot = OneHotEncoder(inputCols=[f"i_{c}" for c in listed], outputCols=[f"o_{c}" for c in listed], dropLast=True).fit(index.transform(ready))
            stages += [index, hot]
        if many:
            index = CategoryIndex.fit(ready, {c: f"i_{c[2:]}" for c in many})
            hot = OneHotEncoder(inputCols=[f"i_{c[2:]}" for c in many], outputCols=[f"o_{c[2:]}" for c in many], dropLast=True, handleInvalid="keep").fit(index.transform(ready))
            stages += [index, hot]
        return PipelineModel([*stages, join])

    def _scaled(self, value: str, mean: float, std: float) -> str:
        if not self.scale:
            return value
        # Zero variance: centred only.  Population deviation, unlike MLlib's scaler.
        return f"({value} - {number_sql(mean)}) / {number_sql(std if std else 1.0)}"

