"""Uncertainty and validation-only diagnostics of a frozen model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.operators import kernels as K
from txnrisk.operators import metrics as M
from txnrisk.operators import models as MD
from txnrisk.session import stage
from txnrisk.sources.schema import SCORING_INPUTS

# Stored with the intervals.
METHOD = "percentile intervals over resampled customers; scores and model are held fixed, so the spread of fitting and choosing is not in them"


def _order(purpose: str, *cols: Column) -> Column:
    """Random order key; shifted up so that the hash fills all 64 bits, as even buckets need."""
    return F.shiftleft(K.portable_hash(F.lit(purpose), *cols), 4)


def draw_weights(customers: DataFrame, repeats: int, seed: int) -> DataFrame:
    """Per customer the repeats of a resample with replacement that drew it, as often as they did.

    Every repeat draws as many customers as there are.  Draws are hashes of (repeat,
    draw), so a recomputed task draws the same customers again.
    """
    spark = customers.sparkSession
    total = customers.count()
    numbered = K.dense_index(customers, _order("customer", F.col("customer_id"), F.lit(seed)), ["customer_id"], rows=total)
    draws = spark.range(repeats * total).select(
        (F.col("id") % repeats).cast("smallint").alias("repeat"), F.floor(F.col("id") / repeats).alias("draw")
    )
    hit = F.pmod(K.portable_hash(F.lit("draw"), F.col("repeat"), F.col("draw"), F.lit(seed)), F.lit(total))
    # A customer is drawn about `repeats` times in all.
    per_customer = draws.groupBy(hit.alias("idx")).agg(F.collect_list("repeat").alias("drawn"))
    return numbered.join(per_customer, "idx").select("customer_id", "drawn")


def resampled(test: DataFrame, repeats: int = 400, seed: int = 42) -> DataFrame:
    """(score, pos, alerts, drawn): rows of one customer and score, and the repeats that hold them."""
    folded = test.groupBy("customer_id", "score").agg(
        F.sum("label").cast("bigint").alias("pos"), F.count(F.lit(1)).alias("alerts")
    )
    weights = draw_weights(test.select("customer_id").distinct(), repeats, seed)
    return K.lookup(folded, weights, "customer_id", ["drawn"]).where("drawn is not null").drop("customer_id")


def _times(drawn: pa.Array, repeats: int) -> np.ndarray:
    """Matrix (row, repeat): how often each repeat drew each row."""
    sizes = pc.list_value_length(drawn).to_numpy(zero_copy_only=False)
    cell = np.repeat(np.arange(len(sizes)) * repeats, sizes) + drawn.flatten().to_numpy(zero_copy_only=False)
    return np.bincount(cell, minlength=len(sizes) * repeats).reshape(len(sizes), repeats)


def _numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b[name].to_numpy(zero_copy_only=False)


def _bucket_totals_task(repeats: int):
    """Task over ``resampled`` rows with their bucket: each bucket's positives and rows per repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[float, np.ndarray] = {}

        def settled() -> Iterator[pa.RecordBatch]:
            for k, sums in total.items():
                columns = [np.full(repeats, k), np.arange(repeats, dtype=np.int32), *sums.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["_bucket", "repeat", "pos", "alerts"])
            total.clear()

        for b in batches:
            for at in range(0, b.num_rows, 4096):
                piece = b.slice(at, 4096)
                buckets = _numbers(piece, "_bucket")
                order = np.argsort(buckets, kind="stable")
                times, buckets = _times(piece["drawn"], repeats)[order], buckets[order]
                first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
                sums = [np.add.reduceat(times * _numbers(piece, c)[order][:, None], first, axis=0) for c in ("pos", "alerts")]
                for k, pos, alerts in zip(buckets[first].tolist(), *sums):
                    total[k] = total.get(k, 0) + np.stack([pos, alerts])
            if len(total) > 1000:  # sums of sums are the same
                yield from settled()
        yield from settled()
    return run


_SUMS = ["n", "positives", "tp", "alert_count", "_auc", "_ap", "_area"]
_SUMS_DDL = "repeat int, n long, positives long, tp long, alert_count long, _auc double, _ap double, _area double"


def _curve_task(repeats: int, threshold: float):
    """Task over rows by bucket and descending score, every bucket led by its start values: each repeat's sums along its curve.

    All repeats move along one curve: running sums are one array, and a row of the matrix is one score.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), repeats))
        start = np.zeros((2, repeats))          # positives and rows of better scores
        held = None                             # (score, sums) of the last score, which the next batch may go on with

        def settle(scores: np.ndarray, sums: np.ndarray) -> None:
            """Add distinct scores (best first) with their (pos, alerts) per repeat."""
            nonlocal start
            pos, alerts = sums[:, 0].astype(float), sums[:, 1].astype(float)
            cum_pos, cum_alerts = start[0] + np.cumsum(pos, axis=0), start[1] + np.cumsum(alerts, axis=0)
            with np.errstate(divide="ignore", invalid="ignore"):
                precision = np.where(cum_alerts > 0, cum_pos / cum_alerts, 0.0)
                before = np.where(cum_alerts - alerts > 0, (cum_pos - pos) / (cum_alerts - alerts), 1.0)
            flagged = scores >= threshold
            parts = (alerts, pos, pos[flagged], alerts[flagged], (alerts - pos) * (cum_pos - pos / 2), pos * precision, pos * (precision + before) / 2)
            for k, x in enumerate(parts):
                total[k] += x.sum(axis=0)
            start = np.stack([cum_pos[-1], cum_alerts[-1]])

        for b in batches:
            lead, buckets = _numbers(b, "lead"), _numbers(b, "_bucket")
            edges = np.flatnonzero(np.concatenate([[True], (buckets[1:] != buckets[:-1]) | (lead[1:] != lead[:-1])]))
            for a, z in zip(edges.tolist(), [*edges[1:].tolist(), b.num_rows]):
                part = b.slice(a, z - a)
                if not lead[a]:
                    if held:
                        settle(held[0], held[1])
                    held, start = None, np.stack([part[c].flatten().to_numpy(zero_copy_only=False).astype(float) for c in ("start_pos", "start_alerts")])
                    continue
                for at in range(0, part.num_rows, 4096):
                    piece = part.slice(at, 4096)
                    times, score = _times(piece["drawn"], repeats), _numbers(piece, "score")
                    both = np.stack([times * _numbers(piece, c)[:, None] for c in ("pos", "alerts")], axis=1)
                    if held:
                        score, both = np.concatenate([held[0], score]), np.concatenate([held[1], both])
                    first = np.flatnonzero(np.concatenate([[True], score[1:] != score[:-1]]))
                    score, both = score[first], np.add.reduceat(both, first, axis=0)
                    if len(score) > 1:
                        settle(score[:-1], both[:-1])
                    held = (score[-1:], both[-1:])
        if held:
            settle(held[0], held[1])
        columns = [np.arange(repeats, dtype=np.int32), *(x.astype(np.int64) for x in total[:4]), *total[4:]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["repeat", *_SUMS])
    return run


def repeat_metrics(test: DataFrame, threshold: float, repeats: int = 400, seed: int = 42, rows_per_bucket: int = K.ROWS_PER_BUCKET) -> DataFrame:
    """The metric record of every resample; repeats with one class are left out.

    A row travels once, with the list of repeats that drew it.  Score ranges start from a table of their totals; inside a range,
    rows stream by in score order, so no task holds more than a few thousand of them as a matrix.
    """
    # Every repeat has the test scores' distribution: one set of boundaries serves all.
    bounds = K.value_bounds(test, "score", rows_per_bucket=rows_per_bucket)
    rows = stage(K.with_bucket(resampled(test, repeats, seed).withColumn("score", F.col("score").cast("double")), "score", bounds), "resampled")
    totals = rows.select("_bucket", "pos", "alerts", "drawn").mapInArrow(_bucket_totals_task(repeats), "_bucket double, repeat int, pos long, alerts long")
    cells = totals.groupBy("_bucket", "repeat").agg(F.sum("pos").alias("pos"), F.sum("alerts").alias("alerts"))
    before = Window.partitionBy("repeat").orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    start = cells.select("_bucket", "repeat", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("pos", "alerts")])
    in_order = F.array_sort(F.collect_list(F.struct("repeat", "pos", "alerts")))
    leads = start.groupBy("_bucket").agg(in_order.alias("s")).select(
        "_bucket", F.lit(0).alias("lead"), F.col("s.pos").alias("start_pos"), F.col("s.alerts").alias("start_alerts"))
    led = leads.unionByName(rows.withColumn("lead", F.lit(1)), allowMissingColumns=True)
    along = led.repartition("_bucket").sortWithinPartitions("_bucket", "lead", F.col("score").desc())
    columns = ["_bucket", "lead", "score", "pos", "alerts", "drawn", "start_pos", "start_alerts"]
    sums = along.select(*columns).mapInArrow(_curve_task(repeats, float(threshold)), _SUMS_DDL)
    whole = sums.groupBy("repeat").agg(*[F.sum(c).alias(c) for c in _SUMS]).withColumn("threshold", F.lit(float(threshold)))
    return M.record(whole, ["repeat"]).where(F.col("roc_auc").isNotNull())


def grouped_bootstrap(test: DataFrame, threshold: float, repeats: int = 400, seed: int = 42) -> DataFrame:
    """95 % percentile intervals, one row per metric (customers resampled, rows kept together).

    ``test`` has customer_id, label, score.
    """
    per = repeat_metrics(test, threshold, repeats, seed)
    # `repeats` rows at most, so Spark's exact percentile is fine here.
    ends = per.agg(
        F.count(F.lit(1)).alias("repeats"),
        *[F.percentile(m, F.array(F.lit(0.025), F.lit(0.975))).alias(m) for m in M.INTERVAL_METRICS],
    )
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m)[0].alias("lower"), F.col(m)[1].alias("upper")) for m in M.INTERVAL_METRICS])
    return ends.select("repeats", F.explode(cells).alias("c")).select("c.*", "repeats")


def sensitivity(
    train: DataFrame, validation: DataFrame, candidate: MD.Candidate, final: PipelineModel | None = None
) -> DataFrame:
    """Validation average precision of the chosen model type with extra inputs; none may replace it."""
    variants = [  # fixed values: names in the result table
        ("Final: transaction-time fields only", False, False),
        ("Add unverified history (diagnostic only)", True, False),
        ("Add suspicious keyword (diagnostic only)", False, True),
    ]
    scores = None
    for name, history, keyword in variants:
        keep_final = final is not None and not history and not keyword
        model = final if keep_final else MD.fit_candidate(train, candidate, history, keyword)
        part = MD.score(model, validation, "score").select(F.lit(name).alias("variant"), "label", "score")
        scores = part if scores is None else scores.unionByName(part)
    scores = stage(scores, "variant-scores")  # models score once, however often their scores are read
    table = M.evaluate(scores, 0.5, groups=["variant"], group_limit=len(variants))
    return table.select("variant", F.col("average_precision").alias("validation_ap"))


def permuted(validation: DataFrame, features: list[str], repeats: int, seed: int, key: str = "txn_id", rows_per_bucket: int = K.ROWS_PER_BUCKET, rows: int | None = None) -> DataFrame:
    """One copy of ``validation`` per (feature, repeat) in which only that feature is shuffled.

    A shuffle pairs two numberings of the same rows: position by one hash receives the
    value of the row at that position by another.  Every (feature, repeat) has a donor numbering of its own, of which only the shuffled column moves; rows
    meet all their donors in one join by position.
    """
    rows = validation.count() if rows is None else rows
    own = validation.select(key, "label", *features)
    takers = K.dense_index(own, _order("base", F.col(key), F.lit(seed)), [key], rows=rows, rows_per_bucket=rows_per_bucket, name="_pos")
    variants = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat")) for f in features for r in range(repeats)]))
    givers = validation.select(key, *features, variants.alias("v")).select(
        key, F.col("v.feature").alias("feature"), F.col("v.repeat").alias("repeat"),
        *[F.when(F.col("v.feature") == f, F.col(f)).alias(f"_g_{f}") for f in features],
    )
    givers = K.dense_index(
        givers, _order("give", F.col(key), F.col("feature"), F.col("repeat"), F.lit(seed)), [key], ["feature", "repeat"],
        rows=rows, rows_per_bucket=rows_per_bucket, name="_pos",
    ).drop(key)
    return givers.join(takers, "_pos").select(
        key, "label", "feature", "repeat",
        *[F.when(F.col("feature") == f, F.col(f"_g_{f}")).otherwise(F.col(f)).alias(f) for f in features],
    )


def permutation_importance(
    score: Callable[[DataFrame], DataFrame], validation: DataFrame, features: list[str] | None = None, repeats: int = 5, seed: int = 42,
) -> DataFrame:
    """Mean and population deviation of the drop in average precision per shuffled input.

    ``score`` adds a ``score`` column to a table with the scoring inputs.
    """
    features = features or SCORING_INPUTS
    rows = validation.count()
    plain = stage(score(validation.select("txn_id", "label", *features)).select("label", "score"), "validation-scores")
    # Shuffled copies are scored once; the unshuffled scores' ranges serve them all, for ranges only balance load.
    bounds = K.value_bounds(plain, "score", rows=rows)
    base = M.evaluate(plain, 0.5, bounds=bounds).select("average_precision").first()[0]
    scored = stage(score(permuted(validation, features, repeats, seed, rows=rows)).select("feature", "repeat", "label", "score"), "permuted-scores")
    aps = M.evaluate(scored, 0.5, groups=["feature", "repeat"], group_limit=len(features) * repeats, bounds=bounds)
    drop = F.lit(base) - F.col("average_precision")
    return (
        aps.groupBy("feature")
        .agg(F.avg(drop).alias("validation_ap_drop_mean"), F.stddev_pop(drop).alias("validation_ap_drop_std"))
        .orderBy(F.col("validation_ap_drop_mean").desc(), "feature")
    )
