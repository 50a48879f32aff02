"""Cleaning and audit of the raw feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.functions import coerce as C
from txnrisk.operators import kernels as K
from txnrisk.session import stage
from txnrisk.sources import schema as S

# Fixed value: note stored with the history audit.
INTERPRETATION = (
    "Falling values hint that the history columns are not snapshots taken before each transaction, "
    "or that one ID stands for several customers; neither is settled here, and nothing is rebuilt from later rows."
)


def _same_value(df: DataFrame, name: str) -> Column:
    """Text under which two cells count as equal: ``1`` and ``1.0`` are the same number."""
    col = F.col(name).cast("string")
    if name in S.NUMERIC or name == "label":
        return F.coalesce(C.number(df, name).cast("string"), col)
    return col


def distinct_rows(feed: DataFrame, part: str | None = None) -> DataFrame:
    """Exact duplicates (within a ``part`` column, if one is named) folded into one row with ``copies``.

    Grouping (rather than ``dropDuplicates``) keeps the raw counts in the same pass,
    and partial aggregation folds large groups of copies before the shuffle.
    """
    df = S.to_engine_names(feed)
    cols = list(S.FEED_TO_ENGINE.values())
    parts = [part] if part else []
    return df.select(*parts, *[_same_value(df, c).alias(c) for c in cols]).groupBy(*parts, *cols).agg(
        F.count(F.lit(1)).alias("copies")
    )


def typed(rows: DataFrame) -> DataFrame:
    """Coerce every column of ``distinct_rows``; raw cells stay as ``raw_*`` for the audit."""
    cols = list(S.FEED_TO_ENGINE.values())
    kept = rows.withColumns({f"raw_{c}": F.col(c) for c in cols})
    out = kept.withColumns({
        **{c: C.clean_text(F.col(c)) for c in S.TEXT},
        "txn_ts": C.event_time(kept, "txn_ts"),
        "label": C.number(kept, "label"),
    })
    out = C.with_numbers(out, S.NUMERIC)
    out = out.withColumn("label", F.when(F.col("label").isin(0.0, 1.0), F.col("label").cast("int")))
    valid = F.col("label").isNotNull() & F.col("txn_ts").isNotNull()
    for key in S.KEYS:
        valid = valid & F.col(key).isNotNull()
    # Tied to the count, the predicate stays above the aggregate: pushed below, it would
    # parse every cell a second time before the shuffle to drop a few rows.
    return out.withColumn("valid", F.when(F.col("copies") > 0, valid))


def clean_rows(feed: DataFrame) -> DataFrame:
    """Typed valid rows.  Zero and extreme amounts stay: unusual may be the signal."""
    return valid_rows(typed(distinct_rows(feed)))


def valid_rows(t: DataFrame) -> DataFrame:
    return t.where("valid").select(*S.FEED_TO_ENGINE.values())


def key_conflicts(df: DataFrame, key: str | list[str] = "txn_id") -> DataFrame:
    """Keys that occur more than once; partial aggregation absorbs a hot key."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str = "txn_id") -> DataFrame:
    if key_conflicts(df, key).limit(1).count():
        raise ValueError("Some transaction IDs occur more than once; resolve them at the source.")
    return df


def audit_summary(feed: DataFrame) -> DataFrame:
    """One row with every audit counter, from a single shuffle of the feed."""
    return summarize(typed(distinct_rows(feed)))


def _when_ok(c: Column) -> Column:
    return F.when(F.col("valid"), c)


def _counters() -> dict[str, Column]:
    """Counters of a ``typed`` table that add up over its parts (dates: by minimum and maximum)."""
    ok, n, cols = F.col("valid"), F.col("copies"), list(S.FEED_TO_ENGINE.values())
    return {
        "rows_raw": F.sum(n),
        "exact_duplicates_removed": F.sum(n - 1),
        "invalid_key_date_or_label_rows_removed": F.count_if(~ok),
        "rows_clean": F.count_if(ok),
        "positives": F.sum(_when_ok(F.col("label"))),
        "total_amount": F.sum(_when_ok(F.col("amount"))),
        "positive_amount": F.sum(F.when(ok & (F.col("label") == 1), F.col("amount"))),
        "zero_amount_count": F.count_if(ok & (F.col("amount") == 0)),
        "min_date": F.min(_when_ok(F.col("txn_ts"))),
        "max_date": F.max(_when_ok(F.col("txn_ts"))),
        **{f"_raw_{c}": F.sum(F.when(F.col(f"raw_{c}").isNull(), n).otherwise(0)) for c in cols},
        **{f"_clean_{c}": F.count_if(ok & F.col(c).isNull()) for c in cols},
        **{f"_bad_{c}": F.count_if(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull()) for c in S.NUMERIC},
    }


def _report(sums: DataFrame) -> DataFrame:
    """The audit's row: plain counters and, per column, the counts of missing and invalid cells."""
    def per_column(prefix: str, names: list[str]) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(S.ENGINE_TO_FEED[c]) for c in names]), F.array(*[F.col(f"{prefix}{c}") for c in names])
        )

    cols = list(S.FEED_TO_ENGINE.values())
    return sums.select(
        *[c for c in sums.columns if not c.startswith("_")],
        per_column("_raw_", cols).alias("missing_raw"),
        per_column("_clean_", cols).alias("missing_clean"),
        per_column("_bad_", S.NUMERIC).alias("invalid_numeric_cells"),
    )


def summarize(t: DataFrame) -> DataFrame:
    """The audit counters of a ``typed`` table."""
    return _report(t.agg(
        *[c.alias(n) for n, c in _counters().items()],
        F.avg(_when_ok(F.col("label"))).alias("rate"),
        F.countDistinct(_when_ok(F.col("customer_id"))).alias("unique_customers"),
    ))


def audit_parts(feed: DataFrame, part: str, path: str) -> None:
    """Audit the parts of a feed (months, say, named in the column ``part``) and keep, per part, its counters and its distinct customers under ``path``.

    A part is delivered whole; delivering it again replaces what was kept of it and touches no other.  Copies of a row
    must be in its part, as they are where the part follows from the row.
    """
    t = stage(typed(distinct_rows(feed, part)), "audit-part")
    kept = {
        "counters": t.groupBy(part).agg(*[c.alias(n) for n, c in _counters().items()]),
        "customers": t.where("valid").select(part, "customer_id").distinct(),
    }
    for name, rows in kept.items():
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(f"{path}/{name}")


def merged_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit of all parts kept under ``path``, equal to ``audit_summary`` of their rows, without reading any feed."""
    how = {"min_date": F.min, "max_date": F.max}
    sums = spark.read.parquet(f"{path}/counters").agg(*[how.get(n, F.sum)(n).alias(n) for n in _counters()])
    customers = spark.read.parquet(f"{path}/customers").select("customer_id").distinct().agg(F.count(F.lit(1)).alias("unique_customers"))
    both = sums.crossJoin(customers)  # one row each
    return _report(both.withColumn("rate", C.safe_ratio(F.col("positives"), F.col("rows_clean"))))


def history_decreases(df: DataFrame, rows_per_bucket: int = K.ROWS_PER_BUCKET) -> DataFrame:
    """Rows whose account age or previous-transaction count is below the customer's prior row.

    A customer may own a large share of all rows, so each customer's history is cut
    into time ranges: decreases inside a range come from ``lag``, decreases across two
    ranges from the ranges' first and last rows (one row per customer and range).
    """
    watched = ["account_age_days", "previous_txns"]
    ticks = df.select(
        "customer_id", "txn_ts", "txn_id", *watched,
        F.unix_micros(F.col("txn_ts").cast("timestamp")).cast("double").alias("_tick"),
    )
    bounds = K.value_bounds(ticks, "_tick", rows_per_bucket=rows_per_bucket)
    cut = K.with_bucket(ticks, "_tick", bounds)
    order = F.struct("txn_ts", "txn_id")
    inside = Window.partitionBy("customer_id", "_bucket").orderBy("txn_ts", "txn_id")
    steps = cut.select(
        "customer_id", "_bucket", order.alias("_at"), *watched, *[F.lag(c).over(inside).alias(f"_prev_{c}") for c in watched]
    )
    spans = steps.groupBy("customer_id", "_bucket").agg(
        *[F.count_if(F.col(c) < F.col(f"_prev_{c}")).alias(f"_n_{c}") for c in watched],
        F.min_by(F.struct(*watched), "_at").alias("_first"),
        F.max_by(F.struct(*watched), "_at").alias("_last"),
    )
    along = Window.partitionBy("customer_id").orderBy("_bucket")
    edges = spans.withColumn("_before", F.lag("_last").over(along))
    return edges.agg(
        *[
            (F.coalesce(F.sum(f"_n_{c}"), F.lit(0)) + F.count_if(F.col(f"_first.{c}") < F.col(f"_before.{c}"))).alias(name)
            for c, name in zip(watched, ["account_age_decreases", "previous_txns_decreases"])
        ]
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, null count and distinct count per column, in long form.

    Distinct counts come from one grouped pass over (column, value) pairs, so one
    column's values are spread over all tasks.
    """
    kinds = dict(df.dtypes)
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])).alias("c")
    ).select("c.*")
    per_value = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    kind = F.create_map(*[F.lit(x) for c in df.columns for x in (c, kinds[c])])
    return per_value.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    ).select("column", kind[F.col("column")].alias("type"), "nulls", "distinct_values")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, one row per column."""
    spark = df.sparkSession
    row = df.agg(
        *[f(c).alias(f"{c}__{n}") for c in cols for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    ).first()
    q = K.exact_quantiles(df, {c: (F.col(c), [0.25, 0.5, 0.75]) for c in cols})
    data = [
        (c, row[f"{c}__count"], row[f"{c}__mean"], row[f"{c}__std"], _f(row[f"{c}__min"]), *q[c], _f(row[f"{c}__max"]))
        for c in cols
    ]
    return spark.createDataFrame(
        data, "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    )


def _f(x):
    return None if x is None else float(x)


def reconcile(df: DataFrame) -> DataFrame:
    """Totals used to compare a stored table with its source."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.sum("amount").alias("total_amount")
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free identity of a table: the same rows give the same numbers in any layout, and in any engine with MD5.

    Cells are hashed as text: times to the microsecond, other numbers with nine decimals (as they are where that does not fit), null as ``~``.
    """
    kinds = dict(df.dtypes)

    def cell(c: str) -> Column:
        x = F.col(f"`{c}`")
        if kinds[c].startswith("timestamp"):
            text = F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kinds[c] in ("double", "float"):
            text = F.coalesce(x.try_cast("decimal(38,9)").cast("string"), x.cast("string"))
        else:
            text = x.cast("string")
        return F.coalesce(text, F.lit("~"))

    h = K.portable_hash(*[cell(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(h).alias("hash_xor"),
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )
