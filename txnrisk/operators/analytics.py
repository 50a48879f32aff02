"""Queries behind an analyst's view of the scored table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.coerce import safe_ratio
from txnrisk.operators import kernels as K
from txnrisk.operators.split import label_text
from txnrisk.session import stage

DIMENSIONS = ["category", "location", "device", "method", "is_intl"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]  # fixed values, Monday is 0

MAX_LEVELS = 50  # groups of a box plot


def filtered(
    df: DataFrame, split: str | None = None, start: dt.date | None = None, end: dt.date | None = None,
    location: str | None = None, device: str | None = None, category: str | None = None,
) -> DataFrame:
    """Conjunction of the given predicates; ``None`` means all.

    Dates are inclusive calendar days, written as half-open timestamp bounds (and month
    bounds where the table is partitioned by month) so that they prune the scan.
    """
    conds: list[Column] = []
    if split is not None:
        conds.append(F.col("split") == split)
    if start is not None:
        conds.append(F.col("txn_ts") >= K.ntz(dt.datetime.combine(start, dt.time())))
    if end is not None:
        conds.append(F.col("txn_ts") < K.ntz(dt.datetime.combine(end, dt.time()) + dt.timedelta(days=1)))
    if "txn_month" in df.columns:
        if start is not None:
            conds.append(F.col("txn_month") >= f"{start:%Y-%m}")
        if end is not None:
            conds.append(F.col("txn_month") <= f"{end:%Y-%m}")
    for name, value in (("location", location), ("device", device), ("category", category)):
        if value is not None:
            conds.append(F.col(name) == value)
    for c in conds:
        df = df.where(c)
    return df


def kpis(df: DataFrame, flag: str = "predicted_fraud") -> DataFrame:
    y = F.col("label") == 1
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(y).alias("positives"),
        F.avg("label").alias("rate"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount"),
        F.coalesce(F.sum(F.when(y, F.col("amount"))), F.lit(0.0)).alias("positive_amount"),
        F.count_if(F.col(flag) == 1).alias("review_flags"),
    )


def month_by_label(df: DataFrame) -> DataFrame:
    return df.groupBy(
        F.date_trunc("month", "txn_ts").cast("date").alias("month"), label_text(F.col("label")).alias("actual_label")
    ).agg(F.count(F.lit(1)).alias("transactions"))


def _volume() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("transactions"),
        F.sum("label").alias("positives"),
        F.sum("amount").alias("amount"),
    ]


def _rate_percent() -> Column:
    return safe_ratio(F.col("positives"), F.col("transactions")) * 100


def category_stats(df: DataFrame, dim: str, sort: str | None = None, descending: bool = True) -> DataFrame:
    """Volume, positives, amount and rate per value of ``dim``; null is a value of its own."""
    out = df.groupBy(dim).agg(*_volume()).withColumn("rate_percent", _rate_percent())
    if sort:
        out = out.orderBy(F.col(sort).desc() if descending else F.col(sort).asc(), F.col(dim))
    return out


def melt(stats: DataFrame, dim: str, measures: list[str]) -> DataFrame:
    return stats.select(dim, *[F.col(m).cast("bigint").alias(m) for m in measures]).unpivot(
        [dim], measures, "measure", "count"
    )


PERIODS = {
    # period -> (truncation unit, step, days from period start to label); weeks are labelled by their Sunday
    "day": ("day", "1 day", 0),
    "week": ("week", "7 days", 6),
    "month": ("month", "1 month", 0),
}


def trend(df: DataFrame, period: str) -> DataFrame:
    """Counts, positives and amount per period, with empty periods filled in."""
    unit, step, shift = PERIODS[period]
    label = F.date_add(F.date_trunc(unit, F.col("txn_ts")).cast("date"), shift)
    per = df.groupBy(label.alias("period")).agg(*_volume())
    # Each period fills the gap up to the next one that occurs: a window over at most one row per period, no second scan.
    per = per.withColumn("_next", F.lead("period").over(Window.orderBy("period")))
    start, end = F.date_add("period", -shift), F.date_add(F.coalesce("_next", "period"), -shift)
    days = F.transform(F.sequence(start, end, F.expr(f"interval {step}")), lambda d: F.date_add(d, shift))
    filled = per.select("period", "transactions", "positives", "amount", F.explode(days).alias("day"), "_next")
    own = F.col("day") == F.col("period")
    full = filled.where(own | (F.col("day") != F.col("_next"))).select(
        F.col("day").alias("period"), *[F.when(own, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("transactions", "positives")],
        F.when(own, F.col("amount")).otherwise(F.lit(0.0)).alias("amount"),
    )
    return full.withColumn("rate_percent", _rate_percent())


def monthly_totals(df: DataFrame) -> DataFrame:
    """Months that occur, without filling."""
    return df.groupBy(F.date_trunc("month", "txn_ts").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("label").alias("positives")
    ).withColumn("rate_percent", _rate_percent())


def heatmap(df: DataFrame) -> DataFrame:
    """Weekday x hour counts, all 7 x 24 cells present."""
    hours = list(range(24))
    cells = df.select(F.weekday("txn_ts").alias("weekday"), F.hour("txn_ts").alias("hour"), "txn_id")
    grid = cells.groupBy("weekday").pivot("hour", hours).agg(F.count("txn_id"))
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    return days.join(grid, "weekday", "left").select(
        "weekday", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in hours]
    )


def histogram(df: DataFrame, value: str, bins: int, by: str = "label", density: bool = False, per_group: bool = False) -> DataFrame:
    """Equal-width counts per group; the top edge belongs to the last bin.

    ``per_group`` gives every group its own range (densities of separate samples),
    otherwise all groups share one.
    """
    rows = df.where(F.col(value).isNotNull())
    scope = [by] if per_group else []
    ranges = rows.groupBy(*scope).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
    ranges = [r for r in ranges if r["lo"] is not None]

    def pick(expr) -> Column:
        out = F.lit(None)
        for r in ranges:
            out = F.when(F.col(by).eqNullSafe(F.lit(r[by])), expr(r)).otherwise(out) if per_group else expr(r)
        return out

    def width(r) -> float:
        # A single value still gets a bin of width one.
        return (r["hi"] - r["lo"]) / bins or 1.0

    def index(r) -> Column:
        if r["lo"] == r["hi"]:
            return F.lit(1)
        raw = F.width_bucket(F.col(value), F.lit(float(r["lo"])), F.lit(float(r["hi"])), F.lit(bins))
        return F.least(raw, F.lit(bins)).cast("int")

    counts = rows.groupBy(F.col(by), pick(index).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    lo = pick(lambda r: F.lit(float(r["lo"]))).cast("double")
    w = pick(lambda r: F.lit(float(width(r)))).cast("double")
    out = counts.select(by, "bin", (lo + w * (F.col("bin") - 1)).alias("left_edge"), (lo + w * F.col("bin")).alias("right_edge"), "n")
    if density:
        total = F.sum("n").over(Window.partitionBy(by))  # at most `bins` rows per group
        out = out.withColumn("density", F.col("n") / (total * w))
    return out


def box_summary(df: DataFrame, value: str = "amount", by: str = "label", levels: tuple | None = None) -> DataFrame:
    """Exact quartiles, whiskers within 1.5 IQR and the outlier count per group.

    ``levels``: the groups wanted; by default all that occur, which must be at most ``MAX_LEVELS``.
    """
    if levels is None:
        found = df.where(F.col(by).isNotNull()).select(by).distinct().limit(MAX_LEVELS + 1).collect()
        if len(found) > MAX_LEVELS:
            raise ValueError(f"{by} has more than {MAX_LEVELS} values; name the levels wanted")
        levels = tuple(sorted(r[0] for r in found))
    q = K.exact_quantiles(
        df, {f"g{i}": (F.when(F.col(by) == g, F.col(value)), [0.25, 0.5, 0.75]) for i, g in enumerate(levels)}
    )
    v = F.col(value)
    lo, hi = F.lit(None).cast("double"), F.lit(None).cast("double")
    quart = [F.lit(None).cast("double")] * 3
    for i, g in enumerate(levels):
        q1, q2, q3 = q[f"g{i}"]
        if q1 is None:
            continue
        is_g = F.col(by) == g
        lo = F.when(is_g, q1 - 1.5 * (q3 - q1)).otherwise(lo)
        hi = F.when(is_g, q3 + 1.5 * (q3 - q1)).otherwise(hi)
        quart = [F.when(is_g, x).otherwise(o) for x, o in zip((q1, q2, q3), quart)]
    inside = v.between(lo, hi)
    return df.where(v.isNotNull() & F.col(by).isin(*levels)).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(quart[0]).alias("q1"), F.max(quart[1]).alias("median"), F.max(quart[2]).alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, summary: DataFrame, value: str = "amount", by: str = "label") -> DataFrame:
    """Rows beyond the whiskers; the summary has one row per group, ``MAX_LEVELS`` at most."""
    return K.lookup(df, summary, by, ["whisker_low", "whisker_high"], rows=MAX_LEVELS).where(
        (F.col(value) < F.col("whisker_low")) | (F.col(value) > F.col("whisker_high"))
    ).select("txn_id", by, value)


def score_points(df: DataFrame) -> DataFrame:
    """Every transaction as a (anomaly score, model score) point with its hover columns."""
    return df.select(
        "txn_id", "amount", "split", "anomaly_score", "fraud_score", label_text(F.col("label")).alias("actual_label")
    )


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def spearman(df: DataFrame, cols: list[str], rows_per_bucket: int = K.ROWS_PER_BUCKET) -> DataFrame:
    """Rank correlation of every pair of columns in long form, ties at average rank.

    MLlib's version buffers all rows of one tied value in one task, which a binary
    column cannot afford.  Here rows are folded to distinct combinations first and
    ranks belong to distinct values.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    combos = stage(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_w")), "combinations")  # read several times per column
    n = combos.count()
    joined = combos
    for c in cols:
        bounds = K.value_bounds(combos, c, rows_per_bucket=rows_per_bucket, rows=n)
        placed = K.cumulate(combos, c, {"w": F.col("_w")}, bounds=bounds, descending=False)
        # Centred average rank: rows before + half of the ties - half of all rows.
        mid = F.col("cum_w") - F.col("w") / F.lit(2.0) - F.col("all_w") / F.lit(2.0)
        # A value may be shared by very many combinations; which those are is counted before ranks are joined.
        joined = K.lookup(joined, placed.select(c, mid.alias(f"_r_{c}")), c, [f"_r_{c}"], counted=combos)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = joined.agg(*[F.sum(F.col("_w") * F.col(f"_r_{a}") * F.col(f"_r_{b}")).alias(f"{a}__{b}") for a, b in pairs])

    def corr(a: str, b: str) -> Column:
        x, y = (a, b) if (a, b) in pairs else (b, a)
        scale = F.sqrt(F.col(f"{a}__{a}")) * F.sqrt(F.col(f"{b}__{b}"))
        return F.col(f"{x}__{y}") / F.nullif(scale, F.lit(0.0))

    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr(a, b).alias("rho")) for a in cols for b in cols])
    return sums.select(F.explode(cells).alias("c")).select("c.*")


def filter_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct non-null values of each column in long form, sorted, from one scan."""
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("p")
    ).select("p.*")
    return pairs.where("value is not null").distinct().orderBy("column", "value")


def template_rows(df: DataFrame, cols: list[str], rows: int = 8) -> DataFrame:
    """The first rows by time as an input template (a top-k, not a full sort)."""
    return df.orderBy("txn_ts", "txn_id").limit(rows).select(*cols)
