"""Named queries over the test tables, each next to its expected-result SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions.coerce import iso_text
from txnrisk.operators import analytics as A
from txnrisk.operators import clean as CL
from txnrisk.operators import kernels as K
from txnrisk.operators import metrics as M
from txnrisk.operators import scoring as S
from txnrisk.operators import split as SP
from txnrisk.plans import oracles as O
from txnrisk.session import tune
from txnrisk.sources import schema as SC
from txnrisk.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FLAG_AT = 0.9  # threshold of the pseudo scores used where no model is involved


def query(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


# ------------------------------------------------------------------------- inputs

def split_txn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SP.Cuts]:
    txn = T.transactions(spark, sf_dir)
    # Dates alone decide the cuts: the joins are pruned to keys and times.
    return txn, SP.find_cuts(txn)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with their part, two pseudo scores, flags and texts."""
    txn, cuts = split_txn(spark, sf_dir)
    df = SP.with_split(txn, cuts).withColumns({
        "fraud_score": F.col("pseudo_score"),
        "anomaly_score": ((F.col("txn_id") * 104729 + F.col("customer_id") * 17) % 1009).cast("double") / 1009,
    })
    df = S.with_flags(df, FLAG_AT, FLAG_AT)
    context = F.when(F.col("split") == "train", SP.CONTEXT["train"]).when(
        F.col("split") == "validation", SP.CONTEXT["validation"]
    ).otherwise(SP.CONTEXT["test"])
    return df.withColumn("score_context", context)


def long_scores(df: DataFrame) -> DataFrame:
    """One row per (transaction, model) with four stand-in models."""
    prior = df.where(F.col("split") == "train").agg(F.avg("label")).first()[0]
    mixed = F.col("fraud_score") * 0.7 + F.col("label") * ((F.col("txn_id") % 7).cast("double") / 7) * 0.3
    models = F.array(
        F.struct(F.lit("Pseudo").alias("model"), F.lit("supervised").alias("kind"), F.col("fraud_score").alias("score")),
        F.struct(F.lit("Mixed").alias("model"), F.lit("supervised").alias("kind"), mixed.alias("score")),
        F.struct(F.lit("Prior").alias("model"), F.lit("baseline").alias("kind"), F.lit(float(prior)).alias("score")),
        F.struct(F.lit("Anomaly").alias("model"), F.lit("unsupervised").alias("kind"), F.col("anomaly_score").alias("score")),
    )
    return df.select("txn_id", "customer_id", "split", "label", F.explode(models).alias("m")).select(
        "txn_id", "customer_id", "split", "label", "m.*"
    )


def rounded(df: DataFrame, digits: int = 9, skip: tuple = ()) -> DataFrame:
    """Doubles rounded for comparison; + 0.0 turns a negative zero into zero."""
    return df.select(*[
        (F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes
    ])


def dated(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: iso_text(F.col(c)) for c in cols})


def _day(col: str) -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd").alias(col)


# ------------------------------------------------------------- audit and cleaning

_AUDIT_MAPS = {"missing_raw": SC.FEED_COLUMNS, "missing_clean": SC.FEED_COLUMNS, "invalid_numeric_cells": [SC.ENGINE_TO_FEED[c] for c in SC.NUMERIC]}


@query("audit_summary", "with " + O.RAW + """
select (select count(*) from raw) as rows_raw,
  (select count(*) from raw) - (select count(*) from uniq) as exact_duplicates_removed,
  (select count(*) from typed) - (select count(*) from valid) as invalid_key_date_or_label_rows_removed,
  count(*) as rows_clean, cast(sum(label) as bigint) as positives, round(avg(label), 9) as rate,
  round(sum(amount), 2) as total_amount, round(sum(amount) filter (label = 1), 2) as positive_amount,
  count(*) filter (amount = 0) as zero_amount_count,
  strftime(min(txn_ts), '%Y-%m-%d %H:%M:%S') as min_date, strftime(max(txn_ts), '%Y-%m-%d %H:%M:%S') as max_date,
  count(distinct customer_id) as unique_customers,
""" + ",\n".join(
    [f"(select count(*) filter ({c} is null) from raw) as missing_raw_{c}" for c in SC.FEED_COLUMNS]
    + [f"count(*) filter ({SC.FEED_TO_ENGINE[c]} is null) as missing_clean_{c}" for c in SC.FEED_COLUMNS]
    + [f"(select count(*) filter (raw_{c} is not null and {c} is null) from typed) as invalid_numeric_cells_{SC.ENGINE_TO_FEED[c]}" for c in SC.NUMERIC]
) + """
from valid""")
def audit_summary(spark, sf_dir):
    return flat_audit(CL.audit_summary(null_tokens(T.raw_feed(spark, sf_dir))))


def flat_audit(a: DataFrame) -> DataFrame:
    a = dated(a, "min_date", "max_date").withColumns({
        "total_amount": F.round("total_amount", 2), "positive_amount": F.round("positive_amount", 2), "rate": F.round("rate", 9)
    })
    flat = [F.col(m)[c].alias(f"{m}_{c}") for m, cols in _AUDIT_MAPS.items() for c in cols]
    return a.select(*[c for c in a.columns if c not in _AUDIT_MAPS], *flat)


@query("audit_incremental", ORACLES["audit_summary"])
def audit_incremental(spark, sf_dir):
    """The audit put together from yearly parts, the last of which arrives later."""
    from txnrisk.functions.coerce import event_time
    from txnrisk.session import working_path

    feed, path = null_tokens(T.raw_feed(spark, sf_dir)), working_path(spark, "audit")
    year = F.coalesce(F.year(event_time(feed, "Transaction_Date")).cast("string"), F.lit("none"))
    parts = feed.withColumn("part", year)
    last = parts.where("part <> 'none'").agg(F.max("part")).first()[0]
    CL.audit_parts(parts.where(F.col("part") != last), "part", path)
    CL.audit_parts(parts.where(F.col("part") == last), "part", path)
    return flat_audit(CL.merged_audit(spark, path))


def null_tokens(feed: DataFrame) -> DataFrame:
    from txnrisk.sources.readers import null_tokens as apply

    return apply(feed)


_CLEAN_SELECT = """select txn_id, customer_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, amount, is_intl,
  previous_txns, average_spend, account_age_days, category, method, device, location, keyword, label from valid"""


@query("clean_rows", "with " + O.RAW + _CLEAN_SELECT)
def clean_rows(spark, sf_dir):
    return dated(CL.clean_rows(null_tokens(T.raw_feed(spark, sf_dir))), "txn_ts")


@query("key_conflicts", """select l_orderkey, l_linenumber, count(*) as n from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""")
def key_conflicts(spark, sf_dir):
    return CL.key_conflicts(T.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("history_decreases", "with " + O.TXN + """,
d as (select account_age_days - lag(account_age_days) over w as a, previous_txns - lag(previous_txns) over w as p
  from txn window w as (partition by customer_id order by txn_ts, txn_id))
select count(*) filter (a < 0) as account_age_decreases, count(*) filter (p < 0) as previous_txns_decreases from d""")
def history_decreases(spark, sf_dir):
    return CL.history_decreases(T.transactions(spark, sf_dir))


_KINDS = {"txn_ts": "timestamp_ntz", "label": "int", **dict.fromkeys(SC.NUMERIC, "double")}


@query("column_profile", "with " + O.RAW + " " + " union all ".join(
    f"""select '{c}' as "column", '{t}' as "type", count(*) filter ({c} is null) as nulls, count(distinct {c}) as distinct_values from valid"""
    for c, t in ((c, _KINDS.get(c, "string")) for c in SC.FEED_TO_ENGINE.values())))
def column_profile(spark, sf_dir):
    return CL.column_profile(CL.clean_rows(null_tokens(T.raw_feed(spark, sf_dir))))


@query("describe_numeric", "with " + O.TXN + " " + " union all ".join(
    f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  round(min({c}), 6) as "min", round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50,
  round(quantile_cont({c}, 0.75), 6) as q75, round(max({c}), 6) as "max" from txn""" for c in SC.NUMERIC))
def describe_numeric(spark, sf_dir):
    return rounded(CL.describe(T.transactions(spark, sf_dir), SC.NUMERIC), 6)


@query("load_reconcile", "with " + O.RAW + """
select count(*) as rows, cast(sum(label) as bigint) as positives, round(sum(amount), 2) as total_amount from valid""")
def load_reconcile(spark, sf_dir):
    from txnrisk.session import working_path
    from txnrisk.sources.writers import write_clean

    path = working_path(spark, "clean")
    write_clean(CL.clean_rows(null_tokens(T.raw_feed(spark, sf_dir))), path)
    return CL.reconcile(spark.read.parquet(path)).withColumn("total_amount", F.round("total_amount", 2))


_CELLS = {"txn_ts": "strftime(txn_ts, '%Y-%m-%d %H:%M:%S.%f')", **{c: f"cast(cast({c} as decimal(38, 9)) as varchar)" for c in (
    "amount", "previous_txns", "average_spend", "account_age_days", "pseudo_score")}}


@query("fingerprint", "with " + O.TXN + ", h as (select cast('0x' || substr(md5(concat_ws('-', " + ", ".join(
    _CELLS.get(c, f"cast({c} as varchar)") for c in sorted([*SC.FEED_TO_ENGINE.values(), "pseudo_score"]))
    + """)), 1, 15) as bigint) as h from txn)
select count(*) as rows, bit_xor(h) as hash_xor, cast(sum(cast(h as hugeint)) as varchar) as hash_sum from h""")
def fingerprint(spark, sf_dir):
    return CL.fingerprint(T.transactions(spark, sf_dir))


# ------------------------------------------------------------- feeds and files, there and back

def feed_file(spark, sf_dir, df: DataFrame | None = None) -> str:
    """The raw feed as CSV in the shared folder; cells are written as they are, blanks included."""
    from txnrisk.session import working_path

    path = working_path(spark, "feed")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True, "emptyValue": "", "quote": "\u0000"}
    (T.raw_feed(spark, sf_dir) if df is None else df).write.options(**keep).csv(path)
    return path


@query("csv_feed_clean", ORACLES["clean_rows"])
def csv_feed_clean(spark, sf_dir):
    """The feed written as text, read as a feed and cleaned: the same rows as without files."""
    from txnrisk.sources import readers as R

    return dated(CL.clean_rows(R.read_feed(spark, feed_file(spark, sf_dir))), "txn_ts")


@query("feed_malformed", "with " + O.RAW + """
select count(*) filter (Device_Type <> 'F') as good_rows, count(*) filter (Device_Type = 'F') as malformed_lines,
  count(distinct Location) filter (Device_Type <> 'F') as locations from raw""")
def feed_malformed(spark, sf_dir):
    """Lines with a surplus field are kept apart, none passes as a row."""
    from txnrisk.sources import readers as R

    raw = T.raw_feed(spark, sf_dir)
    surplus = F.when(F.col("Device_Type") == "F", F.concat("Suspicious_Keyword", F.lit(",surplus"))).otherwise(F.col("Suspicious_Keyword"))
    good, bad = R.split_feed(spark, feed_file(spark, sf_dir, raw.withColumn("Suspicious_Keyword", surplus)))
    rows = good.agg(F.count(F.lit(1)).alias("good_rows"), F.count_distinct("Location").alias("locations"))
    return rows.join(bad.agg(F.count(F.lit(1)).alias("malformed_lines"))).select("good_rows", "malformed_lines", "locations")


# ------------------------------------------------------------------ split and joins

@query("split_assignments", "with " + O.SPLIT + """
select txn_id, customer_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, label, split from sp""")
def split_assignments(spark, sf_dir):
    return dated(SP.assignments(*split_txn(spark, sf_dir)), "txn_ts")


@query("split_summary", "with " + O.SPLIT + """
select split, count(*) as rows, cast(sum(label) as bigint) as positives, round(avg(label), 9) as rate,
  strftime(min(txn_ts), '%Y-%m-%d %H:%M:%S') as "start", strftime(max(txn_ts), '%Y-%m-%d %H:%M:%S') as "end",
  count(distinct customer_id) as customers from sp group by split""")
def split_summary(spark, sf_dir):
    return rounded(dated(SP.split_summary(*split_txn(spark, sf_dir)), "start", "end"))


@query("customer_overlap", "with " + O.SPLIT + """,
c as (select customer_id, bool_or(split = 'train') as a, bool_or(split = 'validation') as b, bool_or(split = 'test') as c
  from sp group by customer_id)
select count(*) filter (a and b) as train_validation, count(*) filter (a and c) as train_test,
  count(*) filter (b and c) as validation_test from c""")
def customer_overlap(spark, sf_dir):
    return SP.customer_overlap(*split_txn(spark, sf_dir))


@query("split_disjoint", "with " + O.SPLIT + """
select (select count(*) from (select txn_id from sp where split = 'train' intersect select txn_id from sp where split = 'validation')) as shared_train_validation,
  (select count(*) from (select txn_id from sp where split = 'train' intersect select txn_id from sp where split = 'test')) as shared_train_test,
  (select count(*) from (select txn_id from sp where split = 'validation' intersect select txn_id from sp where split = 'test')) as shared_validation_test,
  max(txn_ts) filter (split = 'train') < min(txn_ts) filter (split = 'validation') as train_before_validation,
  max(txn_ts) filter (split = 'validation') < min(txn_ts) filter (split = 'test') as validation_before_test from sp""")
def split_disjoint(spark, sf_dir):
    return SP.disjoint_check(*split_txn(spark, sf_dir))


@query("scored_context", "with " + O.SCORED + """
select txn_id, round(fraud_score, 9) as fraud_score, split, score_context, actual_label from scored""")
def scored_context(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    scores = txn.select("txn_id", "label", F.col("pseudo_score").alias("fraud_score"))
    joined = SP.join_context(scores, SP.assignments(txn, cuts))
    return rounded(joined.select(
        "txn_id", "fraud_score", "split", "score_context", SP.label_text(F.col("label")).alias("actual_label")
    ))


@query("seen_unseen", "with " + O.SPLIT + """
select case when customer_id in (select customer_id from sp where split = 'train') then 'seen in training'
  else 'unseen in training' end as customer_slice, count(*) as n, cast(sum(label) as bigint) as positives
from sp where split = 'test' group by 1""")
def seen_unseen(spark, sf_dir):
    return slices(*split_txn(spark, sf_dir)).groupBy("customer_slice").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")
    )


def slices(txn: DataFrame, cuts: SP.Cuts) -> DataFrame:
    flagged = SP.seen_flag(txn, cuts)
    return flagged.withColumn("customer_slice", F.when(F.col("seen"), "seen in training").otherwise("unseen in training"))


# ----------------------------------------------------------------------- analytics

_FILTER = dict(split="test", start=dt.date(2000, 6, 1), end=dt.date(2000, 12, 31), device="F")
_FILTER_SQL = "split = 'test' and cast(txn_ts as date) between date '2000-06-01' and date '2000-12-31' and device = 'F'"


@query("filtered_kpis", "with " + O.SCORED + f"""
select count(*) as transactions, count(*) filter (label = 1) as positives, round(avg(label), 9) as rate,
  round(coalesce(sum(amount), 0), 2) as amount, round(coalesce(sum(amount) filter (label = 1), 0), 2) as positive_amount,
  cast(coalesce(sum(predicted_fraud), 0) as bigint) as review_flags from scored where {_FILTER_SQL}""")
def filtered_kpis(spark, sf_dir):
    k = A.kpis(A.filtered(scored(spark, sf_dir), **_FILTER))
    return k.withColumns({"rate": F.round("rate", 9), "amount": F.round("amount", 2), "positive_amount": F.round("positive_amount", 2)})


@query("filtered_export", "with " + O.SCORED + f"""
select txn_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, amount, device, location, round(fraud_score, 9) as fraud_score,
  predicted_fraud, review_status, split from scored where {_FILTER_SQL}""")
def filtered_export(spark, sf_dir):
    rows = A.filtered(scored(spark, sf_dir), **_FILTER)
    rows = rows.withColumn("fraud_score", F.round("fraud_score", 9))
    return dated(rows, "txn_ts").select(
        "txn_id", "txn_ts", "amount", "device", "location", "fraud_score", "predicted_fraud", "review_status", "split"
    )


@query("month_by_label", "with " + O.SCORED + """
select strftime(date_trunc('month', txn_ts), '%Y-%m-%d') as month, actual_label, count(*) as transactions from scored group by all""")
def month_by_label(spark, sf_dir):
    return A.month_by_label(T.transactions(spark, sf_dir)).withColumn("month", _day("month"))


@query("monthly_totals", "with " + O.TXN + """
select strftime(date_trunc('month', txn_ts), '%Y-%m-%d') as month, count(*) as transactions,
  cast(sum(label) as bigint) as positives, round(sum(label) / count(*) * 100, 9) as rate_percent from txn group by 1""")
def monthly_totals(spark, sf_dir):
    return rounded(A.monthly_totals(T.transactions(spark, sf_dir)).withColumn("month", _day("month")))


def _stats_sql(dim: str, source: str = "txn") -> str:
    return f"""select {dim}, count(*) as transactions, cast(sum(label) as bigint) as positives, round(sum(amount), 2) as amount,
  round(sum(label) / count(*) * 100, 9) as rate_percent from {source} group by {dim}"""


def _stats(df: DataFrame, dim: str, sort: str = "rate_percent") -> DataFrame:
    out = A.category_stats(df, dim, sort)
    return out.withColumns({"amount": F.round("amount", 2), "rate_percent": F.round("rate_percent", 9)})


for _dim in A.DIMENSIONS:
    query(f"category_stats_{_dim}", "with " + O.TXN + " " + _stats_sql(_dim))(
        lambda spark, sf_dir, d=_dim: _stats(T.transactions(spark, sf_dir), d)
    )


@query("category_stats_nulls", "with " + O.RAW + " " + _stats_sql("category", "valid"))
def category_stats_nulls(spark, sf_dir):
    return _stats(CL.clean_rows(null_tokens(T.raw_feed(spark, sf_dir))), "category", "positives")


@query("category_stats_test", "with " + O.SPLIT + " " + _stats_sql("category", "sp where split = 'test'"))
def category_stats_test(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    return _stats(txn.where(cuts.condition("test")), "category")


@query("category_melt", "with " + O.TXN + """,
s as (select category, count(*) as transactions, cast(sum(label) as bigint) as positives from txn group by category)
select category, 'transactions' as measure, transactions as "count" from s union all select category, 'positives', positives from s""")
def category_melt(spark, sf_dir):
    return A.melt(A.category_stats(T.transactions(spark, sf_dir), "category"), "category", ["transactions", "positives"])


_TREND = {
    "day": ("cast(txn_ts as date)", "interval 1 day", ""),
    "week": ("cast(date_trunc('week', txn_ts) as date)", "interval 7 day", " + interval 6 day"),
    "month": ("cast(date_trunc('month', txn_ts) as date)", "interval 1 month", ""),
}
for _period, (_trunc, _step, _shift) in _TREND.items():
    query(f"trend_{_period}", "with " + O.TXN + f""",
base as (select {_trunc} as d, label, amount from txn),
per as (select d, count(*) as n, sum(label) as p, sum(amount) as a from base group by d),
spine as (select cast(unnest(generate_series(min(d), max(d), {_step})) as date) as d from per)
select strftime(s.d{_shift}, '%Y-%m-%d') as period, coalesce(n, 0) as transactions, cast(coalesce(p, 0) as bigint) as positives,
  round(coalesce(a, 0), 2) as amount, round(p / n * 100, 9) as rate_percent from spine s left join per using (d)""")(
        lambda spark, sf_dir, p=_period: _trend(spark, sf_dir, p)
    )


def _trend(spark, sf_dir, period):
    out = A.trend(T.transactions(spark, sf_dir), period).withColumns({"amount": F.round("amount", 2), "rate_percent": F.round("rate_percent", 9)})
    return out.withColumn("period", _day("period"))


@query("heatmap", "with " + O.TXN + ", c as (select (isodow(txn_ts) - 1) as weekday, hour(txn_ts) as h, count(txn_id) as n from txn group by all) "
       + "select cast(d.w as int) as weekday, " + ", ".join(f"cast(coalesce(sum(n) filter (h = {h}), 0) as bigint) as h{h:02d}" for h in range(24))
       + " from range(7) d(w) left join c on c.weekday = d.w group by d.w")
def heatmap(spark, sf_dir):
    return A.heatmap(T.transactions(spark, sf_dir))


def _histogram_sql(source: str, value: str, bins: int, density: bool, per_group: bool) -> str:
    part = "group by label" if per_group else ""
    on = "using (label)" if per_group else "on true"
    cols = "label, bin, round(lo + w * (bin - 1), 6) as left_edge, round(lo + w * bin, 6) as right_edge, n"
    dens = ", round(n / (sum(n) over (partition by label) * w), 12) as density" if density else ""
    g = "label, " if per_group else ""
    return f""",
r as (select {g}min({value}) as lo, max({value}) as hi, (max({value}) - min({value})) / {bins} as w from {source} {part}),
b as (select label, lo, w, cast(least(floor(({value} - lo) / (hi - lo) * {bins}) + 1, {bins}) as int) as bin from {source} join r {on}),
c as (select label, bin, any_value(lo) as lo, any_value(w) as w, count(*) as n from b group by label, bin)
select {cols}{dens} from c"""


def _hist(df: DataFrame, *args, **kw) -> DataFrame:
    h = A.histogram(df, *args, **kw)
    h = h.withColumns({"left_edge": F.round("left_edge", 6), "right_edge": F.round("right_edge", 6)})
    return h.withColumn("density", F.round("density", 12)) if "density" in h.columns else h


@query("histogram_anomaly", "with " + O.SCORED + _histogram_sql("scored", "anomaly_score", 40, False, False))
def histogram_anomaly(spark, sf_dir):
    return _hist(scored(spark, sf_dir), "anomaly_score", 40)


@query("histogram_amount_density", "with " + O.TXN + _histogram_sql("txn", "amount", 35, True, True))
def histogram_amount_density(spark, sf_dir):
    return _hist(T.transactions(spark, sf_dir), "amount", 35, density=True, per_group=True)


@query("histogram_anomaly_test", "with " + O.SCORED + ", tst as (select * from scored where split = 'test')"
       + _histogram_sql("tst", "anomaly_score", 30, True, True))
def histogram_anomaly_test(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return _hist(rows.where(F.col("split") == "test"), "anomaly_score", 30, density=True, per_group=True)


_BOX = O.TXN + """,
q as (select label, quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.5) as median, quantile_cont(amount, 0.75) as q3
  from txn group by label),
f as (select t.txn_id, t.label, amount, q1, median, q3,
  amount between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from txn t join q on q.label = t.label)"""


@query("box_summary", "with " + _BOX + """
select label, count(*) as n, round(any_value(q1), 6) as q1, round(any_value(median), 6) as median, round(any_value(q3), 6) as q3,
  round(min(amount) filter (inside), 6) as whisker_low, round(max(amount) filter (inside), 6) as whisker_high,
  count(*) filter (not inside) as outliers from f group by label""")
def box_summary(spark, sf_dir):
    return rounded(A.box_summary(T.transactions(spark, sf_dir)), 6)


@query("box_outliers_events", """with e as (select event_id as txn_id, cast(json_extract_string(props, '$.k') as int) < 10 as y, value as amount from events),
t as (select txn_id, cast(y as int) as label, case when txn_id % 100 = 0 then amount * 20 else amount end as amount from e),
q as (select label, quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.75) as q3 from t group by label)
select txn_id, t.label, round(amount, 6) as amount from t join q on q.label = t.label
where amount < q1 - 1.5 * (q3 - q1) or amount > q3 + 1.5 * (q3 - q1)""")
def box_outliers_events(spark, sf_dir):
    evt = T.events(spark, sf_dir).withColumn(
        "amount", F.when(F.col("txn_id") % 100 == 0, F.col("amount") * 20).otherwise(F.col("amount"))
    )
    return rounded(A.box_outliers(evt, A.box_summary(evt)), 6)


@query("score_points", "with " + O.SCORED + """
select txn_id, amount, split, round(anomaly_score, 9) as anomaly_score, round(fraud_score, 9) as fraud_score, actual_label from scored""")
def score_points(spark, sf_dir):
    return rounded(A.score_points(scored(spark, sf_dir)), skip=("amount",))


@query("label_distribution", "with " + O.TXN + " select label, count(*) as n, round(sum(amount), 2) as amount from txn group by label")
def label_distribution(spark, sf_dir):
    return A.label_distribution(T.transactions(spark, sf_dir)).withColumn("amount", F.round("amount", 2))


_SPEARMAN_COLS = ["amount", "is_intl", "label"]


@query("spearman", "with " + O.SPLIT + ", r as (select " + ", ".join(
    f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}" for c in _SPEARMAN_COLS)
    + " from sp where split = 'train') " + " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 9) as rho from r" for a in _SPEARMAN_COLS for b in _SPEARMAN_COLS))
def spearman(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    return rounded(A.spearman(txn.where(cuts.condition("train")), _SPEARMAN_COLS))


_FILTERS = ["location", "device", "category", "method"]


@query("filter_values", "with " + O.TXN + " " + " union all ".join(
    f"""select distinct '{c}' as "column", {c} as "value" from txn where {c} is not null""" for c in _FILTERS))
def filter_values(spark, sf_dir):
    return A.filter_values(T.transactions(spark, sf_dir), _FILTERS)


@query("template_rows", "with " + O.TXN + """
select strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, amount, is_intl, category, method, device, location
from txn order by txn.txn_ts, txn_id limit 8""")
def template_rows(spark, sf_dir):
    from txnrisk.sources.schema import SCORING_INPUTS

    return dated(A.template_rows(T.transactions(spark, sf_dir), SCORING_INPUTS), "txn_ts")


# ------------------------------------------------------------------------ evaluation

def test_scores(spark, sf_dir) -> tuple[DataFrame, int]:
    """Test rows with a stand-in score, and a bound on their number (known from the cuts)."""
    txn, cuts = split_txn(spark, sf_dir)
    rows = txn.where(cuts.condition("test"))
    return rows.select("txn_id", "customer_id", "label", F.col("pseudo_score").alias("score")), cuts.rows


def test_metrics(spark, sf_dir) -> DataFrame:
    rows, n = test_scores(spark, sf_dir)
    return M.evaluate(rows, FLAG_AT, rows=n)


def test_ranking(spark, sf_dir) -> DataFrame:
    rows, n = test_scores(spark, sf_dir)
    return M.ranking(rows, rows=n)


_TEST = O.SPLIT + ", src as (select txn_id, customer_id, label, pseudo_score as score from sp where split = 'test'), "
_VAL = O.SPLIT + ", src as (select label, pseudo_score as score from sp where split = 'validation'), "
_TEST_METRICS = "with " + _TEST + O.ranked("src") + f", m as (select {O.metric_cols('0.9')} from rk) "


@query("confusion", "with " + O.SPLIT + """, src as (select label, pseudo_score as score from sp where split = 'test')
select 'Legitimate' as actual, count(*) filter (label = 0 and score < 0.9) as predicted_legitimate,
  count(*) filter (label = 0 and score >= 0.9) as predicted_review from src
union all select 'Fraudulent', count(*) filter (label = 1 and score < 0.9), count(*) filter (label = 1 and score >= 0.9) from src""")
def confusion(spark, sf_dir):
    return M.confusion_matrix(M.at_threshold(test_scores(spark, sf_dir)[0], FLAG_AT))


@query("prf", _TEST_METRICS + O.rounded("m", cols=["n", "positives", "prevalence", "alert_count", "alert_rate", "precision", "recall", "f1"]))
def prf(spark, sf_dir):
    return rounded(M.at_threshold(test_scores(spark, sf_dir)[0], FLAG_AT).drop("tp", "fp", "fn", "tn"))


for _metric in ["roc_auc", "average_precision", "pr_auc"]:
    query(_metric, _TEST_METRICS + O.rounded("m", cols=["n", "positives", _metric]))(
        lambda spark, sf_dir, m=_metric: rounded(test_metrics(spark, sf_dir).select("n", "positives", m))
    )


@query("metric_record", _TEST_METRICS + O.rounded("m"))
def metric_record(spark, sf_dir):
    return rounded(test_metrics(spark, sf_dir))


@query("pr_curve", "with " + _TEST + O.ranked("src") + """
select round(cum_pos / all_pos, 9) as x, round(cum_pos / cum_alerts, 9) as y from rk union all select 0.0, 1.0""")
def pr_curve(spark, sf_dir):
    return rounded(M.pr_curve(test_ranking(spark, sf_dir)))


@query("roc_curve", "with " + _TEST + O.ranked("src") + """
select round((cum_alerts - cum_pos) / (all_alerts - all_pos), 9) as x, round(cum_pos / all_pos, 9) as y from rk
where cum_alerts = alerts or next_pos is null or next_pos <> pos or next_alerts - next_pos <> alerts - pos
union all select 0.0, 0.0""")
def roc_curve(spark, sf_dir):
    return rounded(M.roc_curve(test_ranking(spark, sf_dir)))


_SWEEP = """, pr as (select score as threshold, cum_pos / cum_alerts as precision, cum_pos / all_pos as recall from rk),
sw as (select *, 2 * precision * recall / greatest(precision + recall, 1e-12) as f1 from pr)
select round(threshold, 9) as threshold, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1 from sw"""


def validation_ranking(spark, sf_dir) -> DataFrame:
    txn, cuts = split_txn(spark, sf_dir)
    return M.ranking(txn.where(cuts.condition("validation")), "pseudo_score", rows=cuts.rows)


@query("threshold_sweep", "with " + _VAL + O.ranked("src") + _SWEEP)
def threshold_sweep(spark, sf_dir):
    return rounded(M.sweep(validation_ranking(spark, sf_dir), "pseudo_score"))


@query("threshold_choice", "with " + _VAL + O.ranked("src") + _SWEEP
       + " order by sw.f1 desc, sw.recall desc, sw.precision desc, sw.threshold desc limit 1")
def threshold_choice(spark, sf_dir):
    return rounded(M.choose(M.sweep(validation_ranking(spark, sf_dir), "pseudo_score")))


@query("threshold_explorer", "with " + _VAL + O.ranked("src") + f", m as (select {O.metric_cols('0.35')} from rk) "
       + O.rounded("m", cols=["precision", "recall", "f1", "alert_count"]))
def threshold_explorer(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    m = M.at_threshold(txn.where(cuts.condition("validation")), 0.35, "pseudo_score")
    return rounded(m.select("precision", "recall", "f1", "alert_count"))


@query("slice_metrics", "with " + O.SPLIT + """, src as (select label, pseudo_score as score,
  case when customer_id in (select customer_id from sp where split = 'train') then 'seen in training'
  else 'unseen in training' end as customer_slice from sp where split = 'test'), """
       + O.ranked("src", "customer_slice") + f", m as (select customer_slice, {O.metric_cols('0.9')} from rk group by customer_slice) "
       + O.rounded("m", "customer_slice"))
def slice_metrics(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    rows = slices(txn, cuts).select("customer_slice", "label", F.col("pseudo_score").alias("score"))
    return rounded(M.evaluate(rows, FLAG_AT, groups=["customer_slice"], group_limit=2, rows=cuts.rows))


_COMPARE = "with " + O.LONG + ", " + O.ranked("long", "model, kind, split") + f""",
pr as (select model, score as threshold, cum_pos / cum_alerts as precision, cum_pos / all_pos as recall from rk
  where split = 'validation' and kind = 'supervised'),
sw as (select *, 2 * precision * recall / greatest(precision + recall, 1e-12) as f1 from pr),
pick as (select model, threshold as tt from sw qualify row_number() over (partition by model order by f1 desc, recall desc, precision desc, threshold desc) = 1),
th as (select rk.*, coalesce(tt, case when kind = 'baseline' then 0.5 else (select t from cutoff) end) as th
  from rk left join pick using (model) where split <> 'train'),
m as (select model, kind, split, {O.metric_cols('th')} from th group by model, kind, split),
best as (select model from m where split = 'validation' and kind = 'supervised' order by average_precision desc, model limit 1),
cmp as (select *, model = (select model from best) as selected from m) """


def comparison(spark, sf_dir) -> DataFrame:
    df = scored(spark, sf_dir)
    train = df.where(F.col("split") == "train")
    cutoff = K.exact_quantiles(train, {"a": (F.col("anomaly_score"), [0.9])})["a"][0]
    return M.compare(long_scores(df).where(F.col("split") != "train"), fixed={"Anomaly": cutoff}, models=4)


@query("model_comparison", _COMPARE + O.rounded("cmp", "model, kind, split, selected"))
def model_comparison(spark, sf_dir):
    return rounded(comparison(spark, sf_dir))


@query("test_comparison", _COMPARE + O.rounded("cmp", "model, kind", [
    "threshold", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc", "tp", "fp", "fn", "tn"]) + " where split = 'test'")
def test_comparison(spark, sf_dir):
    rows = comparison(spark, sf_dir).where(F.col("split") == "test").orderBy("average_precision")
    return rounded(rows.select("model", "kind", "threshold", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc", "tp", "fp", "fn", "tn"))


@query("select_model", _COMPARE + "select m.model, round(average_precision, 9) as average_precision, round(threshold, 9) as threshold "
       + "from m join best on m.model = best.model where split = 'validation'")
def select_model(spark, sf_dir):
    return rounded(M.select_model(comparison(spark, sf_dir)).select("model", "average_precision", "threshold"))


@query("curve_selection", "with " + O.LONG + ", src as (select * from long where split = 'test'), " + O.ranked("src", "model") + """
select model, 'PR' as curve, round(cum_pos / all_pos, 9) as x, round(cum_pos / cum_alerts, 9) as y from rk where model in ('Mixed', 'Anomaly')
union all select model, 'PR', 0.0, 1.0 from rk where model in ('Mixed', 'Anomaly') and next_pos is null
union all select model, 'ROC', round((cum_alerts - cum_pos) / (all_alerts - all_pos), 9), round(cum_pos / all_pos, 9) from rk
where model in ('Mixed', 'Anomaly') and (cum_alerts = alerts or next_pos is null or next_pos <> pos or next_alerts - next_pos <> alerts - pos)
union all select model, 'ROC', 0.0, 0.0 from rk where model in ('Mixed', 'Anomaly') and next_pos is null""")
def curve_selection(spark, sf_dir):
    rows = long_scores(scored(spark, sf_dir)).where(F.col("split") == "test")
    both = M.curves(M.ranking(rows, groups=["model"], group_limit=4), ["model"])
    return rounded(both.where(F.col("model").isin("Mixed", "Anomaly")))


@query("scores_wide", "with " + O.LONG + """
select txn_id, customer_id, label, round(max(score) filter (model = 'Pseudo'), 9) as "Pseudo", round(max(score) filter (model = 'Mixed'), 9) as "Mixed",
  round(max(score) filter (model = 'Anomaly'), 9) as "Anomaly" from long where split = 'test' group by all""")
def scores_wide(spark, sf_dir):
    rows = long_scores(scored(spark, sf_dir)).where(F.col("split") == "test")
    return rounded(M.wide_scores(rows, ["Pseudo", "Mixed", "Anomaly"], ["txn_id", "customer_id", "label"]))


@query("score_diff", "with " + O.SPLIT + """
select txn_id, 'differs' as reason, round(pseudo_score, 9) as a_score, round(pseudo_score + 0.001, 9) as b_score
from sp where split = 'test' and txn_id % 13 = 0""")
def score_diff(spark, sf_dir):
    a, _ = test_scores(spark, sf_dir)
    # A second run whose scores moved for every 13th transaction.
    b = a.withColumn("score", F.when(F.col("txn_id") % 13 == 0, F.col("score") + 0.001).otherwise(F.col("score")))
    return rounded(M.score_diff(a, b, "txn_id", ["score"]))


@query("quantile_cutoff", "with " + O.SCORED + """
select round(quantile_cont(anomaly_score, 0.9), 9) as cutoff,
  (select count(*) from scored s where s.split = 'train' and s.anomaly_score >=
    (select quantile_cont(anomaly_score, 0.9) from scored where split = 'train')) as flagged
from scored where split = 'train'""")
def quantile_cutoff(spark, sf_dir):
    train = scored(spark, sf_dir).where(F.col("split") == "train")
    cutoff = K.exact_quantiles(train, {"a": (F.col("anomaly_score"), [0.9])})["a"][0]
    return rounded(train.agg(F.lit(cutoff).alias("cutoff"), F.count_if(F.col("anomaly_score") >= cutoff).alias("flagged")))


@query("dummy_prior", "with " + O.LONG + ", src as (select * from long where model = 'Prior' and split <> 'train'), " + O.ranked("src", "split")
       + f", m as (select split, {O.metric_cols('0.5')} from rk group by split) " + O.rounded("m", "split"))
def dummy_prior(spark, sf_dir):
    rows = long_scores(scored(spark, sf_dir)).where((F.col("model") == "Prior") & (F.col("split") != "train"))
    return rounded(M.evaluate(rows, 0.5, groups=["split"], group_limit=2))


# -------------------------------------------------------------------- score handling

@query("validate_inputs", "with " + O.RAW + """,
r as (select Transaction_ID as txn_id,
  coalesce(try_strptime(Transaction_Date, '%d-%m-%Y %H:%M'), try_cast(Transaction_Date as timestamp)) is null as d,
  Transaction_Amount is not null and coalesce(try_cast(Transaction_Amount as double), -1) < 0 as a,
  Is_International is not null and coalesce(try_cast(Is_International as double), -1) < 0 as f,
  coalesce(try_cast(Is_International as double) >= 0 and try_cast(Is_International as double) not in (0, 1), false) as b from raw)
select txn_id, concat_ws(',', case when d then 'bad_date' end, case when a then 'bad_amount' end, case when f then 'bad_flag' end,
  case when b then 'flag_not_binary' end) as reasons from r where d or a or f or b""")
def validate_inputs(spark, sf_dir):
    from txnrisk.sources.schema import to_engine_names

    _, bad = S.quarantine(to_engine_names(T.raw_feed(spark, sf_dir)))
    return bad.select("txn_id", F.concat_ws(",", "reasons").alias("reasons"))


_QUEUE = ["txn_id", "txn_ts", "amount", "fraud_score", "anomaly_score", "review_status", "actual_label", "score_context"]


@query("review_queue", "with " + O.SCORED + """
select txn_id, strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, amount, round(fraud_score, 9) as fraud_score,
  round(anomaly_score, 9) as anomaly_score, review_status, actual_label, score_context
from scored where predicted_fraud = 1 or anomaly_flag = 1 order by scored.fraud_score desc, txn_id limit 100""")
def review_queue(spark, sf_dir):
    return rounded(dated(S.review_queue(scored(spark, sf_dir)), "txn_ts").select(*_QUEUE), skip=("amount",))


_ALERT_SQL = f"""select '{S.ALERT_STATUS}' as status, '{S.ALERT_ACTION}' as action, cast(txn_id as varchar) as transaction_id,
  strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as transaction_date, amount, round(fraud_score, 9) as fraud_score, anomaly_flag,
  '{S.ALERT_MESSAGE}' as message from scored where predicted_fraud = 1 and split = 'test'"""


@query("alerts_top25", "with " + O.SCORED + " " + _ALERT_SQL + " order by scored.fraud_score desc, cast(txn_id as varchar) limit 25")
def alerts_top25(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rounded(S.alerts(rows.where(F.col("split") == "test")), skip=("amount",))


@query("alerts_all", "with " + O.SCORED + " " + _ALERT_SQL)
def alerts_all(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rounded(S.alert_records(rows.where(F.col("split") == "test")), skip=("amount",))


@query("scored_roundtrip", "with " + O.SCORED + " " + _ALERT_SQL)
def scored_roundtrip(spark, sf_dir):
    """Scored rows written as text, read back and turned into alerts."""
    from txnrisk.session import working_path
    from txnrisk.sources import readers as R
    from txnrisk.sources import writers as W

    path = working_path(spark, "scored")
    W.write_text(scored(spark, sf_dir).where(F.col("split") == "test"), path)
    return rounded(S.alerts(R.read_scored(spark, path), None), skip=("amount",))


@query("signal_counts", "with " + O.SCORED + """
select count(*) filter (predicted_fraud = 1) as model_flags, count(*) filter (anomaly_flag = 1) as anomaly_flags,
  count(*) filter (predicted_fraud = 1 and anomaly_flag = 1) as both_signals from scored""")
def signal_counts(spark, sf_dir):
    return S.signal_counts(scored(spark, sf_dir))


# ------------------------------------------------------------- features and models

from txnrisk.functions import features as FT  # noqa: E402
from txnrisk.operators import diagnostics as D  # noqa: E402
from txnrisk.operators import models as MD  # noqa: E402
from txnrisk.operators.iforest import IsolationForest  # noqa: E402
from txnrisk.operators.preprocess import Preprocess  # noqa: E402

# DuckDB has no log1p; everything else reads the same in both dialects.
_FEATURES_SQL = """select txn_id, txn_ts, label, split, amount, is_intl, category, method, device, location,
  sin(2 * pi() * (hour(txn_ts) + minute(txn_ts) / 60.0) / 24) as hour_sin, cos(2 * pi() * (hour(txn_ts) + minute(txn_ts) / 60.0) / 24) as hour_cos,
  sin(2 * pi() * (isodow(txn_ts) - 1) / 7) as weekday_sin, cos(2 * pi() * (isodow(txn_ts) - 1) / 7) as weekday_cos,
  case when isodow(txn_ts) >= 6 then 1.0 else 0.0 end as is_weekend, ln(1 + amount) as log_amount,
  previous_txns, average_spend, account_age_days, ln(1 + average_spend) as log_average_spend,
  amount / nullif(average_spend, 0) as amount_to_average, amount - average_spend as amount_minus_average,
  ln(1 + account_age_days) as log_account_age, ln(1 + previous_txns) as log_previous_txns"""
_NUMS = FT.numeric_features(True)
_PLAIN_NUMS = FT.numeric_features(False)


def gappy(df: DataFrame) -> DataFrame:
    """Transactions with planted gaps: amounts, flags and categories missing by key."""
    k = F.col("txn_id")
    return df.withColumns({
        "amount": F.when(k % 41 != 0, F.col("amount")),
        "is_intl": F.when(k % 43 != 0, F.col("is_intl")),
        "category": F.when(k % 47 != 0, F.col("category")).otherwise(F.lit("  ")),
    })


_GAPPY = O.SPLIT + """,
gap as (select * replace (case when txn_id % 41 <> 0 then amount end as amount, case when txn_id % 43 <> 0 then is_intl end as is_intl,
  case when txn_id % 47 <> 0 then category end as category) from sp),
ft as (""" + _FEATURES_SQL + " from gap)"


# Ratios of cents to a whole spend often end in an exact rounding tie, which engines break
# differently; this shift is finer than the digits compared and leaves no ties.
_NUDGE = {"amount_to_average": 1.23e-9}


@query("features_row", "with " + _GAPPY + " select txn_id, " + ", ".join(
    f"round({c} + {_NUDGE.get(c, 0.0)}, 6) + 0.0 as {c}" for c in _NUMS) + ", category, method, device, location from ft")
def features_row(spark, sf_dir):
    rows = gappy(T.transactions(spark, sf_dir))
    exprs = FT.feature_sql(include_history=True)
    out = rows.select("txn_id", *[F.expr(e).alias(n) for n, e in exprs.items()])
    return rounded(out.withColumns({c: F.col(c) + F.lit(x) for c, x in _NUDGE.items()}), 6)


@query("features_imputed_scaled", "with " + _GAPPY + ", md as (select " + ", ".join(
    f"median({c}) as {c}" for c in _PLAIN_NUMS) + " from ft where split = 'train'), im as (select txn_id, split, " + ", ".join(
    f"coalesce(ft.{c}, md.{c}) as {c}" for c in _PLAIN_NUMS) + """,
  case when ft.amount is null then 1.0 else 0.0 end as gap_amount, case when ft.is_intl is null then 1.0 else 0.0 end as gap_is_intl,
  case when ft.log_amount is null then 1.0 else 0.0 end as gap_log_amount from ft, md),
st as (select """ + ", ".join(f"avg({c}) as a_{c}, stddev_pop({c}) as s_{c}" for c in _PLAIN_NUMS + ["gap_amount", "gap_is_intl", "gap_log_amount"])
       + " from im where split = 'train') select txn_id, " + ", ".join(
    f"round(({c} - a_{c}) / case when s_{c} = 0 then 1 else s_{c} end, 6) + 0.0 as {c}" for c in _PLAIN_NUMS + ["gap_amount", "gap_is_intl", "gap_log_amount"])
       + " from im, st")
def features_imputed_scaled(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    rows = gappy(txn)
    model = Preprocess(scale=True).fit(rows.where(cuts.condition("train")))
    out = model.transform(rows)
    names = {f"p_{n}": n for n in _PLAIN_NUMS} | {f"m_{n}": f"gap_{n}" for n in ("amount", "is_intl", "log_amount")}
    return rounded(out.select("txn_id", *[F.col(c).alias(n) for c, n in names.items()]), 6)


_CATS = FT.categorical_features(False)


@query("features_onehot", "with " + _GAPPY + ", unk as (select txn_id, split, " + ", ".join(
    f"coalesce({c}, 'Unknown') as {c}" for c in _CATS) + " from ft), rare as (select * replace (case when txn_id % 53 = 0 and split <> 'train' then 'Never seen' else location end as location) from unk) select txn_id, " + ", ".join(
    f"coalesce((select r from (select v, row_number() over (order by v) - 1 as r from (select distinct {c} as v from rare where split = 'train')) d where d.v = rare.{c}), -1) as {c}"
    for c in _CATS) + " from rare")
def features_onehot(spark, sf_dir):
    """Position of the one in each category's block; -1 where the block is all zeros."""
    from pyspark.ml.functions import vector_to_array

    txn, cuts = split_txn(spark, sf_dir)
    rows = SP.with_split(gappy(txn), cuts).withColumn(
        "location", F.when((F.col("txn_id") % 53 == 0) & (F.col("split") != "train"), "Never seen").otherwise(F.col("location"))
    )
    out = Preprocess().fit(rows.where(cuts.condition("train"))).transform(rows)
    place = {c: F.array_position(vector_to_array(f"o_{c}"), 1.0) for c in _CATS}
    return out.select("txn_id", *[(p - 1).alias(c) for c, p in place.items()])


@query("class_weights", "with " + O.SPLIT + """
select label, count(*) as n, round(sum(count(*)) over () / (2 * count(*)), 9) as weight from sp where split = 'train' group by label""")
def class_weights(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    return rounded(MD.class_weights(txn.where(cuts.condition("train"))))


# Fixed coefficients, so that scoring itself has an exact expected result.
_COEF = {"log_amount": 0.31, "is_intl": 0.45, "hour_sin": -0.2, "hour_cos": 0.15, "is_weekend": 0.1}
_BASE = -5.0
_METHOD_COEF = {"1-URGENT": 1.2, "2-HIGH": -0.3}
_METHOD_SQL = "case method when '1-URGENT' then 1.2 when '2-HIGH' then -0.3 else 0.0 end"


def fixed_score(df: DataFrame, name: str = "fraud_score") -> DataFrame:
    exprs = FT.feature_sql()
    z = F.lit(_BASE)
    for feature, w in _COEF.items():
        z = z + F.lit(w) * F.coalesce(F.expr(exprs[feature]), F.lit(0.0))
    bonus = F.lit(0.0)
    for value, w in _METHOD_COEF.items():
        bonus = F.when(F.col("method") == value, w).otherwise(bonus)
    return df.withColumn(name, 1 / (1 + F.exp(-(z + bonus))))


@query("fixed_coeff_score", "with " + _GAPPY + ", z as (select *, -5.0 + " + " + ".join(
    f"{w} * coalesce({c}, 0)" for c, w in _COEF.items()) + " + " + _METHOD_SQL + """ as z from ft),
s as (select txn_id, 1 / (1 + exp(-z)) as fraud_score, cast((txn_id * 104729) % 1009 as double) / 1009 as anomaly_score from z)
select txn_id, round(fraud_score, 9) as fraud_score, cast(fraud_score >= 0.3 as int) as predicted_fraud,
  round(anomaly_score, 9) as anomaly_score, cast(anomaly_score >= 0.9 as int) as anomaly_flag,
  case when fraud_score >= 0.3 then 'Model review' when anomaly_score >= 0.9 then 'Anomaly review' else 'Lower score' end as review_status from s""")
def fixed_coeff_score(spark, sf_dir):
    rows = S.conform(gappy(T.transactions(spark, sf_dir)))
    out = fixed_score(rows).select(
        "txn_id", "fraud_score", ((F.col("txn_id") * 104729 % 1009).cast("double") / 1009).alias("anomaly_score")
    )
    return rounded(S.with_flags(out, 0.3, 0.9))


_STORED: dict[tuple[str, str], tuple[str, SP.Cuts]] = {}  # (application, tables) -> stored transactions and their cuts
_FITTED: dict[tuple[str, str], dict] = {}  # (application, tables) -> every candidate, fitted


def stored_txn(spark, sf_dir) -> tuple[DataFrame, SP.Cuts]:
    """The transactions as a table by month, stored once per application: fits read it many times, the joins run once."""
    from txnrisk.session import working_path
    from txnrisk.sources.writers import write_by_month

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = working_path(spark, "txn")
        write_by_month(T.transactions(spark, sf_dir), path)
        _STORED[key] = path, SP.find_cuts(spark.read.parquet(path))
    path, cuts = _STORED[key]
    return spark.read.parquet(path).drop("txn_month"), cuts


def fitted_candidates(spark, sf_dir) -> dict:
    """All eight candidates at their configured sizes, fitted once per application."""
    from txnrisk.plans import training as TR

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = TR.fit_all(_parts(spark, sf_dir)[0])
    return _FITTED[key]


def selected_model(spark, sf_dir) -> tuple[str, object]:
    """The candidate that validation chooses, by average precision."""
    from txnrisk.session import stage

    fitted = fitted_candidates(spark, sf_dir)
    val = _parts(spark, sf_dir)[1].withColumn("split", F.lit("validation"))
    cells = F.array(*[F.struct(F.lit(c).alias("model"), F.lit("supervised").alias("kind"), F.col(f"`{c}`").alias("score")) for c in fitted])
    # Scored once; the comparison reads the scores several times.
    wide = stage(MD.score_wide(fitted, val).select("split", "label", *[F.col(f"`{c}`") for c in fitted]), "validation-model-scores")
    long = wide.select("split", "label", F.explode(cells).alias("m")).select("split", "label", "m.*")
    name = M.select_model(M.compare(long, models=len(fitted))).first()["model"]
    return name, fitted[name]


def _parts(spark, sf_dir):
    txn, cuts = stored_txn(spark, sf_dir)
    return txn.where(cuts.condition("train")), txn.where(cuts.condition("validation")), txn.where(cuts.condition("test"))


for _name, _family in {"lr": "Logistic Regression", "tree": "Decision Tree", "rf": "Random Forest", "gbt": "Histogram Gradient Boosting"}.items():
    def _scores(spark, sf_dir, family=_family):
        train, _, test = _parts(spark, sf_dir)
        fit, scale = MD.FAMILIES[family]
        return MD.score(MD.fit_candidate(train, MD.Candidate(fit, scale)), test, "score").select("txn_id", "label", "score")

    query(f"{_name}_scores")(_scores)


@query("iforest_scores")
def iforest_scores(spark, sf_dir):
    train, _, test = _parts(spark, sf_dir)
    return IsolationForest.fit(train).score(test).select("txn_id", "label", "anomaly_score")


_HASH = "cast('0x' || substr(md5({}), 1, 15) as bigint)"
_BOOT = ("with " + _TEST + """hc as (select customer_id, """ + _HASH.format("'customer-' || customer_id || '-42'") + """ as h
  from (select distinct customer_id from src)),
-- hash order with bit 59 read as a sign
who as (select customer_id, row_number() over (order by case when h >= 576460752303423488 then 0 else 1 end, h, customer_id) - 1 as idx from hc),
g as (select count(*) as g from hc),
draws as (select r as repeat, """ + _HASH.format("'draw-' || r || '-' || d || '-42'") + """ % g as idx
  from g, range(400) a(r), lateral (select unnest(range(g)) as d)),
times as (select repeat, idx, count(*) as t from draws group by repeat, idx),
folded as (select customer_id, score, sum(label) as pos, count(*) as alerts from src group by customer_id, score),
pts as (select repeat, score, sum(pos * t) as pos, sum(alerts * t) as alerts from folded join who using (customer_id) join times using (idx)
  group by repeat, score),
rk as (select *, sum(pos) over w as cum_pos, sum(alerts) over w as cum_alerts from pts
  window w as (partition by repeat order by score desc rows unbounded preceding)),
m as (select repeat, """ + O.metric_cols("0.9") + " from rk group by repeat having sum(pos) between 1 and sum(alerts) - 1) "
         + " union all ".join(
    f"""select '{m}' as metric, round(quantile_cont({m}, 0.025), 9) as "lower", round(quantile_cont({m}, 0.975), 9) as "upper", count(*) as repeats from m"""
    for m in M.INTERVAL_METRICS))


@query("bootstrap_ci", _BOOT)
def bootstrap_ci(spark, sf_dir):
    return rounded(D.grouped_bootstrap(test_scores(spark, sf_dir)[0], FLAG_AT))


@query("sensitivity")
def sensitivity(spark, sf_dir):
    train, val, _ = _parts(spark, sf_dir)
    name, model = selected_model(spark, sf_dir)
    return D.sensitivity(train, val, MD.candidates()[name], model)


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    _, model = selected_model(spark, sf_dir)
    return D.permutation_importance(lambda df: MD.score(model, df, "score"), _parts(spark, sf_dir)[1])


_INPUTS = ["txn_ts", "amount", "is_intl", *_CATS]
_SIGN = "case when h >= 576460752303423488 then 0 else 1 end, h, txn_id"
_PERMUTE = ("with " + O.SPLIT + ", val as (select * from sp where split = 'validation'), vb as (select *, row_number() over (order by " + _SIGN
            + ") - 1 as pos from (select *, " + _HASH.format("'base-' || txn_id || '-42'") + " as h from val)), "
            + "vars as (select f, r from (values " + ", ".join(f"('{c}')" for c in _INPUTS) + ") t(f), range(5) a(r)), "
            + "gv as (select *, row_number() over (partition by f, r order by " + _SIGN + ") - 1 as pos from (select val.*, f, r, "
            + _HASH.format("'give-' || txn_id || '-' || f || '-' || r || '-42'") + " as h from val, vars)), "
            + "pm as (select vb.txn_id, vb.label, gv.f, gv.r, vb.split, vb.previous_txns, vb.average_spend, vb.account_age_days, "
            + ", ".join(f"case when gv.f = '{c}' then gv.{c} else vb.{c} end as {c}" for c in _INPUTS) + " from vb join gv using (pos) "
            + "union all select txn_id, label, 'none', 0, split, previous_txns, average_spend, account_age_days, " + ", ".join(_INPUTS) + " from val), "
            + "ft as (" + _FEATURES_SQL + ", f, r from pm), src as (select f, r, label, 1 / (1 + exp(-(-5.0 + "
            + " + ".join(f"{w} * coalesce({c}, 0)" for c, w in _COEF.items()) + " + " + _METHOD_SQL + "))) as score from ft), "
            + O.ranked("src", "f, r") + ", ap as (select f, r, sum(pos * (cum_pos / cum_alerts)) / sum(pos) as ap from rk group by f, r), "
            + "base as (select ap as b from ap where f = 'none') select f as feature, round(avg(b - ap), 8) + 0.0 as validation_ap_drop_mean, "
            + "round(stddev_pop(b - ap), 8) + 0.0 as validation_ap_drop_std from ap, base where f <> 'none' group by f")


@query("permutation_fixed_score", _PERMUTE)
def permutation_fixed_score(spark, sf_dir):
    txn, cuts = split_txn(spark, sf_dir)
    out = D.permutation_importance(lambda df: fixed_score(df, "score"), txn.where(cuts.condition("validation")))
    return rounded(out, 8)


@query("candidate_comparison")
def candidate_comparison(spark, sf_dir):
    """The full protocol: four families with both weightings, the dummy and the forest, on both held-out parts."""
    from txnrisk.plans import training as TR
    from txnrisk.session import stage

    txn, cuts = stored_txn(spark, sf_dir)
    train = txn.where(cuts.condition("train"))
    fitted = fitted_candidates(spark, sf_dir)
    forest = IsolationForest.fit(train, preprocess=TR.scaled_preprocess(fitted))
    anomalies = stage(forest.score(train).select("anomaly_score"), "anomaly-scores")
    cutoff = K.exact_quantiles(anomalies, {"a": (F.col("anomaly_score"), [0.9])})["a"][0]
    prior = float(train.agg(F.avg("label")).first()[0])
    wide = stage(TR.score_wide(fitted, forest, SP.with_split(txn, cuts).where(~cuts.condition("train")), prior), "model-scores")
    return M.compare(TR.long_form(wide), fixed={TR.ANOMALY: cutoff}, models=len(fitted) + 2)


_TREES, _SAMPLE = 250, 256


def isolation_samples_sql(trees: int, sample: int) -> str:
    """CTEs that end in ``k``: rows tried by each tree with their rank; a tree keeps the first ``sample``."""
    return "with " + O.SPLIT + f""", tr as (select txn_id from sp where split = 'train'),
p as (select least(1.0, 3.0 * {sample} / count(*)) as p from tr),
ks as (select unnest(range({trees + 1})) as k),
cdf as (select k, sum(exp(lgamma({trees + 1}) - lgamma(k + 1) - lgamma({trees + 1} - k) + k * ln(p) + ({trees} - k) * ln(1 - p))) over (order by k) as c
  from ks, p where p < 1),
wd as (select w, row_number() over (order by w) - 1 as i from (select unnest(range(1, {trees + 1})) as w) where gcd(w, {trees}) = 1),
r as (select txn_id, {_HASH.format("'tickets-' || txn_id || '-42'")} / cast(1152921504606846976 as double) as u,
  {_HASH.format("'start-' || txn_id || '-42'")} % {trees} as a, {_HASH.format("'width-' || txn_id || '-42'")} % (select count(*) from wd) as i from tr),
n as (select r.txn_id, r.a, wd.w, case when (select p from p) < 1 then (select count(*) from cdf where c <= r.u) else {trees} end as n from r join wd using (i)),
t as (select txn_id, (a + j * w) % {trees} as tree from n, lateral (select unnest(range(least(n, {trees}))) as j)),
k as (select txn_id, tree, row_number() over (partition by tree order by {_HASH.format("'rank-' || txn_id || '-' || tree || '-42'")}, txn_id) as rn from t)"""


@query("iforest_samples", isolation_samples_sql(_TREES, _SAMPLE) + f" select txn_id, cast(tree as int) as tree from k where rn <= {_SAMPLE}")
def iforest_samples(spark, sf_dir):
    """Which rows every isolation tree grows from."""
    from txnrisk.operators.iforest import tree_samples

    train = _parts(spark, sf_dir)[0]
    rows = train.count()
    return tree_samples(train, "txn_id", _TREES, min(_SAMPLE, rows), 42, rows).select("txn_id", "tree")


# ------------------------------------------------------------------------ streaming

PARTS = 4  # arrivals of the event stream, in time order
FILES = 8  # files of one arrival


def arrivals(spark, df: DataFrame, ts: str, key: str) -> tuple[str, int]:
    """``df`` as it would arrive: ``PARTS`` deliveries in time order, one of old rows under new keys, and the last one replayed.

    Spark drops late rows by the watermark of the batch before, so the replay does not follow its original directly.

    Returns the folder's pattern and the files per delivery: a stream that takes so many files at a time reads one delivery per batch.
    """
    from txnrisk.session import working_path

    root = working_path(spark, "arrivals")
    _, cuts = K.times_at(df, ts, [i / PARTS for i in range(1, PARTS)])
    edges = [None, *cuts, None]
    parts = [
        df.where((F.col(ts) >= K.ntz(a) if a else F.lit(True)) & (F.col(ts) < K.ntz(b) if b else F.lit(True))) for a, b in zip(edges, edges[1:])
    ]
    for n, part in enumerate([*parts, parts[0].withColumn(key, -F.col(key) - 1), parts[-1]]):
        # Dealt by key and never merged, so that every delivery has the same number of files.
        part.repartition(FILES, key).write.option("maxRecordsPerFile", 0).parquet(f"{root}/delivery={n}")
    return f"{root}/delivery=*", FILES


@query("stream_dedup", """select event_id as txn_id, user_id as customer_id, value as amount, event_type as device from events""")
def stream_dedup(spark, sf_dir):
    """The event table as a stream with replays and late rows; every transaction once, late ones left out."""
    from txnrisk.session import working_path
    from txnrisk.streaming import jobs as J

    raw = T.table(spark, sf_dir, "events")
    pattern, files = arrivals(spark, raw, "ts", "event_id")
    stream = J.read_stream(spark, pattern, raw.schema, files_per_trigger=files)
    out = working_path(spark, "stream-dedup")
    J.write_table_stream(J.drop_replays(T.as_events(stream), "3 days"), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table").select("txn_id", "customer_id", "amount", "device")


def scored_stream(spark, sf_dir) -> DataFrame:
    """Transactions with gaps as a file stream, scored by the fixed coefficients."""
    from txnrisk.session import working_path
    from txnrisk.streaming import jobs as J

    rows = gappy(T.transactions(spark, sf_dir))
    path = working_path(spark, "stream-input")
    rows.write.parquet(path)
    stream = S.conform(S.quarantine(J.read_stream(spark, path, rows.schema, files_per_trigger=8))[0])
    anomaly = (F.col("txn_id") * 104729 % 1009).cast("double") / 1009
    return S.with_flags(fixed_score(stream).withColumn("anomaly_score", anomaly), 0.3, 0.9)


@query("stream_scores", ORACLES["fixed_coeff_score"])
def stream_scores(spark, sf_dir):
    """The rows of ``fixed_coeff_score``, scored as a stream."""
    from txnrisk.session import working_path
    from txnrisk.streaming import jobs as J

    out = working_path(spark, "stream-scores")
    wanted = scored_stream(spark, sf_dir).select("txn_id", "fraud_score", "predicted_fraud", "anomaly_score", "anomaly_flag", "review_status")
    J.write_table_stream(wanted, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return rounded(spark.read.parquet(f"{out}/table"))


@query("stream_alerts", "with fs as (" + ORACLES["fixed_coeff_score"] + """), """ + O.TXN + """
select 'SIMULATED_ONLY' as status, 'human_review_requested' as action, cast(fs.txn_id as varchar) as transaction_id,
  case when fs.txn_id % 41 <> 0 then amount end as amount, fraud_score, anomaly_flag from fs join txn using (txn_id) where predicted_fraud = 1""")
def stream_alerts(spark, sf_dir):
    """Alert records that the stream of scored rows writes, batch by batch."""
    from txnrisk.session import working_path
    from txnrisk.streaming import jobs as J

    out = working_path(spark, "stream-alerts")
    J.write_alert_stream(scored_stream(spark, sf_dir), f"{out}/alerts", f"{out}/checkpoint").awaitTermination()
    rows = spark.read.schema("status string, action string, transaction_id string, amount double, fraud_score double, anomaly_flag int").json(f"{out}/alerts/*")
    return rounded(rows, skip=("amount",))


@query("stream_trend_closed_days", """with e as (select ts, value, case when cast(json_extract_string(props, '$.k') as int) < 10 then 1 else 0 end as label from events),
d as (select date_trunc('day', ts) as p, count(*) as transactions, cast(sum(label) as bigint) as positives, round(sum(value), 2) as amount,
  round(sum(label) / count(*) * 100, 9) as rate_percent from e group by 1)
select strftime(p, '%Y-%m-%d %H:%M:%S') as period, transactions, positives, amount, rate_percent from d
where p + interval 1 day <= (select max(ts) from e) - interval 2 day""")
def stream_trend_closed_days(spark, sf_dir):
    """The event table as a stream; only days the watermark has closed are emitted."""
    from txnrisk.session import working_path
    from txnrisk.streaming import jobs as J

    raw = T.table(spark, sf_dir, "events")
    pattern, files = arrivals(spark, raw, "ts", "event_id")
    # Replayed and late rows arrive when the watermark has passed their days, all but the last ones, which are not reported.
    stream = J.read_stream(spark, pattern, raw.schema, files_per_trigger=files)
    out = working_path(spark, "stream-trend")
    J.write_table_stream(J.live_trend(T.as_events(stream), "1 day", "2 days"), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{out}/table")
    return rounded(dated(rows.withColumn("amount", F.round("amount", 2)), "period"), skip=("amount",))
