"""Queries over sinks and jobs: what files hold after writers and streams have finished."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnrisk.functions import features as FT
from txnrisk.operators import analytics as A
from txnrisk.operators import scoring as S
from txnrisk.operators import split as SP
from txnrisk.plans import oracles as O
from txnrisk.plans import registry as R
from txnrisk.plans.registry import ORACLES, query
from txnrisk.session import working_path
from txnrisk.sources import tables as T
from txnrisk.sources import writers as W
from txnrisk.sources.schema import to_engine_names

# --------------------------------------------------------------------------- sinks

_TEXT_COLUMNS = ["txn_id", "customer_id", "txn_ts", "is_intl", "category", "location", "label"]


@query("text_export", "with " + O.TXN + """ select cast(txn_id as varchar) as txn_id, cast(customer_id as varchar) as customer_id,
  strftime(txn_ts, '%Y-%m-%d %H:%M:%S') as txn_ts, cast(is_intl as varchar) as is_intl, category, location, cast(label as varchar) as label from txn""")
def text_export(spark, sf_dir):
    """Transactions as the text sink writes them, under the feed's headers."""
    path = working_path(spark, "text-export")
    W.write_text(T.transactions(spark, sf_dir).select(*_TEXT_COLUMNS), path)
    return to_engine_names(spark.read.option("header", True).csv(path)).select(*_TEXT_COLUMNS)


@query("alerts_file", ORACLES["alerts_top25"])
def alerts_file(spark, sf_dir):
    """The alert file of the test part: one JSON object per line."""
    path = working_path(spark, "alerts-file")
    rows = R.scored(spark, sf_dir)
    wanted = S.alerts(rows.where(F.col("split") == "test"))
    W.write_alerts(wanted, path)
    return R.rounded(spark.read.schema(wanted.schema).json(path), skip=("amount",))


@query("document_file", ORACLES["filtered_kpis"])
def document_file(spark, sf_dir):
    """A result of one row, written and read as a JSON document."""
    path = working_path(spark, "document-file")
    k = A.kpis(A.filtered(R.scored(spark, sf_dir), **R._FILTER))
    W.write_document(k.withColumns({"rate": F.round("rate", 9), "amount": F.round("amount", 2), "positive_amount": F.round("positive_amount", 2)}), path)
    return spark.read.schema(k.schema).json(path)


@query("table_file", ORACLES["split_assignments"])
def table_file(spark, sf_dir):
    """The split assignments as the training run stores them."""
    path = working_path(spark, "table-file")
    txn, cuts = R.split_txn(spark, sf_dir)
    W.write_table(SP.assignments(txn, cuts), path)
    return R.dated(spark.read.parquet(path), "txn_ts")


@query("month_files", "with " + O.TXN + """ select strftime(txn_ts, '%Y-%m') as txn_month, count(*) as rows, cast(0 as bigint) as out_of_order,
  strftime(min(txn_ts), '%Y-%m-%d %H:%M:%S') as first_ts, strftime(max(txn_ts), '%Y-%m-%d %H:%M:%S') as last_ts from txn group by 1""")
def month_files(spark, sf_dir):
    """The table by month: rows per month, and rows that stand before their predecessor in (time, ID) in any file."""
    path = working_path(spark, "month-files")
    W.write_by_month(T.transactions(spark, sf_dir), path)
    stored = spark.read.parquet(path).select("txn_month", "txn_ts", "txn_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    # Order inside a file, from the rows' own places: a row and its successor share the smaller place.
    pairs = stored.select("*", F.explode(F.array("place", F.col("place") - 1)).alias("step")).groupBy("file", "step").agg(
        F.max_by(F.struct("txn_ts", "txn_id"), "place").alias("later"), F.min_by(F.struct("txn_ts", "txn_id"), "place").alias("earlier"), F.first("txn_month").alias("txn_month"))
    wrong = pairs.groupBy("txn_month").agg(F.count_if(F.col("later") < F.col("earlier")).alias("out_of_order"))
    whole = stored.groupBy("txn_month").agg(F.count(F.lit(1)).alias("rows"), F.min("txn_ts").alias("first_ts"), F.max("txn_ts").alias("last_ts"))
    out = whole.join(wrong, "txn_month").select(F.col("txn_month").cast("string").alias("txn_month"), "rows", "out_of_order", "first_ts", "last_ts")
    return R.dated(out, "first_ts", "last_ts")


# ------------------------------------------------------------------------ variants

@query("features_keyword", "with " + O.TXN + """ select coalesce(nullif(trim(case when txn_id % 47 = 0 then '  ' else ' ' || keyword || ' ' end), ''), 'Unknown') as keyword,
  count(*) as transactions, cast(sum(label) as bigint) as positives from txn group by 1""")
def features_keyword(spark, sf_dir):
    """The keyword input of the diagnostic variant, cleaned and with blanks filled."""
    from txnrisk.operators.preprocess import UNKNOWN

    rows = T.transactions(spark, sf_dir).withColumn("keyword", F.when(F.col("txn_id") % 47 == 0, "  ").otherwise(F.concat(F.lit(" "), "keyword", F.lit(" "))))
    word = F.coalesce(F.expr(FT.feature_sql(include_keyword=True)["keyword"]), F.lit(UNKNOWN))
    return rows.groupBy(word.alias("keyword")).agg(F.count(F.lit(1)).alias("transactions"), F.sum("label").cast("bigint").alias("positives"))


_NAMED = ["category", "location", "customer_id"]


@query("category_numbers", "with " + O.TXN + " " + " union all ".join(
    f"""select '{c}' as "column", value, row_number() over (order by value) - 1 as idx from (select distinct cast({c} as varchar) as value from txn)""" for c in _NAMED))
def category_numbers(spark, sf_dir):
    """The dictionary of some category columns, one of them with very many values."""
    from txnrisk.operators.categories import numbered_values

    return numbered_values(T.transactions(spark, sf_dir), _NAMED, rows_per_range=500)


@query("alerts_without_id", "with " + O.SCORED + """ select count(*) as alerts, count(*) as ids, cast(0 as bigint) as blank_ids,
  cast(coalesce(sum(anomaly_flag), 0) as bigint) as anomalies from scored where split = 'test' and predicted_fraud = 1""")
def alerts_without_id(spark, sf_dir):
    """Alert records of rows that have no ID column: every record gets a name of its own."""
    rows = R.scored(spark, sf_dir).where(F.col("split") == "test")
    named = S.alert_records(rows.drop("txn_id"))
    return named.agg(
        F.count(F.lit(1)).alias("alerts"), F.count_distinct("transaction_id").alias("ids"), F.count_if(F.coalesce(F.trim("transaction_id"), F.lit("")) == "").alias("blank_ids"),
        F.coalesce(F.sum("anomaly_flag"), F.lit(0)).alias("anomalies"))


# ------------------------------------------------------------------------- streams

def _two_sinks(spark, sf_dir) -> str:
    """Transactions with gaps, some without a date, through the stream with two sinks; the folder it wrote."""
    from txnrisk.streaming import jobs as J

    rows = R.gappy(T.transactions(spark, sf_dir)).withColumn("txn_ts", F.when(F.col("txn_id") % 53 != 0, F.col("txn_ts")))
    source, out = working_path(spark, "sinks-input"), working_path(spark, "sinks")
    rows.repartition(8, "txn_id").write.parquet(source)
    anomaly = (F.col("txn_id") * 104729 % 1009).cast("double") / 1009
    score = lambda df: S.with_flags(R.fixed_score(df).withColumn("anomaly_score", anomaly), 0.3, 0.9)
    stream = J.read_stream(spark, source, rows.schema, files_per_trigger=3)
    J.write_scored_and_rejected(stream, score, out, f"{out}/checkpoint").awaitTermination()
    return out


@query("stream_two_sinks", "select * from (" + ORACLES["fixed_coeff_score"] + ") where txn_id % 53 <> 0")
def stream_two_sinks(spark, sf_dir):
    """The scored sink of a stream that also keeps what it rejects."""
    rows = spark.read.parquet(f"{_two_sinks(spark, sf_dir)}/scored")
    return R.rounded(rows.select("txn_id", "fraud_score", "predicted_fraud", "anomaly_score", "anomaly_flag", "review_status"))


@query("stream_rejected", "with " + O.TXN + " select txn_id, 'bad_date' as reasons, label from txn where txn_id % 53 = 0")
def stream_rejected(spark, sf_dir):
    """The rejecting sink of the same stream."""
    rows = spark.read.parquet(f"{_two_sinks(spark, sf_dir)}/rejected")
    return rows.select("txn_id", F.concat_ws(",", "reasons").alias("reasons"), "label")
