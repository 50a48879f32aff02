import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from txnrisk.functions import coerce as C
from txnrisk.operators import clean as CL
from txnrisk.operators import split as SP
from txnrisk.plans import training as TR
from txnrisk.sources import readers as R
from txnrisk.sources import schema as S
from txnrisk.sources import tables as T
from txnrisk.sources import writers as W

ROW = {
    "Transaction_ID": "T1", "Customer_ID": "C1", "Transaction_Date": "13-02-2023 02:16", "Transaction_Amount": "10.5",
    "Is_International": "0", "Previous_Transactions": "3", "Average_Spend": "20", "Account_Age_Days": "100",
    "Merchant_Category": "Grocery", "Payment_Method": "Card", "Device_Type": "POS", "Location": "Pune",
    "Suspicious_Keyword": "No", "Fraudulent": "0",
}


def feed(spark, rows):
    data = [tuple({**ROW, **r}[c] for c in S.FEED_COLUMNS) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in S.FEED_COLUMNS))


@pytest.mark.parametrize("text,want", [
    ("13-02-2023 02:16", dt.datetime(2023, 2, 13, 2, 16)), ("1-2-2023 2:16", dt.datetime(2023, 2, 1, 2, 16)),
    ("2023-02-13 02:16:05", dt.datetime(2023, 2, 13, 2, 16, 5)), ("2023-02-13T02:16", dt.datetime(2023, 2, 13, 2, 16)),
    ("2023-02-13", dt.datetime(2023, 2, 13)), ("20230213", dt.datetime(2023, 2, 13)), ("2023-02", dt.datetime(2023, 2, 1)),
    (" 13-02-2023 02:16", None), ("31-02-2023 02:16", None), ("not-a-date", None), ("", None), (None, None),
])
def test_event_time(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.event_time(df, "t").alias("t")).first()["t"] == want


def test_event_time_passes_typed_columns(spark):
    df = spark.sql("select timestamp_ntz'2023-02-13 02:16:00' a, timestamp'2023-02-13 02:16:00' b, date'2023-02-13' c")
    row = df.select(*[C.event_time(df, c).alias(c) for c in "abc"]).first()
    assert row["a"] == row["b"] == dt.datetime(2023, 2, 13, 2, 16) and row["c"] == dt.datetime(2023, 2, 13)


@pytest.mark.parametrize("text,rule,want", [
    ("12.5", "amount", 12.5), (" 1 ", "amount", 1.0), ("1e3", "amount", 1000.0), (".5", "amount", 0.5), ("0", "amount", 0.0),
    ("1d", "amount", None), ("1f", "amount", None), ("inf", "amount", None), ("1e999", "amount", None), ("-1", "amount", None),
    ("bad", "amount", None), ("2", "is_intl", None), ("1.0", "is_intl", 1.0), ("3.5", "previous_txns", None), ("3.0", "previous_txns", 3.0),
])
def test_numbers_and_domains(spark, text, rule, want):
    df = spark.createDataFrame([(text,)], f"{rule} string")
    assert C.with_numbers(df, [rule]).first()[rule] == want


def test_non_finite_doubles_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "amount double")
    assert [r["amount"] for r in C.with_numbers(df, ["amount"]).collect()] == [None, None, 2.0]


def test_duplicates_compare_values_not_text(spark):
    rows = feed(spark, [{}, {"Is_International": "0.0"}, {"Transaction_ID": "T2"}, {"Transaction_ID": "T2", "Location": "Delhi"}])
    audit = CL.audit_summary(rows).first()
    assert audit["rows_raw"] == 4 and audit["exact_duplicates_removed"] == 1 and audit["rows_clean"] == 3
    with pytest.raises(ValueError, match="occur more than once"):
        CL.require_unique(CL.clean_rows(rows))


def test_invalid_rows_are_dropped_and_counted(spark):
    rows = feed(spark, [
        {}, {"Transaction_ID": "  "}, {"Transaction_ID": "T3", "Fraudulent": "7"}, {"Transaction_ID": "T4", "Transaction_Date": "x"},
        {"Transaction_ID": "T5", "Customer_ID": None}, {"Transaction_ID": "T6", "Transaction_Amount": "-1"}, {"Transaction_ID": "T7", "Transaction_Amount": None},
    ])
    audit = CL.audit_summary(rows).first()
    assert audit["invalid_key_date_or_label_rows_removed"] == 4 and audit["rows_clean"] == 3
    assert audit["invalid_numeric_cells"]["Transaction_Amount"] == 1
    assert audit["missing_raw"]["Transaction_Amount"] == 1 and audit["missing_clean"]["Transaction_Amount"] == 2
    kept = CL.clean_rows(rows)
    assert kept.columns == list(S.FEED_TO_ENGINE.values())


def test_csv_files_with_other_column_orders(spark, tmp_path):
    order = S.FEED_COLUMNS
    (tmp_path / "a.csv").write_text(",".join(f" {c} " for c in order) + "\n" + ",".join(ROW[c] for c in order) + "\n")
    back = order[::-1]
    (tmp_path / "b.csv").write_text(",".join(back) + "\n" + ",".join({**ROW, "Transaction_ID": "T2", "Transaction_Amount": "NA"}[c] for c in back) + "\n")
    files = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    rows = {r["Transaction_ID"]: r for r in R.read_feed(spark, files).collect()}
    assert rows["T1"].asDict() == ROW
    assert rows["T2"]["Location"] == "Pune" and rows["T2"]["Transaction_Amount"] is None
    with pytest.raises(Exception, match="CSV header does not conform"):
        R.read_feed(spark, str(tmp_path)).collect()


def test_schema_guard(spark, tmp_path):
    with pytest.raises(S.SchemaError, match="lacks these columns"):
        S.check_feed_header(S.FEED_COLUMNS[1:])
    with pytest.raises(S.SchemaError, match="outside the contract"):
        S.check_feed_header([*S.FEED_COLUMNS, "Extra"])


def test_file_digest(spark, tmp_path):
    import hashlib

    (tmp_path / "x.csv").write_bytes(b"abc")
    want = hashlib.sha256(b"abc").hexdigest()
    R.require_digest(spark, str(tmp_path / "x.csv"), want)
    with pytest.raises(ValueError, match="SHA-256 differs"):
        R.require_digest(spark, str(tmp_path / "x.csv"), "0" * 64)


def test_fingerprint_ignores_layout(txn):
    a = CL.fingerprint(txn).first()
    b = CL.fingerprint(txn.select(*txn.columns[::-1]).repartition(7)).first()
    assert a == b
    changed = txn.withColumn("amount", F.when(F.col("txn_id") == txn.agg(F.min("txn_id")).first()[0], 0.0).otherwise(F.col("amount")))
    assert CL.fingerprint(changed).first() != a


def test_clean_table_round_trip(spark, sf, tmp_path):
    clean = CL.clean_rows(R.null_tokens(T.raw_feed(spark, sf)))
    rows = W.write_clean(clean, str(tmp_path / "clean"))
    stored = R.read_clean(spark, str(tmp_path / "clean"))
    assert stored.count() == rows and CL.reconcile(stored).first()["rows"] == rows
    assert CL.fingerprint(stored.drop("txn_month")).first() == CL.fingerprint(clean).first()
    W.write_clean(clean.limit(50), str(tmp_path / "clean"))  # replace, not append
    assert R.read_clean(spark, str(tmp_path / "clean")).count() == 50
    plan = R.read_clean(spark, str(tmp_path / "clean")).where("txn_month = '1998-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_text_export_has_iso_dates(spark, txn, tmp_path):
    W.write_text(txn.limit(3), str(tmp_path / "csv"))
    back = R.read_text_table(spark, str(tmp_path / "csv"))
    assert "Transaction_Date" in back.columns
    assert back.where(F.col("Transaction_Date").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).count() == 3


def test_audit_document(spark, sf, tmp_path):
    raw = R.null_tokens(T.raw_feed(spark, sf))
    clean = CL.clean_rows(raw)
    identity = CL.fingerprint(clean).first().asDict()
    W.write_document(TR.audit_document(CL.typed(CL.distinct_rows(raw)), clean, identity), str(tmp_path / "audit"))
    text = next((tmp_path / "audit").glob("*.json")).read_text()
    doc = json.loads(text)
    assert doc["columns"] == S.FEED_COLUMNS and set(doc["history_caution"]) >= {"account_age_decreases", "previous_txns_decreases"}
    assert doc["data_identity"] == identity and identity["rows"] == doc["rows_clean"]
    assert doc["rows_raw"] > doc["rows_clean"] and doc["invalid_numeric_cells"]["Average_Spend"] == 0


def tiny(spark, times, labels=None):
    rows = [(i, i % 7, t, (i % 2) if labels is None else labels[i]) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "txn_id long, customer_id long, txn_ts timestamp_ntz, label int")


def test_equal_timestamps_move_to_the_later_part(spark):
    base = dt.datetime(2023, 1, 1)
    times = [base + dt.timedelta(minutes=i) for i in range(500)]
    cuts = SP.find_cuts(tiny(spark, times))
    assert [tiny(spark, times).where(cuts.condition(s)).count() for s in SP.SPLITS] == [300, 100, 100]
    times[299] = times[300]
    df = tiny(spark, times)
    cuts = SP.find_cuts(df)
    assert [df.where(cuts.condition(s)).count() for s in SP.SPLITS] == [299, 101, 100]
    SP.check_cuts(df, cuts)


def test_split_guards(spark):
    base = dt.datetime(2023, 1, 1)
    times = [base + dt.timedelta(minutes=i) for i in range(120)]
    few = tiny(spark, times[:50])
    with pytest.raises(ValueError, match="at least 100"):
        SP.check_cuts(few, SP.find_cuts(few))
    flat = tiny(spark, times, [1 if i < 70 and i % 2 else 0 for i in range(120)])
    with pytest.raises(ValueError, match="one class only"):
        SP.check_cuts(flat, SP.find_cuts(flat))


def test_split_predicate_reaches_the_scan(txn, cuts):
    plan = txn.where(cuts.condition("test")).select("amount")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(txn_ts" in plan and "ReadSchema: struct<txn_ts:timestamp_ntz,amount:double>" in plan


def test_join_context_rejects_repeated_keys(txn, cuts):
    scores = txn.select("txn_id", F.lit(0.5).alias("fraud_score"))
    table = SP.assignments(txn, cuts)
    assert SP.join_context(scores, table).count() == txn.count()
    with pytest.raises(ValueError, match="not unique"):
        SP.join_context(scores.unionByName(scores.limit(1)), table)


def test_seen_flag_with_hot_customers(txn, cuts):
    skewed = txn.withColumn("customer_id", F.when(F.col("txn_id") % 3 == 0, -1).otherwise(F.col("customer_id")))
    got = {r["txn_id"]: r["seen"] for r in SP.seen_flag(skewed, cuts).collect()}
    trained = {r[0] for r in skewed.where(cuts.condition("train")).select("customer_id").distinct().collect()}
    assert got == {r["txn_id"]: r["customer_id"] in trained for r in skewed.where(cuts.condition("test")).collect()}


def test_malformed_lines_fail_or_are_put_aside(spark, tmp_path):
    from txnrisk.sources import readers as R
    from txnrisk.sources import schema as SC

    good = ",".join(["T1", "C1", "2024-01-01 10:00:00", "5", "0", "1", "2", "3", "a", "b", "c", "d", "No", "0"])
    lines = [",".join(SC.FEED_COLUMNS), good, good + ",more", "T2,C2", good.replace("T1", "T3")]
    (tmp_path / "feed.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "feed.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        R.read_feed(spark, path).select("Fraudulent").collect()
    rows, bad = R.split_feed(spark, path)
    assert sorted(r["Transaction_ID"] for r in rows.collect()) == ["T1", "T3"] and rows.count() == 2
    assert sorted(r["line"] for r in bad.collect()) == sorted([good + ",more", "T2,C2"])


def test_scored_output_is_read_back_whatever_its_folder_is_called(spark, tmp_path):
    from txnrisk.sources import readers as R
    from txnrisk.sources import writers as W

    df = spark.sql("select 't1' as txn_id, timestamp_ntz'2024-01-01 10:00:00' as txn_ts, 5.0D as amount, 0.9D as fraud_score, 1 as predicted_fraud, 0 as anomaly_flag")
    W.write_text(df, str(tmp_path / "scored"))
    W.write_table(df, str(tmp_path / "table"))
    a, b = (R.read_scored(spark, str(tmp_path / x)).select(*df.columns).collect() for x in ("scored", "table"))
    assert a == b


def test_a_part_delivered_again_replaces_its_own(spark, sf, tmp_path):
    feed = T.raw_feed(spark, sf).withColumn("part", F.substring("Payment_Method", 1, 1))
    path = str(tmp_path / "audit")
    CL.audit_parts(feed.where("part < '3'"), "part", path)
    half = CL.merged_audit(spark, path).first()
    CL.audit_parts(feed.where("part >= '2'"), "part", path)  # part 2 again, whole, with the rest
    whole, want = CL.merged_audit(spark, path).first().asDict(), CL.audit_summary(feed.drop("part")).first().asDict()
    assert half["rows_raw"] < whole["rows_raw"]
    assert set(whole) == set(want)
    for c, x in want.items():
        assert whole[c] == (pytest.approx(x) if isinstance(x, float) else x), c
