"""Transaction views over the star-schema test tables.

``transactions``  clean typed transactions (orders x customer x nation)
``events``        the event stream as transactions
``raw_feed``      the same transactions as dirty text with the feed's headers
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    odds = (
        F.lit(30)
        + F.when(F.col("o_orderpriority") == "1-URGENT", 150).otherwise(0)
        + F.when(F.col("c_mktsegment") == "MACHINERY", 80).otherwise(0)
        + F.when(F.col("o_totalprice") > 400000, 100).otherwise(0)
    )
    # Customer and nation are joined without hints: Spark broadcasts them only
    # while their files are below its size limit.
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return joined.select(
        key.alias("txn_id"),
        cust.alias("customer_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (key * 37 % 1440).cast("int"), F.lit(0))).alias("txn_ts"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("n_regionkey") != key % 5, 0).otherwise(1).cast("int").alias("is_intl"),
        (key * 13 % 50).cast("double").alias("previous_txns"),
        (50 + cust * 17 % 400).cast("double").alias("average_spend"),
        (key * 29 % 2000).cast("double").alias("account_age_days"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_orderpriority").alias("method"),
        F.col("o_orderstatus").alias("device"),
        F.col("n_name").alias("location"),
        F.when(key * 31 % 10 == 0, "Yes").otherwise("No").alias("keyword"),
        F.when((key * 7919 + cust * 104729) % 1000 < odds, 1).otherwise(0).cast("int").alias("label"),
        ((key * 7919 + cust * 31) % 997).cast("double").alias("_mix"),
    ).select("*", (F.col("_mix") / 997).alias("pseudo_score")).drop("_mix")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def as_events(raw: DataFrame) -> DataFrame:
    """Event rows (batch or stream) as transactions."""
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("txn_ts"),
        F.col("value").alias("amount"),
        F.concat(F.lit("K"), (k % 4).cast("string")).alias("method"),
        F.col("event_type").alias("device"),
        F.when(k < 10, 1).otherwise(0).cast("int").alias("label"),
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted dirt: blanks, bad dates, bad numbers, a bad flag, bad labels, copies."""
    t, k = transactions(spark, sf_dir), F.col("txn_id")

    def whole(name: str):
        return F.col(name).cast("bigint").cast("string")

    feed = t.select(
        F.when(k % 997 == 0, "   ").otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("Transaction_ID"),
        F.concat(F.lit("C"), F.col("customer_id").cast("string")).alias("Customer_ID"),
        F.when(k % 501 == 0, "not-a-date")
        .when(k % 3 == 0, F.date_format("txn_ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("txn_ts", "dd-MM-yyyy HH:mm"))
        .alias("Transaction_Date"),
        F.when(k % 401 == 0, "-1").when(k % 403 == 0, "bad").when(k % 409 == 0, "")
        .otherwise(F.col("amount").cast("string")).alias("Transaction_Amount"),
        F.when(k % 307 == 0, "2").otherwise(F.col("is_intl").cast("string")).alias("Is_International"),
        F.when(k % 211 == 0, "3.5").otherwise(whole("previous_txns")).alias("Previous_Transactions"),
        whole("average_spend").alias("Average_Spend"),
        whole("account_age_days").alias("Account_Age_Days"),
        F.when(k % 89 == 0, "")
        .when(k % 5 == 0, F.concat(F.lit("  "), F.col("category"), F.lit(" ")))
        .otherwise(F.col("category")).alias("Merchant_Category"),
        F.col("method").alias("Payment_Method"),
        F.col("device").alias("Device_Type"),
        F.col("location").alias("Location"),
        F.col("keyword").alias("Suspicious_Keyword"),
        F.when(k % 701 == 0, "7").otherwise(F.col("label").cast("string")).alias("Fraudulent"),
        F.when(k % 50 == 0, 2).otherwise(1).alias("_copies"),
    )
    # One pass: every 50th row is emitted twice instead of scanning again for a union.
    return feed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")
