"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import discard
from txnrisk.session import working_path

SALTS = 16  # parts over which the links of one node are spread in a join
MAX_ROUNDS = 60


def with_least(links: DataFrame) -> DataFrame:
    """Each link (u, v) with ``m``: the least of u and all its v.

    The minimum is combined before its shuffle.  A node may hold a third of all links, so the join back spreads them
    over ``SALTS`` parts by v, each part having its own copy of the minimum.
    """
    salted = links.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    copies = least.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["u", "s"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v): root is the least node reachable, itself included.

    Rounds of "large" and "small" stars (each node points its larger, then its smaller neighbours to the least one) end when nothing changes;
    their number grows with the logarithm of the longest path.  Each round is written to the shared folder, and the one before it removed.
    """
    spark, path = links.sparkSession, None

    def keep(round_links: DataFrame) -> DataFrame:
        nonlocal path
        last, path = path, working_path(spark, "links")
        round_links.write.parquet(path)
        if last:
            discard(spark, last)
        return spark.read.parquet(path)

    links = keep(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        seen = with_least(large)
        small = seen.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(seen.select("u", F.col("m").alias("v")))
        links = keep(small.distinct())
    raise RuntimeError(f"Components did not settle in {MAX_ROUNDS} rounds.")
