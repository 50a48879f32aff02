"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in ``BLOCKS`` source blocks (a hash of the row's identity).  From the block sizes alone the driver draws how many
rows of each block go to each shard: one exact hypergeometric draw after the other, which is how many a uniform
permutation of all rows would send there.  Each block permutes its rows and cuts them at those counts; rows are
exchanged; each shard permutes what it got.  Shard sizes are exact by construction, at most one apart.

Only DataFrame functions touch rows.  The matrix has ``BLOCKS`` x shards numbers whatever the data.  A block or a shard is never one task's burden for
numbering: a shard is numbered in ``PARTS`` slices of its random order, each starting where the counts of those before it
end.  All random numbers are hashes of identity and seed, so a task that runs again deals the same; rows that agree in every identity column are
interchangeable.  Null values are values like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.session import stage

BLOCKS = 512
PARTS = 32  # slices of a shard's random order: a power of two
SHARDS = 40


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items are good, exactly: inversion of the distribution, from its mode outwards."""
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    peak = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    left = rng.random() - peak
    below = above = mode
    p_below = p_above = peak
    while left > 0 and (below > low or above < high):
        if above < high:
            p_above *= (good - above) * (drawn - above) / ((above + 1) * (bad - drawn + above + 1))
            above += 1
            left -= p_above
            if left <= 0:
                return above
        if below > low:
            p_below *= below * (bad - drawn + below) / ((good - below + 1) * (drawn - below + 1))
            below -= 1
            left -= p_below
            if left <= 0:
                return below
    return mode


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of block i that go to shard j; columns sum to shard sizes that are at most one apart."""
    rng, total = random.Random(seed), sum(sizes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for size in sizes:
        row, rest, free = [], size, sum(room)
        for s in range(shards):
            free -= room[s]
            take = hypergeometric(rng, room[s], free, rest)
            room[s] -= take
            rest -= take
            row.append(take)
        matrix.append(row)
    return matrix


def numbers(values: list[int]) -> Column:
    """A constant array of many numbers as one small literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def assign(df: DataFrame, identity: list[str], shards: int = SHARDS, seed: int = 42, blocks: int = BLOCKS) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within the shard); columns of these names are replaced.

    ``identity``: the columns whose values tell rows apart.
    """
    own = [c for c in df.columns if c not in ("shard", "slot")]
    key = F.xxhash64(F.lit(seed), *[F.col(c) for c in identity])
    rows = df.withColumn("__key", key).withColumn("__block", F.pmod(F.xxhash64(F.lit(1), "__key"), F.lit(blocks)).cast("int"))
    rows = rows.select(*own, "__key", "__block")
    counted = {r["__block"]: r["count"] for r in rows.groupBy("__block").count().collect()}  # at most `blocks` rows
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)
    ends = [sum(row[: s + 1]) for row in matrix for s in range(shards)]
    first = Window.partitionBy("__block").orderBy(F.xxhash64(F.lit(2), "__key"), "__key", *identity)
    place = (F.row_number().over(first) - 1).cast("bigint")
    mine = F.slice(numbers(ends), F.col("__block") * shards + 1, F.lit(shards))
    dealt = rows.withColumn("__place", place).withColumn("shard", F.size(F.filter(mine, lambda e: e <= F.col("__place"))))
    again = F.xxhash64(F.lit(3), "__key")
    part = F.shiftrightunsigned(again, 64 - PARTS.bit_length() + 1)
    dealt = stage(dealt.select(*own, "shard", again.alias("__order"), part.cast("int").alias("__part")), "sharded")
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "__part").count().withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    second = Window.partitionBy("shard", "__part").orderBy("__order", *identity)
    slots = dealt.withColumn("__place", F.row_number().over(second) - 1).join(F.broadcast(starts), ["shard", "__part"])  # shards x PARTS rows
    return slots.select(*own, "shard", (F.col("__start") + F.col("__place")).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard of a table from ``assign``, rows in slot order inside each file."""
    parts = F.pmod(F.col("slot"), F.lit(1 << 20))  # a large shard is written by several tasks
    df.repartition("shard", F.floor(parts / 65536)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
