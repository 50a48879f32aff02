"""Distributed building blocks: cumulative sums, order statistics, numbering.

None of these sorts or windows a whole table in one task.  Each works in two
levels: a bounded table of per-bucket totals gives every bucket its starting
value, and the exact work happens inside buckets of bounded size.
"""

from __future__ import annotations

import bisect
import datetime as dt
import math
import struct
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
MIN_BUCKETS = 8     # ranges of even the smallest table: there is one plan for all sizes
SKETCH_BUCKETS = 1024  # ranges one quantile sketch finds; more come from a sketch inside each of these
BROADCAST_ROWS = 200_000  # rows of a few numbers each: a few MB


# --------------------------------------------------------------------------- buckets

def value_bounds(
    df: DataFrame, value: str, groups: list[str] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> list[float]:
    """Inner boundaries that cut ``value`` into ranges of at most about ``rows_per_bucket`` rows, ``MIN_BUCKETS`` at least.

    Boundaries are quantile sketches per group, merged: a cell between two merged
    boundaries holds no more of a group than that group's own cell would.  They
    only balance load, so approximate quantiles do; a value that fills a range by
    itself collapses later, when rows are aggregated by value.  Their number grows with the table without a limit: beyond
    ``SKETCH_BUCKETS`` ranges, each range is sketched again by itself, so no sketch has to be finer than that.
    ``rows`` is the size of the largest group, counted here if not given.
    """
    if rows is None:
        rows = df.groupBy(*(groups or [])).agg(F.count(value).alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-rows // rows_per_bucket))
    coarse = _quantiles(df, value, list(groups or []), min(buckets, SKETCH_BUCKETS))
    if buckets <= SKETCH_BUCKETS:
        return coarse
    ranged = with_bucket(df, value, coarse, "_range")
    return sorted({*coarse, *_quantiles(ranged, value, ["_range", *(groups or [])], -(-buckets // SKETCH_BUCKETS))})


def _quantiles(df: DataFrame, value: str, groups: list[str], buckets: int) -> list[float]:
    probs = [i / buckets for i in range(1, buckets)]
    sketch = F.percentile_approx(value, probs, max(10_000, 10 * buckets))
    found = df.groupBy(*groups).agg(sketch.alias("q")).collect()  # one list per group
    return sorted({float(q) for r in found for q in (r["q"] or [])})


def with_bucket(df: DataFrame, value: str, bounds: list[float], name: str = "_bucket") -> DataFrame:
    """Add the range number of ``value`` (binary search over literal boundaries)."""
    if not bounds:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *bounds, float("inf")]
    return Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)


def portable_hash(*cols: Column) -> Column:
    """60-bit hash of the columns' text that other engines can compute as well."""
    text = F.concat_ws("-", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` only if its proven row bound is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


# ------------------------------------------------------------------- cumulative sums

def cumulate(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    groups: list[str] | None = None,
    bounds: list[float] | None = None,
    descending: bool = True,
    group_limit: int | None = None,
) -> DataFrame:
    """One row per (group, distinct value) with running and total measures.

    For each measure ``m`` the result has ``m`` (of this value), ``cum_m`` (of this
    value and all before it in the order), ``all_m`` (of the group) and ``next_m``
    (of the following value, null at the end).  ``group_limit`` is a proven bound on the
    number of groups; with it the table of cells is broadcast when that is small.
    """
    groups = list(groups or [])
    names = list(measures)
    flat = df.select(*groups, value, *[c.alias(n) for n, c in measures.items()])
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    bounds = list(bounds or [])  # without boundaries there is one range; see value_bounds
    flat = with_bucket(flat, value, bounds)
    # Partial aggregation folds a hot value before anything is shuffled.
    points = flat.groupBy(*groups, "_bucket", value).agg(*[F.sum(n).alias(n) for n in names])

    first = F.max_by if descending else F.min_by
    head = F.struct(*[F.col(n) for n in names])
    cells = points.groupBy(*groups, "_bucket").agg(
        *[F.sum(n).alias(f"_cell_{n}") for n in names], first(head, F.col(value)).alias("_head")
    )
    # Windows over cells: at most (boundaries + 1) rows per group.
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    group_w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    along = group_w.orderBy(order)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *groups,
        "_bucket",
        *[F.coalesce(F.sum(f"_cell_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in names],
        *[F.sum(f"_cell_{n}").over(group_w).alias(f"all_{n}") for n in names],
        F.lead("_head").over(along).alias("_next_head"),
    )
    if group_limit is not None or not groups:
        cells = small(cells, (len(bounds) + 1) * (group_limit or 1))
    joined = points.join(cells, [*groups, "_bucket"])
    inside = Window.partitionBy(*groups, "_bucket").orderBy(by_value)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *groups,
        value,
        *names,
        *[(F.col(f"_base_{n}") + F.sum(n).over(running)).alias(f"cum_{n}") for n in names],
        *[f"all_{n}" for n in names],
        *[F.coalesce(F.lead(n).over(inside), F.col(f"_next_head.{n}")).alias(f"next_{n}") for n in names],
    )


# ------------------------------------------------------------------ order statistics

def _micros_to_time(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


def times_at(df: DataFrame, ts: str, fractions: list[float]) -> tuple[int, list[dt.datetime]]:
    """Row count and the timestamps at 0-based positions ``int(n * f)`` in time order.

    Counts per day, then per second of the wanted days, then per microsecond of the
    wanted seconds: each count table is bounded by the calendar, not by the rows, and
    later steps filter on literals that reach the scan.
    """
    day = F.date_trunc("day", F.col(ts))
    counts = df.groupBy(day.alias("t")).count().where("t is not null").collect()
    days, totals = _running(counts)
    n = totals[-1] if totals else 0
    if n == 0:
        raise ValueError("No rows with a timestamp.")
    wanted = []
    for f in fractions:
        start, rest = _seek(days, totals, int(n * f))
        wanted.append((start, start + dt.timedelta(days=1), rest))

    second = F.date_trunc("second", F.col(ts))
    counts = (
        df.where(_in_any(ts, wanted))
        .groupBy(second.alias("t"))
        .agg(F.count(F.lit(1)).alias("count"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
        .collect()
    )
    result: list[dt.datetime | None] = []
    open_spans = []
    for lo, hi, rest in wanted:
        inside = [r for r in counts if lo <= r["t"] < hi]
        seconds, totals = _running(inside)
        start, rest = _seek(seconds, totals, rest)
        row = next(r for r in inside if r["t"] == start)
        if row["lo"] == row["hi"]:
            result.append(row["lo"])
        else:
            result.append(None)
            open_spans.append((start, start + dt.timedelta(seconds=1), rest))
    if open_spans:
        counts = df.where(_in_any(ts, open_spans)).groupBy(F.col(ts).alias("t")).count().collect()
        answers = []
        for lo, hi, rest in open_spans:
            ticks, totals = _running([r for r in counts if lo <= r["t"] < hi])
            answers.append(_seek(ticks, totals, rest)[0])
        answer = iter(answers)
        result = [next(answer) if t is None else t for t in result]
    return n, result


def _running(rows):
    rows = sorted(rows, key=lambda r: r["t"])
    totals, run = [], 0
    for r in rows:
        run += r["count"]
        totals.append(run)
    return [r["t"] for r in rows], totals


def _seek(keys, totals, position):
    i = bisect.bisect_right(totals, position)
    return keys[i], position - (totals[i - 1] if i else 0)


def _in_any(ts: str, spans) -> Column:
    cond = F.lit(False)
    for lo, hi, _ in spans:
        cond = cond | ((F.col(ts) >= ntz(lo)) & (F.col(ts) < ntz(hi)))
    return cond


def ntz(value: dt.datetime) -> Column:
    """Timestamp literal without time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


@dataclass
class _Bracket:
    """Values lo..hi that hold the row at a 0-based rank; ``below`` rows are smaller than lo, ``inside`` lie in between."""

    lo: float
    hi: float
    below: int
    inside: int
    halve: bool = False  # the sketch did not help last time

    def wide(self, limit: int) -> bool:
        return self.inside > limit and self.lo < self.hi


def _ordinal(x: float) -> int:
    """Number of a double in the order of all doubles."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _halfway(lo: float, hi: float) -> float:
    """A double from lo up to but not including hi that halves the doubles in between: 64 halvings reach any value."""
    mid = (_ordinal(lo) + _ordinal(hi)) // 2
    return struct.unpack("<d", struct.pack("<q", mid if mid >= 0 else -(2**63) - mid))[0]


def _fetch(hits: DataFrame) -> list:
    return hits.collect()


def exact_quantiles(
    df: DataFrame, wanted: dict[str, tuple[Column, list[float]]], collect_limit: int = 20_000, accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of several expressions at once.

    Spark's exact ``percentile`` holds every distinct value in one reducer.  Here each
    wanted rank has a bracket of values.  Rounds narrow the brackets, by a quantile sketch of the values inside or, where that
    does not move the ends, by halving the numbers in between, until a bracket holds at most
    ``collect_limit`` rows or a single value; only then are its values fetched, with counts.  So at most that many
    values per rank reach the driver, whatever the table's size or ties.
    """
    slack = 2.0 / accuracy
    names = list(wanted)
    flat = df.select(*[wanted[n][0].cast("double").alias(n) for n in names])
    first = flat.agg(*[f(n).alias(f"{n}__{k}") for n in names for k, f in (("n", F.count), ("min", F.min), ("max", F.max))]).first()
    size = {n: first[f"{n}__n"] for n in names}
    place = {(n, i): (size[n] - 1) * p for n in names if size[n] for i, p in enumerate(wanted[n][1])}
    ranks = sorted({(n, k) for (n, _), x in place.items() for k in (math.floor(x), math.ceil(x))})
    brackets = {(n, k): _Bracket(first[f"{n}__min"], first[f"{n}__max"], 0, size[n]) for n, k in ranks}

    while wide := {f"r{j}": (n, k, brackets[n, k]) for j, (n, k) in enumerate(ranks) if brackets[n, k].wide(collect_limit)}:
        aggs = []
        for name, (n, k, b) in wide.items():
            share = (k - b.below) / (b.inside - 1)
            inside = F.when(F.col(n).between(b.lo, b.hi), F.col(n))
            aggs.append(F.percentile_approx(inside, [max(0.0, share - slack), min(1.0, share + slack)], accuracy).alias(name))
        sketch = flat.agg(*aggs).first()
        aggs = []
        for name, (n, k, b) in wide.items():
            lo, hi = sketch[name]
            b.halve = b.halve or (lo, hi) == (b.lo, b.hi)
            if b.halve:
                lo, hi = b.lo, _halfway(b.lo, b.hi)
            left = F.col(n).between(lo, hi)
            right = F.col(n) > hi
            aggs += [
                F.count_if(F.col(n) < lo).alias(f"{name}b"), F.count_if(left).alias(f"{name}i"),
                F.min(F.when(left, F.col(n))).alias(f"{name}lo"), F.max(F.when(left, F.col(n))).alias(f"{name}hi"),
                F.min(F.when(right & (F.col(n) <= b.hi), F.col(n))).alias(f"{name}up"),
            ]
        row = flat.agg(*aggs).first()
        for name, (n, k, b) in wide.items():
            below, inside = row[f"{name}b"], row[f"{name}i"]
            if below <= k < below + inside:
                brackets[n, k] = _Bracket(row[f"{name}lo"], row[f"{name}hi"], below, inside)
            elif b.halve:  # the rank lies in the upper half
                brackets[n, k] = _Bracket(row[f"{name}up"], b.hi, below + inside, b.below + b.inside - below - inside)
            else:
                b.halve = True  # the sketch missed the rank

    values: dict[tuple[str, int], list[tuple[float, int]]] = {key: [(b.lo, b.inside)] if b.lo == b.hi else [] for key, b in brackets.items()}
    left = {f"r{j}": key for j, key in enumerate(ranks) if brackets[key].lo < brackets[key].hi}
    if left:
        pieces = F.array(*[
            F.when(F.col(n).between(brackets[n, k].lo, brackets[n, k].hi), F.struct(F.lit(name).alias("task"), F.col(n).alias("v")))
            for name, (n, k) in left.items()
        ])
        hits = flat.select(F.explode(F.array_compact(pieces)).alias("h")).groupBy("h.task", "h.v").count()
        for r in _fetch(hits):
            values[left[r["task"]]].append((r["v"], r["count"]))

    def at(n: str, k: int) -> float:
        return _ranked(sorted(values[n, k]), k - brackets[n, k].below)

    out: dict[str, list[float | None]] = {n: [None] * len(wanted[n][1]) for n in names}
    for (n, i), x in place.items():
        low, high = at(n, math.floor(x)), at(n, math.ceil(x))
        out[n][i] = low + (high - low) * (x - math.floor(x))
    return out


def _ranked(values: list[tuple[float, int]], position: int) -> float:
    for v, c in values:
        if position < c:
            return v
        position -= c
    return values[-1][0]


# ----------------------------------------------------------------------- numbering

def dense_index(
    df: DataFrame, by: Column, tie: list[str], groups: list[str] | None = None, rows: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET, name: str = "idx",
) -> DataFrame:
    """Number the rows of each group 0..n-1 in the order of a hash ``by`` (ties by ``tie``).

    Hash ranges are the buckets, so they are even; their offsets come from a table
    with one row per (group, bucket).
    """
    groups = list(groups or [])
    rows = df.count() if rows is None else rows
    buckets = max(MIN_BUCKETS, -(-rows // rows_per_bucket))
    marked = df.withColumn("_h", by)
    # Top 31 bits, shifted to be non-negative, cut into equal ranges: bucket order is hash order.
    top = F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(-(2**63))), 33)
    marked = marked.withColumn("_b", F.shiftright(top * F.lit(buckets), 31).cast("int"))
    cells = marked.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group_w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = group_w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*groups, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*groups, "_b").orderBy("_h", *tie)
    return (
        marked.join(cells, [*groups, "_b"])
        .withColumn(name, F.col("_base") + F.row_number().over(inside) - 1)
        .drop("_h", "_b", "_base")
    )


# -------------------------------------------------------------------- skewed lookup

HEAVY_ROWS = 1_000_000  # rows of one key that are worth a way of their own
HEAVY_KEYS = 1024       # any other key has less than this part of all rows


def heavy_keys(df: DataFrame, key: str, heavy_rows: int | None = None) -> list:
    """The values of ``key`` with the most rows, if these are many: at most ``HEAVY_KEYS``, counted exactly."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[key] for r in counts.where(F.col("_n") > (HEAVY_ROWS if heavy_rows is None else heavy_rows)).orderBy(F.col("_n").desc(), key).limit(HEAVY_KEYS).collect()]


def lookup(
    left: DataFrame, right: DataFrame, key: str, cols: list[str], rows: int | None = None, heavy_rows: int | None = None, counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with unique ``key`` without gathering a hot key in one task.

    Keys are counted first.  Rows of heavy keys meet those few keys' columns by broadcast and are never shuffled, rows without a key need no partner,
    and all others are joined by key, whose groups are then bounded.  ``rows``: a proven bound on the size of ``right``; a small table is broadcast as it is.
    ``counted``: a table with the same keys as often, if counting them there is cheaper.
    """
    found = right.select(key, *cols)
    out = [*left.columns, *cols]
    if rows is not None and rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(found), key, "left").select(*out)
    heavy = heavy_keys(left if counted is None else counted, key, heavy_rows)
    if not heavy:
        return left.join(found, key, "left").select(*out)
    is_heavy = F.col(key).isin(heavy)
    hot = left.where(is_heavy).join(F.broadcast(found.where(is_heavy)), key, "left").select(*out)
    light = left.where(~is_heavy).join(found.where(~is_heavy), key, "left").select(*out)
    kinds = dict(found.dtypes)
    without = left.where(F.col(key).isNull()).select(*left.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in cols])
    return hot.unionByName(light).unionByName(without)
