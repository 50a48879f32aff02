"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by tiled exact comparison.

Fingerprint.  A-Z is lower-cased, words are runs of anything but ASCII white space, a shingle is ``SHINGLE`` words joined by blanks
(the whole sequence if there are fewer; repeats count).  A bit is 1 if it is set in over half the shingles'
XXH64 hashes (seed 42).  A text without words, a null text included, has fingerprint 0 and is linked like any other.

Links.  Equal fingerprints are one class from the start.  Two fingerprints within ``RADIUS`` bits agree in at least one of RADIUS + 1
bit ranges, so distinct fingerprints meet in the buckets of their ranges.  In a bucket, tiles of fingerprints sorted by population count
are compared by exclusive-or and bit counts; tiles whose counts differ beyond the radius are never paired.  A bucket above ``TILE`` rows
becomes many pairs of tiles, each a group of its own for some task.  A pair of tiles gives a spanning forest of its links, not all of
them, which is all that components need.

Rows may repeat an ID or lack one.  ``component_id`` is the smallest ID in the component, null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import encoded, free_name, row_key
from txnrisk.llm.components import SALTS, components
from txnrisk.session import stage

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 1024         # fingerprints in a tile
BLOCK = 1 << 16     # shingles whose bits are counted at a time
NEAR = 16           # groups up to this size are compared by offsets, all groups of a batch at once


def fingerprint_bits(text: bytes, shingle: int) -> bytes:
    """The eight bytes of a text's fingerprint, most significant first."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    size = min(shingle, len(words))
    digest, total, n = xxhash.xxh64_digest, np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + size - 1]
        hashes = b"".join([digest(x, SEED) for x in map(b" ".join, zip(*(part[k:] for k in range(size))))])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * total > n).tobytes()


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint as a signed 64-bit number."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        bits = b"".join(fingerprint_bits(t, shingle) for t in encoded(texts))
        return pa.array(np.frombuffer(bits, ">i8").astype(np.int64))

    return run(text)


# --------------------------------------------------------------------------- links

def ranges(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bit ranges that cover 64 bits."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucketed(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """(bucket, pair, side, fp): every distinct fingerprint in its buckets of two or more, dealt to pairs of tiles.

    A bucket of up to ``tile`` rows is the pair (0, 0, 0, 0).  In a larger one a tile is (population count, part), the parts being as many as
    the rows of that count need; a row goes to every pair of its own tile with one within the radius.  Sizes come from counts
    combined before their shuffle; at most 65 per bucket are gathered.
    """
    keys = [F.struct(F.lit(k).alias("band"), F.shiftrightunsigned("fp", a).bitwiseAND((1 << w) - 1).alias("key")) for k, (a, w) in enumerate(ranges(radius))]
    keyed = prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*keys)).alias("bucket"))
    by_ones = keyed.groupBy("bucket", "ones").agg(F.count("*").alias("n"))
    sizes = by_ones.groupBy("bucket").agg(
        F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).alias("parts")))).alias("parts"))
    rows = keyed.join(sizes.where("size > 1"), "bucket")

    def part(ones: Column) -> Column:
        return F.coalesce(F.try_element_at("parts", ones), F.lit(0))

    own = F.struct(F.col("ones").alias("ones"), F.pmod(F.xxhash64("fp"), part(F.col("ones"))).alias("part"))
    others = F.flatten(F.transform(
        F.array(*[F.col("ones") + d for d in range(-radius, radius + 1)]),
        lambda o: F.transform(F.when(part(o) > 0, F.sequence(F.lit(0).cast("long"), part(o) - 1)).otherwise(F.array().cast("array<bigint>")), lambda p: F.struct(o.alias("ones"), p.alias("part"))),
    ))
    pairs = F.transform(others, lambda t: F.struct(F.least(own, t).alias("a"), F.greatest(own, t).alias("b"), (own > t).cast("int").alias("side")))
    none = F.struct(F.lit(0).alias("ones"), F.lit(0).cast("long").alias("part"))
    whole = F.array(F.struct(none.alias("a"), none.alias("b"), F.lit(0).alias("side")))
    dealt = rows.select("bucket", "ones", "fp", F.explode(F.when(F.col("size") <= tile, whole).otherwise(pairs)).alias("pair"))
    return dealt.select(F.xxhash64("bucket", "pair.a", "pair.b").alias("group"), "bucket.band", "bucket.key", F.col("pair.side").alias("side"), "ones", "fp")


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links between fingerprints of two tiles (or within one, if they are the same array)."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if a is not b:
        both = np.concatenate([a, b])
        square = np.zeros((len(both),) * 2, bool)
        square[:len(a), len(a):] = near
        square[len(a):, :len(a)] = near.T
        a, near = both, square
    np.fill_diagonal(near, True)
    label = np.arange(len(a))
    while True:
        least = np.where(near, label[None, :], len(a)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    linked = np.flatnonzero(label != np.arange(len(a)))
    return [(a[linked], a[label[linked]])]


def compare_task(radius: int):
    """Task over rows sorted by group, bucket, side and population count: spanning links of every group.

    Groups are at most two tiles, so what is carried from one batch to the next is bounded.
    """
    def links(columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        group, band, key, side, ones, fp = columns
        if not len(fp):
            return
        new = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(band) != 0) | (np.diff(key) != 0)])
        name = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.concatenate([first, [len(fp)]]))
        few = size[name] <= NEAR
        for d in range(1, NEAR):
            hit = few[:-d] & (name[:-d] == name[d:]) & (np.bitwise_count(fp[:-d] ^ fp[d:]) <= radius)
            yield fp[:-d][hit], fp[d:][hit]
        for at, n in zip(first[size > NEAR].tolist(), size[size > NEAR].tolist()):
            whole, sides = fp[at:at + n], side[at:at + n]
            if sides.any():
                yield from forest(whole[sides == 0], whole[sides == 1], radius)
            else:
                yield from forest(whole, whole, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            found = [*links(columns), (np.zeros(0, np.uint64),) * 2]
            u, v = (np.concatenate(x).view(np.int64) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            columns[5] = columns[5].view(np.uint64)
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
            ends = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0))
            if len(ends):
                cut = ends[-1] + 1
                yield out([c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held is not None:
            yield out(held)
    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): enough links between distinct fingerprints (column ``fp``) to connect all that are within ``radius`` bits of each other."""
    rows = bucketed(prints, radius, tile).repartition("group").sortWithinPartitions("group", "band", "key", "side", "ones")
    return rows.select("group", F.col("band").cast("int"), "key", "side", "ones", "fp").mapInArrow(compare_task(radius), "u long, v long")


def cluster_rows(df: DataFrame, shingle: int, radius: int) -> DataFrame:
    """The columns of ``df`` (with ``doc_id`` and ``text``) but ``text``, with ``fp``, ``component`` (its root's fingerprint) and ``component_id``."""
    others = [c for c in df.columns if c != "text"]
    rows = stage(df.select(*others, fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fp"), radius))
    linked = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    copies = least.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    linked = linked.withColumn("s", F.pmod(F.xxhash64("fp"), F.lit(SALTS))).join(copies, ["root", "s"]).select("fp", "root", "component_id")
    named = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("component"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    # A class may hold a third of all rows.  Both sides are plain scans, so Spark can split such a key at run time.
    return rows.join(stage(named, "component-ids"), "fp")


def cluster(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``fp`` (signed number), ``component_id``."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return cluster_rows(rows, shingle, radius).select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``df`` with one row of each component: the smallest ID, rows without an ID last.

    Rows equal in every column are one document, so one of them stays if any does.
    """
    key = free_name(df, "__key")
    keyed = row_key(df, key, wide=True)
    rows = keyed.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(key).alias("row"), F.col(text).cast("string").alias("text"))
    found = cluster_rows(rows, shingle, radius)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    winners = stage(found.groupBy("component").agg(best.alias("best")).select(F.col("best.row").alias(key)), "winners")
    kept = keyed.join(winners.distinct(), key, "left_semi")
    repeats = found.groupBy(F.col("row").alias(key)).count().where("count > 1").join(winners, key, "left_semi").limit(1).count()
    kept = kept.dropDuplicates([key]) if repeats else kept
    return kept.select(*df.columns)
