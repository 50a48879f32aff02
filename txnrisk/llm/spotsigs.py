"""Document fingerprints: SpotSigs, chains of content words behind common-word anchors.

The text is lower-cased and read as words (runs of letters).  Anchors are common words, that is, those of up to ``ANCHOR_LETTERS`` letters
and those in ``LONGER_ANCHORS``, and the starts of lines.  All other words are content words.  Each run of anchors that a content word follows gives one
signature: the next two content words (the end of the text may take the second place), with a mark if an anchor lies between them.  A fingerprint is
the sorted set of the signatures' 32-bit hashes, so equal texts have equal fingerprints.  Likeness is the Jaccard similarity of two sets; two
empty sets (texts without letters, null included) are alike.

Near-duplicates (``similar_pairs``): equal sets are one class; classes are partitioned by set length, so that only lengths which can reach the
threshold meet, by a prefix of the sorted set, one element of which any such pair shares; candidates whose lengths rule the threshold out are
pruned before the sets are intersected.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.operators.kernels import small, value_bounds, with_bucket

THRESHOLD = 0.8
ANCHOR_LETTERS = 2
MIN_RANGES = 128         # ranges of neighbouring documents, each ordered by one task
RANGE_BYTES = 256 << 20  # text of a range where there are more
# Frequent function words of more than two letters.
LONGER_ANCHORS = (
    "the and for are was not you all but can had her his one our out has who its she him how may "
    "der die das den dem des ein und mit von bei aus auf als ist war für sie ich wie nur "
    "les des une est sur par qui que pas aux ses son mes "
    "los las del una con por que sus más "
    "that with this from have they were been their which would there than then them these will into your "
    "nicht auch sich eine einer einem einen wird sind oder aber nach beim "
    "avec dans pour sont cette plus mais comme elle elles nous vous "
    "para como pero este esta esto ellos ellas entre sobre desde"
).split()
MARK = "•"


def signatures(text: Column) -> Column:
    """Sorted set of signature hashes of a text column (null counts as empty)."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\n]+", " ")
    spaced = F.concat(F.lit(" \n "), F.regexp_replace(words, r" ?\n[ \n]*", " \n "), F.lit(" "))
    spaced = F.regexp_replace(spaced, " {2,}", " ")
    # Possessive: a greedy group would recurse once per anchor and overflow the stack on a long run of them.
    anchor = rf"(?: (?:\n|\p{{L}}{{1,{ANCHOR_LETTERS}}}|{'|'.join(LONGER_ANCHORS)})(?= ))++ "
    marked = F.regexp_replace(spaced, anchor, f" {MARK}")
    chains = F.regexp_extract_all(marked, F.lit(rf"{MARK}(?=(\p{{L}}+ {MARK}?(?:\p{{L}}+|$)))"), F.lit(1))
    return F.sort_array(F.array_distinct(F.transform(chains, lambda c: F.hash(c))))


def as_text(prints: Column) -> Column:
    """Fingerprint as text: its numbers in ascending order."""
    return F.concat_ws(" ", prints.cast("array<string>"))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without intersecting the sets if their lengths alone keep it below ``at_least``."""
    na, nb = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    value = F.when((na == 0) & (nb == 0), F.lit(1.0)).otherwise(both / (na + nb - both).cast("double"))
    return F.when(F.least(na, nb) < at_least * F.greatest(na, nb), F.lit(0.0)).otherwise(value)


def similar_pairs(df: DataFrame, prints: str = "prints", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of classes ``a`` < ``b`` with ``likeness`` >= threshold, and each document's class ``class_id``.

    A class is a distinct set, named by its smallest document.
    """
    classes = df.groupBy(F.col(prints).alias("prints")).agg(F.min(doc_id).alias("class_id")).where("class_id is not null")
    members = df.select(F.col(doc_id).alias("doc_id"), F.col(prints).alias("prints")).join(classes, "prints").select("doc_id", "class_id")
    n = F.size("prints")
    band = F.floor(F.log(n.cast("double")) / math.log(1 / threshold)).cast("int")  # partners lie in the same or a neighbouring band
    prefix = F.slice("prints", 1, n - F.ceil(n * threshold).cast("int") + 1)
    filled = classes.where(n > 0).withColumn("band", band)
    keyed = filled.select("class_id", "prints", F.col("band"), F.explode(prefix).alias("token"))
    near = keyed.select(F.col("class_id").alias("other"), F.col("prints").alias("other_prints"), "token", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    a, b = F.col("prints"), F.col("other_prints")
    met = keyed.join(near, ["token", "band"]).where((F.col("class_id") != F.col("other")) & (F.least(F.size(a), F.size(b)) >= threshold * F.greatest(F.size(a), F.size(b))))
    pairs = met.select(F.least("class_id", "other").alias("a"), F.greatest("class_id", "other").alias("b"), likeness(a, b, threshold).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold).distinct(), members


def with_next(df: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """``doc_id``, ``text`` and the ``carried`` columns (made from ``text``) of ``df``, each with ``next_<c>`` of the next row in descending ID.

    After the last row comes the first.  Rows without an ID come last; ties go by a hash of the text, then the text.  The order is cut into
    ``MIN_RANGES`` ranges, or more of about ``RANGE_BYTES`` of text, by quantiles of the IDs (and by hash ranges for rows without one).  The
    first row of every range is copied behind the last row of the range before it, so that a window inside ranges sees every
    neighbour.  The table of first rows, one per range, is broadcast while it is small, and joined otherwise.
    """
    size, count = df.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    ranges = max(MIN_RANGES, math.ceil((size or 0) / RANGE_BYTES))
    numbered = df.withColumn("__id", F.col("doc_id").cast("double"))
    bounds = value_bounds(numbered.select("__id"), "__id", rows_per_bucket=-(-count // ranges), rows=count) if count else []
    placed = with_bucket(numbered, "__id", bounds, "__bucket")
    spread = F.xxhash64(F.coalesce("text", F.lit("")))
    placed = placed.select(
        "doc_id", "text", spread.alias("__h"), F.col("doc_id").isNull().alias("__none"), F.expr("~doc_id").alias("__down"),
        F.when(F.col("doc_id").isNotNull(), -F.col("__bucket").cast("long")).otherwise(F.shiftright(spread, 58) + 33).alias("__range"),
    )
    order = ["__none", "__down", "__h"]
    heads = placed.groupBy("__range").agg(F.min(F.struct(*order)).alias("__first"))
    # One row per range: ordering them is small work, and the range before the first is the last.
    along = Window.orderBy("__range")
    behind = heads.withColumn("__before", F.coalesce(F.lag("__range").over(along), F.max("__range").over(Window.partitionBy())))
    firsts = behind.select(F.struct(*[F.coalesce(F.col("__first")[c], F.lit(0) if c == "__down" else F.col("__first")[c]).alias(c) for c in order]).alias("__key"), "__before")
    own = F.struct("__none", F.coalesce("__down", F.lit(0)).alias("__down"), "__h")
    copies = placed.withColumn("__key", own).join(small(firsts, ranges + 64), "__key").select("doc_id", "text", *order, F.col("__before").alias("__range"), F.lit(1).alias("__copy"))
    both = placed.select("doc_id", "text", *order, "__range", F.lit(0).alias("__copy")).unionByName(copies).withColumns(carried)
    inside = Window.partitionBy("__range").orderBy("__copy", F.col("__none"), F.col("__down"), "__h", "text")
    ahead = both.select("*", *[F.lead(c).over(inside).alias(f"next_{c}") for c in ("text", *carried)])
    return ahead.where("__copy = 0").select("doc_id", "text", *carried, *[f"next_{c}" for c in ("text", *carried)])


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third (code points, rounded down) replaced by the first as many of ``following``."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(text.substr(F.lit(1), n - third), following.substr(F.lit(1), third))
