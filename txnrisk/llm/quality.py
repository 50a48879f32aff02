"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few dozen numbers (``features``), each number a bin.  The log-odds of label 1 are the sum of one table entry per
feature and one per chosen pair of features.  Tables are learned on the driver from a bounded sample of labelled rows by cyclic
boosting: round after round, each feature in turn gets a shallow tree over its bins, a small step that fits the
present residual; then the pairs with the strongest remaining signal are boosted alike.  Scoring adds up bin entries, for all texts
of a batch at once.

A null text counts as empty and gets a score like any other.  Without labels the score is 0.5; with one class only it is that class's
smoothed share.  Rows with a null label or ID teach nothing; repeated labels count each time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import encoded

MAX_TRAIN_ROWS = 12_000  # labelled rows that reach the driver, as features only
BINS = 48
PAIR_BINS = 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, MIN_LEAF, RIDGE = 0.15, 20, 1.0
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:!?"
_HIGH = bytes(range(128, 256))
_SYMBOLS = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGITS + _STOPS + b"'\"()-")
NAMES = (
    "words", "bytes_per_word", "upper", "lower", "digits", "symbols", "stops", "high", "distinct_words", "top_word", "same_as_before", "lines",
    "words_per_line", "repeated_lines", "short_words", "long_words", "bangs", "bars", "ends_in_stop", "hash_words",
)


def features(text: bytes) -> list[float]:
    """The numbers of one text, in the order of ``NAMES``; all 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    n, size = len(words), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    lengths = list(map(len, words))

    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size

    return [
        float(np.log1p(n)), (size - n + 1) / n, share(_UPPER), share(_LOWER), share(_DIGITS), share(_SYMBOLS), share(_STOPS), share(_HIGH),
        len(counts) / n ** 0.9, max(counts.values()) / n, sum(map(eq, words, words[1:])) / n, float(np.log1p(len(lines))),
        float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines), sum(x <= 3 for x in lengths) / n, sum(x > 14 for x in lengths) / n,
        text.count(b"!") / n, text.count(b"|") / n, sum(w[-1] in b".!?" for w in words) / n, (text.count(b"#") + text.count(b"$") + text.count(b"%")) / n,
    ]


# --------------------------------------------------------------------------- the model

def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles of the distinct values' distribution."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def best_cut(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins (0 bins left: no cut)."""
    g, h, n = np.cumsum(gradient), np.cumsum(weight), np.cumsum(rows)
    with np.errstate(invalid="ignore"):
        gain = g**2 / (h + RIDGE) + (g[-1] - g) ** 2 / (h[-1] - h + RIDGE) - g[-1] ** 2 / (h[-1] + RIDGE)
    gain = np.where((n >= MIN_LEAF) & (n[-1] - n >= MIN_LEAF), gain, 0.0)[:-1]
    if not len(gain) or gain.max() <= 0:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step per bin from a tree of ``depth`` cuts in sequence along the bins."""
    gain, cut = best_cut(gradient, weight, rows) if depth else (0.0, 0)
    if not cut:
        return np.full(len(gradient), gradient.sum() / (weight.sum() + RIDGE))
    return np.concatenate([shallow_tree(gradient[s], weight[s], rows[s], depth - 1) for s in (slice(None, cut), slice(cut, None))])


def pair_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Step per cell: one cut along the better axis, then one along the other axis on either side."""
    best = [best_cut(*(x.sum(axis=1 - a) for x in (gradient, weight, rows))) for a in (0, 1)]
    axis = int(best[1][0] > best[0][0])
    cut = best[axis][1]
    if not cut:
        return np.zeros_like(gradient)
    if axis:
        return pair_tree_cut(gradient.T, weight.T, rows.T, cut).T
    return pair_tree_cut(gradient, weight, rows, cut)


def pair_tree_cut(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, cut: int) -> np.ndarray:
    halves = []
    for s in (slice(None, cut), slice(cut, None)):
        step = shallow_tree(*(x[s].sum(axis=0) for x in (gradient, weight, rows)), depth=1)
        halves.append(np.broadcast_to(step, gradient[s].shape))
    return np.concatenate(halves)


@dataclass
class AdditiveModel:
    """Bin edges and tables; ``pairs`` name the features of each pair table."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], side="right")]
        cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            out += t[cells[a], cells[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on the logistic loss; ``y`` is 0 or 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    model.edges = [edges_of(c, BINS) for c in x.T]
    model.coarse = [edges_of(c, PAIR_BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    odds = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * shallow_tree(np.bincount(bins[j], g, len(t)), np.bincount(bins[j], h, len(t)), rows[j])
            t += step
            odds += step[bins[j]]
    cells = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T)]
    width = [len(e) + 1 for e in model.coarse]

    def grid(a: int, b: int, values: np.ndarray | None) -> np.ndarray:
        return np.bincount(cells[a] * width[b] + cells[b], values, width[a] * width[b]).reshape(width[a], width[b]).astype(float)

    g, h = slopes()

    def strength(pair: tuple[int, int]) -> float:
        step = pair_tree(grid(*pair, g), grid(*pair, h), grid(*pair, None))
        return float((step * grid(*pair, g)).sum())

    able = [p for p in combinations(range(x.shape[1]), 2) if width[p[0]] > 1 and width[p[1]] > 1]
    model.pairs = sorted(able, key=strength, reverse=True)[:PAIRS]
    model.pair_tables = [np.zeros((width[a], width[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), t in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * pair_tree(grid(a, b, g), grid(a, b, h), grid(a, b, None))
            t += step
            odds += step[cells[a], cells[b]]
    return model


# --------------------------------------------------------------------------- Spark

def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([features(t) for t in encoded(texts)], type=pa.list_(pa.float64()))

    return run(text)


def train(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> AdditiveModel:
    """Model from at most ``max_rows`` distinct pairs of ID and label, drawn by a hash of the ID over all of ``labels``.

    Where an ID is repeated, the text with the smallest hash counts, once for each of its labels.  Only the drawn pairs (bounded, so
    they are broadcast) and the features of their texts leave the tables.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    drawn = known.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    texts = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    one = texts.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    found = one.select("id", "y", feature_column(F.col("t")).alias("x")).collect()
    found.sort(key=lambda r: (r["id"], r["y"], r["x"]))  # the fit must not depend on the order of tasks
    x = np.array([r["x"] for r in found]).reshape(len(found), len(NAMES))
    return fit(x, np.array([r["y"] for r in found], float))


def scored(text: Column, model: AdditiveModel) -> Column:
    """Score column, 0 to 1."""
    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in encoded(texts)]).reshape(len(texts), len(NAMES))
        return pa.array(model.score(x))

    return run(text)
