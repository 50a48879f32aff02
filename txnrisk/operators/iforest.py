"""Isolation forest (Liu, Ting & Zhou 2008): hash-sampled trees, vectorised scoring.

Samples depend only on row keys and the seed, never on partitioning.  Trees grow from
at most ``sample_size`` rows each; node tables are bounded by trees x sample size, so
they may travel to every executor.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.operators import kernels as K
from txnrisk.operators.preprocess import Preprocess

NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size int, depth int"
TRIED = 3  # a tree left short of rows is an event of odds below 1e-30
EULER = 0.5772156649015329


def average_path(n):
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def tickets(trees: int, share: float) -> list[float]:
    """Cumulative odds that a row is tried by 0, 1, 2, ... of the trees when each takes it with odds ``share``."""
    odds, total, out = (1 - share) ** trees, 0.0, []
    for k in range(trees + 1):
        total += odds
        out.append(total)
        if 1 - total < 1e-13:
            break
        odds *= (trees - k) / (k + 1) * share / (1 - share)
    return out


def tree_samples(df: DataFrame, key: str, trees: int, sample_size: int, seed: int, rows: int) -> DataFrame:
    """(key, tree, rank hash) of ``sample_size`` distinct rows per tree, drawn from all rows at any size.

    Every tree tries about ``TRIED`` times the rows it wants and keeps those of the lowest hashes.  How many trees try a row, and
    which, comes from hashes of its key: in a large table most rows emit nothing.  Hashes are ones other engines can compute.
    """
    share = min(1.0, TRIED * sample_size / max(1, rows))
    if share == 1.0:
        picks = F.sequence(F.lit(0), F.lit(trees - 1))
    else:
        chance = K.portable_hash(F.lit("tickets"), F.col(key), F.lit(seed)) / float(2**60)
        odds = tickets(trees, share)
        count = F.size(F.filter(F.array(*[F.lit(c) for c in odds]), lambda c: c <= chance))
        # Distinct trees: steps of a hashed width, coprime to their number, from a hashed start.
        widths = [w for w in range(1, trees + 1) if math.gcd(w, trees) == 1]
        start = F.pmod(K.portable_hash(F.lit("start"), F.col(key), F.lit(seed)), F.lit(trees))
        width = F.element_at(F.array(*[F.lit(w) for w in widths]), (F.pmod(K.portable_hash(F.lit("width"), F.col(key), F.lit(seed)), F.lit(len(widths))) + 1).cast("int"))
        steps = F.when(count > 0, F.sequence(F.lit(0), F.least(count, F.lit(trees)) - 1)).otherwise(F.array().cast("array<int>"))
        picks = F.transform(steps, lambda i: F.pmod(start + i * width, F.lit(trees)).cast("int"))
    tried = df.select(key, F.explode(picks).alias("tree")).withColumn("_h", K.portable_hash(F.lit("rank"), F.col(key), F.col("tree"), F.lit(seed)))
    order = Window.partitionBy("tree").orderBy("_h", key)  # about TRIED x sample_size rows each
    return tried.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample_size).drop("_rank")


def draw(purpose: str, tree: int, place: int, seed: int) -> int:
    """60-bit number of a node, which other engines can compute: ``place`` is 1 for the root, 2p and 2p + 1 for the children of p."""
    return int(hashlib.md5(f"{purpose}-{tree}-{place}-{seed}".encode()).hexdigest()[:15], 16)


def grow(x: np.ndarray, tree: int, seed: int, max_depth: int) -> list[tuple]:
    """Node rows of one tree: at every node a random non-constant feature and a uniform split point, both hashes of the node's place."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, None, 0, 1)]
    while todo:
        rows, depth, parent, side, place = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][4 if side == 0 else 5] = me
        nodes.append([tree, me, -1, 0.0, me, me, len(rows), depth])
        if depth >= max_depth or len(rows) <= 1:
            continue
        part = x[rows]
        lo, hi = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(hi > lo)
        if not len(open_features):
            continue
        f = int(open_features[draw("feature", tree, place, seed) % len(open_features)])
        split = float(lo[f] + (hi[f] - lo[f]) * (draw("split", tree, place, seed) / 2**60))
        if split >= hi[f]:
            split = float(lo[f])
        nodes[me][2], nodes[me][3] = f, split
        goes_left = part[:, f] <= split
        todo.append((rows[~goes_left], depth + 1, me, 1, 2 * place + 1))
        todo.append((rows[goes_left], depth + 1, me, 0, 2 * place))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForest:
    """Preprocessing plus the node table; ``score`` is higher for more unusual rows."""

    preprocess: PipelineModel
    nodes: pd.DataFrame
    sample_size: int

    @classmethod
    def fit(
        cls, train: DataFrame, key: str = "txn_id", trees: int = 250, sample_size: int = 256, seed: int = 42,
        preprocess: PipelineModel | None = None,
    ) -> "IsolationForest":
        """Unlabelled fit: labels are never read."""
        ready = preprocess or Preprocess(scale=True).fit(train)
        rows = train.count()
        size = min(sample_size, rows)
        depth = math.ceil(math.log2(max(size, 2)))
        picked = tree_samples(train, key, trees, size, seed, rows)
        vectors = ready.transform(train.join(K.small(picked.select(key).distinct(), trees * size), key, "left_semi")).select(
            key, vector_to_array("features").alias("x")
        )
        samples = picked.join(vectors, key)

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            pdf = pdf.sort_values(["_h", key])
            return pd.DataFrame(
                grow(np.vstack(pdf["x"].to_numpy()), tree, seed, depth),
                columns=["tree", "node", "feature", "split", "left", "right", "size", "depth"],
            )

        nodes = samples.groupBy("tree").applyInPandas(build, NODE_SCHEMA)
        # Bounded fetch: at most trees * (2 * sample_size - 1) rows of eight numbers.
        return cls(ready, nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True), size)

    def arrays(self) -> dict:
        """Flat node arrays; children are global positions, a leaf points to itself."""
        n = self.nodes
        start = n.groupby("tree")["node"].transform("size").groupby(n["tree"]).first().cumsum()
        offset = n["tree"].map(start.shift(fill_value=0)).to_numpy()
        leaf = n["feature"].to_numpy() < 0
        return {
            "feature": np.where(leaf, 0, n["feature"]).astype(np.int64),
            "split": n["split"].to_numpy(float),
            "left": (n["left"].to_numpy() + offset).astype(np.int64),
            "right": (n["right"].to_numpy() + offset).astype(np.int64),
            "path": np.where(leaf, n["depth"].to_numpy() + average_path(n["size"].to_numpy()), 0.0),
            "roots": np.flatnonzero(n["node"].to_numpy() == 0).astype(np.int64),
            "depth": int(n["depth"].max()),
            "scale": float(average_path(self.sample_size)),
        }

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """All columns of ``df`` plus the anomaly score."""
        shared = df.sparkSession.sparkContext.broadcast(self.arrays())

        @F.pandas_udf("double")
        def anomaly(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(score_matrix(np.vstack(x.to_numpy()), shared.value))

        out = self.preprocess.transform(df)
        return out.select(
            *[F.col(f"`{c}`") for c in df.columns if c != name], anomaly(vector_to_array("features")).alias(name)
        )

    def save(self, spark, path: str) -> None:
        self.preprocess.write().overwrite().save(f"{path}/preprocess")
        spark.createDataFrame(self.nodes.assign(sample_size=self.sample_size), NODE_SCHEMA + ", sample_size int").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForest":
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
        return cls(PipelineModel.load(f"{path}/preprocess"), nodes.drop(columns="sample_size"), int(nodes["sample_size"].iloc[0]))


def score_matrix(x: np.ndarray, a: dict, chunk: int = 512) -> np.ndarray:
    """Scores of a dense matrix: all trees descend one level per step."""
    out = np.empty(len(x))
    width = x.shape[1]
    for at in range(0, len(x), chunk):
        part = np.ascontiguousarray(x[at:at + chunk])
        flat, base = part.ravel(), (np.arange(len(part)) * width)[:, None]
        node = np.broadcast_to(a["roots"], (len(part), len(a["roots"]))).copy()
        for _ in range(a["depth"]):
            value = flat.take(base + a["feature"].take(node))
            node = np.where(value <= a["split"].take(node), a["left"].take(node), a["right"].take(node))
        out[at:at + chunk] = a["path"].take(node).mean(axis=1)
    return np.power(2.0, -out / a["scale"]) if a["scale"] else np.full(len(x), 0.5)
