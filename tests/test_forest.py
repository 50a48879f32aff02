import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from txnrisk.operators import boosting as B
from txnrisk.operators import forest as RF
from txnrisk.operators import models as MD


def plain_tree(x, y, times, balanced, tree, forest, width):
    """Prediction for every row from one tree grown by direct sums, and the number of its leaves."""
    drawn = times > 0
    n = [times[y == c].sum() for c in (0, 1)]
    class_weight = [sum(n) / (2 * k) for k in n] if balanced else [1.0, 1.0]
    w = times * np.where(y == 1, class_weight[1], class_weight[0])
    out, leaves = np.zeros(len(y)), [0]

    def gini(rows):
        return w[rows & (y == 1)].sum() ** 2 / w[rows].sum()

    def grow(rows, place):
        mine = rows & drawn
        share = w[mine & (y == 1)].sum() / w[mine].sum()
        found = None
        if place.bit_length() <= forest.depth and mine.sum() >= 2 * forest.min_rows and 0 < share < 1:
            order = RF.feature_order(width, forest.seed, tree, place)
            for k, j in enumerate(order):
                if k >= forest.few(width) and found:
                    break
                for v in np.unique(x[:, j])[:-1]:
                    low, high = mine & (x[:, j] <= v), mine & (x[:, j] > v)
                    if min(low.sum(), high.sum()) >= forest.min_rows:
                        gain = gini(low) + gini(high) - gini(mine)
                        if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                            found = (gain, j, v)
        if not found:
            out[rows] = share
            leaves[0] += 1
            return
        _, j, v = found
        grow(rows & (x[:, j] <= v), 2 * place)
        grow(rows & (x[:, j] > v), 2 * place + 1)

    grow(np.ones(len(y), bool), 1)
    return out, leaves[0]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    n = 500
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 11, n), rng.integers(0, 2, n), np.ones(n), rng.integers(0, 40, n)], axis=1).astype(float)
    y = (rng.random(n) < 0.08 + 0.4 * (x[:, 0] > 3) * (x[:, 1] > 5)).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(n)], "txn_id long, x array<double>, label double")
    return x, y, df.withColumn("features", array_to_vector("x")).repartition(3)


@pytest.mark.parametrize("local", [1 << 16, 60, 0])
@pytest.mark.parametrize("balanced", [False, True])
def test_equals_plain_version(monkeypatch, table, local, balanced):
    monkeypatch.setattr(RF, "LOCAL_ROWS", local)
    monkeypatch.setattr(RF, "BLOCK_ROWS", 90)
    monkeypatch.setattr(RF, "MAX_CELLS", 5 * 256 * 3)
    x, y, df = table
    forest = RF.HistogramForest(trees=4, depth=5, min_rows=8, balanced=balanced)
    model = forest.fit(df)
    keys = {r["txn_id"]: r["k"] for r in df.select("txn_id", RF.row_key(df).alias("k")).collect()}
    key = np.array([keys[i] for i in range(len(y))])
    want = [plain_tree(x, y, RF.draws(key, t, 42), balanced, t, forest, 5) for t in range(4)]
    got = [r[0] for r in model.transform(df).orderBy("txn_id").select("prediction").collect()]
    assert got == pytest.approx(np.mean([p for p, _ in want], axis=0).tolist(), abs=1e-7)
    assert [(t.numNodes + 1) // 2 for t in model.trees] == [n for _, n in want]


def test_sums_are_of_drawn_features_only(monkeypatch, table):
    """A pass sums the features that a node draws; the others follow for nodes that these do not split."""
    monkeypatch.setattr(RF, "LOCAL_ROWS", 0)
    passes, sums = [], RF.HistogramForest.sums
    monkeypatch.setattr(RF.HistogramForest, "sums", lambda self, blocks, width, trees, features, *more: passes.append(features) or sums(self, blocks, width, trees, features, *more))
    forest = RF.HistogramForest(trees=3, depth=3)
    forest.fit(table[2])
    sizes = [{len(f) for f in p.values()} for p in passes]
    assert sizes[0] == {2} and set().union(*sizes) <= {2, 3}
    first = set()
    for p in passes:
        assert all((k in first) == (len(f) == 3) for k, f in p.items())
        first |= set(p)


def test_driver_keeps_no_record_of_settled_nodes(monkeypatch, table):
    """Nodes of subtrees grown by tasks live in the driver as entries of their trees only."""
    made = []
    monkeypatch.setattr(RF, "Leaf", lambda *sums: made.append(1) or B.Leaf(*sums))
    _, trees = RF.HistogramForest(trees=4, depth=5).grow(table[2])
    assert sum(len(t.left) for t in trees) > 8 and len(made) == 4


def test_draws_are_poisson_and_follow_whole_numbers():
    rng = np.random.default_rng(1)
    key = rng.integers(0, 1 << 60, 200_000)
    times = RF.draws(key, 3, 42)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.005
    factor = RF.tree_factor(3, 42)
    assert [sum(((int(k) * factor) % 2**64 >> 32) >= d for d in RF.DRAWS) for k in key[:500]] == times[:500].tolist()
    assert abs(np.corrcoef(times, RF.draws(key, 4, 42))[0, 1]) < 0.01


def test_classes_weigh_the_same_within_each_sample(table):
    _, _, df = table
    sums = RF.bootstrap_weights(df.select("txn_id", F.col("label").cast("int").alias("label")), 6).groupBy("tree").pivot("label", [0, 1]).agg(F.sum("weight")).collect()
    assert len(sums) == 6 and all(r["0"] == pytest.approx(r["1"]) for r in sums)


def test_candidates_balance_per_sample(monkeypatch, parts):
    monkeypatch.setattr(MD, "forest", lambda rows: RF.HistogramForest(trees=5, depth=4))
    seen = []
    monkeypatch.setattr(RF.HistogramForest, "fit", lambda self, df: seen.append((self.balanced, df.columns)) or RF.stored_ensemble(df.sparkSession, "forest", *RF.HistogramForest.grow(self, df)[::-1]))
    model = MD.fit_candidate(parts["train"], MD.Candidate(MD.forest, balanced=True))
    assert seen[0][0] is True and RF.KEY in seen[0][1] and MD.WEIGHT not in seen[0][1]
    scores = MD.score(model, parts["test"], "score").agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] < scores[1] <= 1


def test_large_and_small_nodes_share_a_pass(monkeypatch, table):
    """Sums of large nodes and rows of small ones come from one pass over the blocks."""
    monkeypatch.setattr(RF, "LOCAL_ROWS", 150)
    df, passes, shared, sums, run = table[2], [], [], RF.HistogramForest.sums, type(table[2]).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: passes.append(1) or run(self, *a, **k))

    def counted(self, blocks, sizes, trees, features, weights, scale, few, known, together):
        before = len(passes)
        out = sums(self, blocks, sizes, trees, features, weights, scale, few, known, together)
        shared.append(bool(features) and bool(few))
        assert len(passes) - before == 1 and not set(features) & set(few)
        return out

    monkeypatch.setattr(RF.HistogramForest, "sums", counted)
    RF.HistogramForest(trees=6, depth=4).grow(df)
    assert any(shared)


def test_one_task_grows_a_tree(monkeypatch, table):
    """Samples that a task can hold are grown without rounds, and as rounds grow them."""
    _, _, df = table
    rounds, sums = [], RF.HistogramForest.sums
    monkeypatch.setattr(RF.HistogramForest, "sums", lambda self, *a: rounds.append(1) or sums(self, *a))

    def nodes(balanced):
        _, trees = RF.HistogramForest(trees=5, depth=6, balanced=balanced).grow(df)

        def walk(t, n):
            return (t.feature[n], t.cut[n], walk(t, t.left[n]), walk(t, t.left[n] + 1)) if t.left[n] else round(t.value[n], 7)
        return [walk(t, 0) for t in trees]

    alone = [nodes(b) for b in (False, True)]
    assert not rounds
    monkeypatch.setattr(RF, "LOCAL_ROWS", 70)
    assert [nodes(b) for b in (False, True)] == alone and rounds


def test_drawn_sums_stay_apart():
    """Every row drawn most often, in chunks that are full."""
    n = 3 * RF.CHUNK + 5
    label = (np.arange(n) % 2).astype(np.uint8)
    code = (np.arange(n) // 2 % 3).astype(np.uint8)
    for weights in ([2.0, 5.0], [0.7, 3.3]):  # multiples of one draw's weight, and others
        unit = RF.weights_of(weights, 1024.0)
        (got,) = RF.drawn_sums([code], [3], np.uint8(12) + 16 * label, np.arange(n, dtype=np.int32), unit)
        counts = [[int(((code == c) & (label == y)).sum()) for c in range(3)] for y in (0, 1)]
        assert got.tolist() == [[b * unit[28] for b in counts[1]], [a * unit[12] + b * unit[28] for a, b in zip(*counts)], [a + b for a, b in zip(*counts)]]
    (one,) = RF.drawn_sums([np.zeros(n, np.uint8)], [1], np.full(n, 28, np.uint8), np.arange(n, dtype=np.int32), RF.weights_of([1.0, 1.0], 2.0))
    assert one.tolist() == [[24 * n], [24 * n], [n]]


def test_scores_equal_the_stored_model(table):
    """Trees passed by whole batches give MLlib's own predictions."""
    _, _, df = table
    model = RF.HistogramForest(trees=7, depth=6).fit(df)
    rows = df.select("txn_id", "features").unionByName(df.limit(3).select((-F.col("txn_id") - 1).alias("txn_id"), F.expr("features")))
    mine = {r[0]: r[1] for r in rows.select("txn_id", RF.scored(rows, model.tables)).collect()}
    assert mine == {r[0]: r[1] for r in model.transform(rows).select("txn_id", "prediction").collect()}
    assert RF.mean_of_trees(np.array([[np.nan]]), [(np.array([0, 0, 0]), np.array([1.0, np.inf, np.inf]), np.array([1, 1, 2]), np.array([0.0, 2.0, 3.0]), 1)]).tolist() == [3.0]
