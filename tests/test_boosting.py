import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from txnrisk.operators import boosting as B
from txnrisk.operators import lines as L


def plain(x, y, w, rounds, step, max_leaves, min_rows, l2):
    """Raw scores of leaf-wise boosting by direct sums over every value of every feature."""
    p = (w * y).sum() / w.sum()
    raw, sizes = np.full(len(y), np.log(p / (1 - p))), []
    for _ in range(rounds):
        share = 1 / (1 + np.exp(-raw))
        g, h = (share - y) * w, share * (1 - share) * w

        def best(rows):
            found = None
            for j in range(x.shape[1]):
                for v in np.unique(x[rows, j])[:-1]:
                    low = rows[x[rows, j] <= v]
                    high = rows[x[rows, j] > v]
                    if min(len(low), len(high)) < min_rows or min(h[low].sum(), h[high].sum()) < 1e-3:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (low, high)) - g[rows].sum() ** 2 / (h[rows].sum() + l2)
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = (gain, low, high)
            return found

        leaves = [(np.arange(len(y)), best(np.arange(len(y))))]
        while len(leaves) < max_leaves and any(s for _, s in leaves):
            k = max(range(len(leaves)), key=lambda i: leaves[i][1][0] if leaves[i][1] else -1)
            _, (_, low, high) = leaves.pop(k)
            leaves += [(low, best(low)), (high, best(high))]
        sizes.append(len(leaves))
        for rows, _ in leaves:
            raw[rows] -= step * g[rows].sum() / (h[rows].sum() + l2)
    return raw, sizes


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 600
    x = np.stack([rng.integers(0, 9, n), rng.normal(size=n).round(2), rng.integers(0, 2, n), np.zeros(n)], axis=1).astype(float)
    y = (rng.random(n) < 0.1 + 0.4 * (x[:, 0] > 5) * x[:, 2] + 0.2 * (x[:, 1] > 1)).astype(float)
    w = np.where(y == 1, 2.5, 0.75)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i]), float(w[i])) for i in range(n)], "i long, x array<double>, label double, w double")
    return x, y, w, df.withColumn("features", array_to_vector("x")).repartition(3)


@pytest.mark.parametrize("local", [1 << 16, 120, 0])
@pytest.mark.parametrize("weighted", [False, True])
def test_equals_plain_version(monkeypatch, table, local, weighted):
    """Subtrees grown by one task, by rounds over all blocks, and by both give the same model."""
    monkeypatch.setattr(B, "LOCAL_ROWS", local)
    monkeypatch.setattr(B, "STORE_EVERY", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    x, y, w, df = table
    estimator = B.HistogramBoosting(max_iter=3, step=0.3, max_leaves=6, min_rows=20, l2=2.0, weight="w" if weighted else None)
    model = estimator.fit(df)
    want, sizes = plain(x, y, w if weighted else np.ones(len(y)), 3, 0.3, 6, 20, 2.0)
    rows = model.transform(df).select("i", vector_to_array("probability")[1].alias("p")).orderBy("i").collect()
    assert [r["p"] for r in rows] == pytest.approx((1 / (1 + np.exp(-want))).tolist(), abs=1e-7)
    assert max(sizes) == 6 and [(t.numNodes + 1) // 2 for t in model.trees[1:]] == sizes


def test_model_is_stored_like_any_other(table, tmp_path):
    _, _, _, df = table
    model = B.HistogramBoosting(max_iter=2, max_leaves=4).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = GBTClassificationModel.load(str(tmp_path / "m"))
    score = lambda m: [r[0] for r in m.transform(df).orderBy("i").select(vector_to_array("probability")[1]).collect()]
    assert score(again) == score(model)


def test_partitions_do_not_change_the_model(table):
    _, _, _, df = table
    grow = lambda d: [(t.feature, t.cut, t.left, t.value) for t in B.HistogramBoosting(max_iter=3).grow(d)[2]]
    assert grow(df) == grow(df.repartition(7)) == grow(df.orderBy(F.desc("i")).coalesce(1))


def test_bin_bounds(spark):
    df = spark.range(3000).select(F.array(F.col("id").cast("double"), (F.col("id") % 5).cast("double"), F.lit(1.0)).alias("x"))
    many, five, one = B.bin_bounds(df, 3)
    assert five.tolist() == [0.5, 1.5, 2.5, 3.5] and one.tolist() == []
    assert 240 <= len(many) <= B.MAX_BINS - 1 + 1 and np.diff(many).max() < 40


def test_nothing_to_split(spark):
    df = spark.createDataFrame([([1.0], 1.0), ([2.0], 0.0)], "x array<double>, label double").withColumn("features", array_to_vector("x"))
    _, start, trees = B.HistogramBoosting(max_iter=2).grow(df)
    assert start == 0 and all(t.left == [0] and t.value == [0.0] for t in trees)
    with pytest.raises(ValueError, match="No rows"):
        B.HistogramBoosting().fit(df.where("label > 1"))


def test_large_and_small_leaves_share_a_pass(monkeypatch, table):
    """One pass over the blocks settles the leaves that are summed and those whose rows meet in a group."""
    _, _, _, df = table
    monkeypatch.setattr(B, "LOCAL_ROWS", 250)
    passes, kinds, look, run = [], [], B.HistogramBoosting.look, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: passes.append(1) or run(self, *a, **k))

    def counted(self, blocks, sizes, since, scale, ahead, leaves, nodes):
        before = len(passes)
        kinds.append({leaves[n].n > 250 for n in nodes})
        look(self, blocks, sizes, since, scale, ahead, leaves, nodes)
        assert len(passes) - before <= 1

    monkeypatch.setattr(B.HistogramBoosting, "look", counted)
    B.HistogramBoosting(max_iter=2, max_leaves=6, min_rows=20).grow(df)
    assert {True, False} in kinds


def test_few_values_need_no_sketch(monkeypatch, spark):
    df = spark.range(3000).select(F.array(F.col("id").cast("double"), (F.col("id") % 5).cast("double"), F.lit(1.0)).alias("x"))
    sketches, sketch = [], F.percentile_approx
    monkeypatch.setattr(B.F, "percentile_approx", lambda *a: sketches.append(1) or sketch(*a))
    assert [len(b) > 4 for b in B.bin_bounds(df, 3)] == [True, False, False] and len(sketches) == 1


def test_rows_of_wanted_nodes():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 9, (3, 400)).astype(np.uint8)
    tree = B.Tree()
    for node, feature, cut in ((0, 0, 4), (1, 1, 2), (2, 2, 6), (4, 0, 1), (6, 1, 20)):
        tree.divide(node, feature, cut)
    at = np.zeros(400, int)
    for i in range(400):
        while tree.left[at[i]]:
            at[i] = tree.left[at[i]] + (bins[tree.feature[at[i]], i] > tree.cut[at[i]])
    leaves = {n for n, child in enumerate(tree.left) if not child}
    got = {n: rows.tolist() for n, rows in B.parted(bins, tree.inner())}
    assert got == {n: np.flatnonzero(at == n).tolist() for n in leaves if (at == n).any()}
    some = np.arange(0, 400, 3)
    assert {n: rows.tolist() for n, rows in B.parted(bins, tree.inner({3, 8}), {3, 8}, some)} == {n: [i for i in some if at[i] == n] for n in (3, 8)}
    assert [n for n, _ in B.parted(bins, {}, {0})] == [0]


def test_lines_lose_nothing():
    """One-hot columns share a bundle, small bundles a line, and sums and splits by codes are those by bins."""
    rng = np.random.default_rng(6)
    n = 3000
    kind, other = rng.integers(0, 6, n), rng.integers(0, 4, n)
    bins = np.stack([rng.integers(0, 200, n), *[kind == k for k in range(5)], rng.integers(0, 7, n), np.zeros(n, int), *[other == k for k in range(3)], rng.integers(0, 2, n)]).astype(np.uint8)
    sizes = [200, 2, 2, 2, 2, 2, 7, 1, 2, 2, 2, 2]
    met = bins.astype(int) @ bins.T > 0
    plan = L.planned(sizes, met)
    assert sorted(len(b) for line in plan.held for b in line) == [1, 1, 1, 3, 5] and plan.codes == [200, 7 * 6 * 4 * 2]
    codes = plan.pack(bins)
    again = plan.split(b"".join(c.tobytes() for c in codes), n)
    assert all((a == b).all() for a, b in zip(codes, again))
    g, h = np.rint(rng.normal(size=n) * 1000), np.rint(rng.random(n) * 1000)
    rows = np.arange(0, n, 3, dtype=np.int32)
    got = plan.cells(L.line_sums(plan, codes, g, h, rows), np.array([g[rows].sum(), h[rows].sum(), len(rows)]).astype(int))
    assert (got == B.histogram(bins[:, rows], g[rows], h[rows], 200)).all()
    for f in (0, 3, 6, 9, 11):
        line, low = plan.low(f, int(bins[f].max()) // 2)
        left, right = L.parted_rows(codes[line], low, rows)
        assert left.tolist() == [i for i in rows if bins[f, i] <= bins[f].max() // 2] and len(left) + len(right) == len(rows)


def test_one_task_boosts_a_table(monkeypatch, table):
    """A table that one task can hold takes no rounds, and gives the trees of rounds."""
    _, _, _, df = table
    looks, look = [], B.HistogramBoosting.look
    monkeypatch.setattr(B.HistogramBoosting, "look", lambda self, *a: looks.append(1) or look(self, *a))
    grow = lambda: [(t.feature, t.cut, t.left, t.value) for t in B.HistogramBoosting(max_iter=7, max_leaves=8, min_rows=20, weight="w").grow(df)[2]]
    alone = grow()
    assert not looks and len(alone) == 7
    monkeypatch.setattr(B, "LOCAL_ROWS", 90)
    assert grow() == alone and looks


@pytest.mark.parametrize("most", [62, 3])
def test_route(monkeypatch, most):
    """Tables over codes lead rows to the leaves that comparisons lead them to."""
    monkeypatch.setattr(B, "MOST_LEAVES", most)
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 9, (3, 500)).astype(np.uint8)
    plan, tree = L.planned([9, 9, 9], np.zeros((3, 3), bool)), B.Tree()
    for node, feature, cut in ((0, 0, 4), (1, 1, 2), (2, 2, 6), (4, 0, 1), (6, 1, 5)):
        tree.divide(node, feature, cut)
    route = B.Route(plan, tree.inner())
    at = route([c.astype(np.intp) for c in plan.pack(bins)], 500)
    got = {n: np.flatnonzero(at == i).tolist() for i, n in enumerate(route.leaves)}
    assert {n: r for n, r in got.items() if r} == {n: sorted(r.tolist()) for n, r in B.parted(bins, tree.inner())}


def test_known_bounds_are_used(monkeypatch, table):
    """Estimators that share a table need not find the same bins again."""
    _, _, _, df = table
    bounds = B.HistogramBoosting(max_iter=1).grow(df)[0]
    monkeypatch.setattr(B, "bin_bounds", lambda *a: 1 / 0)
    assert B.HistogramBoosting(max_iter=1, bounds=bounds).copy().grow(df)[0] is bounds
