"""Small exact fits of the model families on binned inputs: what SQL can state of them, node by node."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.features import feature_select
from txnrisk.operators import forest as RF
from txnrisk.operators import models as MD
from txnrisk.operators.boosting import HistogramBoosting
from txnrisk.plans import oracles as O
from txnrisk.plans import registry as R
from txnrisk.operators.iforest import EULER, IsolationForest
from txnrisk.plans.registry import isolation_samples_sql, query, split_txn

# The inputs of the small fits, in Spark's and in the statements' words.
BINNED = {"hour(txn_ts)": "hour(txn_ts)", "is_intl": "is_intl", "floor(amount / 25000)": "floor(amount / 25000)", "previous_txns": "previous_txns"}
ROUNDED = 6


def binned_train(spark, sf_dir) -> DataFrame:
    txn, cuts = split_txn(spark, sf_dir)
    return txn.where(cuts.condition("train")).select("txn_id", F.expr(f"array({', '.join(f'cast({e} as double)' for e in BINNED)})").alias("x"), "label")


# ------------------------------------------------------------------------ boosting

NODES_DDL = "tree int, path string, feature int, threshold double, value double"


def boosted_nodes(spark, sf_dir, trees: int, leaves: int) -> DataFrame:
    """Every node of a small boosted model: inner ones with their split, leaves (feature -1) with their value."""
    rows = binned_train(spark, sf_dir).select(array_to_vector("x").alias("features"), "label")
    bounds, _, grown = HistogramBoosting(max_iter=trees, max_leaves=leaves).grow(rows)
    out = []

    def walk(k, tree, node, path):
        if not tree.left[node]:
            out.append((k, path, -1, None, tree.value[node]))
            return
        out.append((k, path, tree.feature[node], float(bounds[tree.feature[node]][tree.cut[node]]), None))
        for step, side in enumerate("LR"):
            walk(k, tree, tree.left[node] + step, path + side)

    for k, tree in enumerate(grown):
        walk(k, tree, 0, "")
    nodes = spark.createDataFrame(out, NODES_DDL)  # a model's nodes: at most trees x (2 x leaves - 1)
    return nodes.select("tree", "path", "feature", F.round("threshold", ROUNDED).alias("threshold"), (F.round("value", ROUNDED) + 0.0).alias("value"))


_LONG = ("with " + O.SPLIT + ", src as (select * from sp where split = 'train'), long as ("
         + " union all ".join(f"select txn_id, {j} as f, cast({e} as double) as x from src" for j, e in enumerate(BINNED.values()))
         + "), steps as (select f, x, (x + lead(x) over (partition by f order by x)) / 2 as cut from (select distinct f, x from long))")


def _splits(name: str, source: str, l2: int = 2) -> str:
    """CTEs that end in ``name``: the best split (f, x, gain) of every node of ``source`` (txn_id, node, g, h)."""
    return f""", {name}_c as (select node, f, x, sum(g) as g, sum(h) as h, count(*) as n from {source} join long using (txn_id) group by node, f, x),
{name}_b as (select node, f, x, sum(g) over w as gl, sum(h) over w as hl, sum(n) over w as nl, sum(g) over v as gt, sum(h) over v as ht, sum(n) over v as nt
  from {name}_c window w as (partition by node, f order by x), v as (partition by node, f)),
{name}_g as (select *, gl * gl / (hl + {l2}) + (gt - gl) * (gt - gl) / (ht - hl + {l2}) - gt * gt / (ht + {l2}) as gain from {name}_b
  where nl >= 25 and nt - nl >= 25 and hl >= 0.001 and ht - hl >= 0.001),
{name} as (select node, f, x, gain from (select *, row_number() over (partition by node order by gain desc, f, x) as rn from {name}_g) where rn = 1 and gain > 0)"""


_START = ", raw0 as (select txn_id, label, ln(p / (1 - p)) as raw from src, (select avg(label) as p from src))"


def _slopes(k: int) -> str:
    return f", s{k} as (select txn_id, '' as node, 1 / (1 + exp(-raw)) - label as g, 1 / (1 + exp(-raw)) * (1 - 1 / (1 + exp(-raw))) as h from raw{k})"


def _sides(name: str, source: str, splits: str) -> str:
    """``source`` with every row's node divided by that node's split."""
    return f""", {name} as (select s.txn_id, s.node || case when b.f is null then '' when l.x <= b.x then 'L' else 'R' end as node, s.g, s.h
  from {source} s left join {splits} b using (node) left join long l on l.txn_id = s.txn_id and l.f = b.f)"""


def _leaves(name: str, source: str) -> str:
    return f", {name} as (select node, -0.06 * sum(g) / (sum(h) + 2) as value from {source} group by node)"


def _out(k: int, splits: list[str], leaves: str) -> str:
    inner = " union all ".join(
        f"select {k} as tree, node as path, f as feature, round(cut, {ROUNDED}) as threshold, cast(null as double) as value from {b} join steps using (f, x)" for b in splits)
    return inner + f" union all select {k}, node, -1, null, round(value, {ROUNDED}) + 0.0 from {leaves}"


_STUMPS = (_LONG + _START + _slopes(0) + _splits("b0", "s0") + _sides("d0", "s0", "b0") + _leaves("v0", "d0")
           + ", raw1 as (select r.txn_id, r.label, r.raw + v0.value as raw from raw0 r join d0 using (txn_id) join v0 using (node))"
           + _slopes(1) + _splits("b1", "s1") + _sides("d1", "s1", "b1") + _leaves("v1", "d1") + " " + _out(0, ["b0"], "v0") + " union all " + _out(1, ["b1"], "v1"))
_THREE = (_LONG + _START + _slopes(0) + _splits("b0", "s0") + _sides("d0", "s0", "b0") + _splits("c0", "d0")
          + ", b1 as (select * from c0 order by gain desc, f, x limit 1)" + _sides("d1", "d0", "b1") + _leaves("v1", "d1") + " " + _out(0, ["b0", "b1"], "v1"))


@query("boosting_stumps", _STUMPS)
def boosting_stumps(spark, sf_dir):
    """Two rounds of boosting with one split each."""
    return boosted_nodes(spark, sf_dir, trees=2, leaves=2)


@query("boosting_three_leaves", _THREE)
def boosting_three_leaves(spark, sf_dir):
    """One leaf-wise tree of three leaves."""
    return boosted_nodes(spark, sf_dir, trees=1, leaves=3)


# -------------------------------------------------------------------------- forest

_TREES = 250
_HEX = "cast('0x' || substr(md5({}), 1, 15) as bigint)"
_DRAWN = ("with " + O.SPLIT + ", k as (select txn_id, label, " + _HEX.format("'row-' || txn_id") + " as key from sp where split = 'train'), "
          + "f as (select t as tree, " + _HEX.format("'tree-' || t || '-42'") + f" as h from range({_TREES}) r(t)), "
          + "u as (select txn_id, label, tree, (cast(key as hugeint) * cast(h + 1 - h % 2 as hugeint)) % 18446744073709551616 // 4294967296 as top from k, f), "
          + "d as (select txn_id, label, tree, " + " + ".join(f"cast(top >= {x} as bigint)" for x in RF.DRAWS) + " as draws from u)")


@query("forest_bootstrap_weights", _DRAWN + """, c as (select tree, label, sum(draws) as n from d group by tree, label),
w as (select tree, label, sum(n) over (partition by tree) / (2.0 * n) as cw from c)
select cast(d.tree as int) as tree, d.label, count(*) filter (draws > 0) as rows_drawn, cast(sum(draws) as bigint) as draws, round(sum(draws * cw), 6) as weight,
  cast(sum(draws * (txn_id % 1009)) as bigint) as id_sum from d join w using (tree, label) group by d.tree, d.label""")
def forest_bootstrap_weights(spark, sf_dir):
    """Per tree and class of the balanced forest: rows in the sample, draws, weight, and a sum over IDs that fixes which rows were drawn."""
    txn, cuts = split_txn(spark, sf_dir)
    rows = RF.bootstrap_weights(txn.where(cuts.condition("train")), _TREES)
    return rows.groupBy("tree", "label").agg(
        F.count(F.lit(1)).alias("rows_drawn"), F.sum("draws").alias("draws"), F.round(F.sum("weight"), ROUNDED).alias("weight"),
        F.sum(F.col("draws") * (F.col("txn_id") % 1009)).alias("id_sum"))


# ---------------------------------------------------------------- isolation forest

_ISOLATION_TREES, _ISOLATION_SAMPLE, _ISOLATION_DEPTH = 20, 64, 6


def _isolation_sql() -> str:
    """Trees are grown level by level from the sampled rows, and test rows walk down the same splits."""
    draw = lambda purpose: _HEX.format(f"'{purpose}-' || tree || '-' || place || '-42'")
    unit = "cast(1152921504606846976 as double)"
    text = isolation_samples_sql(_ISOLATION_TREES, _ISOLATION_SAMPLE) + ", long as (" + " union all ".join(
        f"select txn_id, {j} as f, cast({e} as double) as x from sp" for j, e in enumerate(BINNED.values())) + f""")
, g0 as (select tree, txn_id, 1 as place from k where rn <= {_ISOLATION_SAMPLE})
, t0 as (select txn_id, tree, 1 as place from sp, range({_ISOLATION_TREES}) r(tree) where split = 'test')"""
    for d in range(_ISOLATION_DEPTH):
        text += f"""
, a{d} as (select tree, place, f, min(x) as lo, max(x) as hi from g{d} join long using (txn_id) group by tree, place, f having max(x) > min(x))
, b{d} as (select *, row_number() over (partition by tree, place order by f) - 1 as i, count(*) over (partition by tree, place) as n from a{d})
, c{d} as (select tree, place, f, lo, hi, lo + (hi - lo) * ({draw('split')} / {unit}) as s from b{d} where i = {draw('feature')} % n)
, s{d} as (select tree, place, f, case when s >= hi then lo else s end as s from c{d})
, g{d + 1} as (select g.tree, g.txn_id, 2 * g.place + cast(x > s as int) as place from g{d} g join s{d} using (tree, place) join long l on l.txn_id = g.txn_id and l.f = s{d}.f)
, t{d + 1} as (select t.txn_id, t.tree, case when s is null then t.place else 2 * t.place + cast(x > s as int) end as place
  from t{d} t left join s{d} using (tree, place) left join long l on l.txn_id = t.txn_id and l.f = s{d}.f)"""
    sizes = " union all ".join(f"select tree, place, count(*) as n from g{d} group by tree, place" for d in range(_ISOLATION_DEPTH + 1))
    path = f"case when {{0}} <= 1 then 0 when {{0}} = 2 then 1 else 2 * (ln({{0}} - 1) + {EULER}) - 2 * ({{0}} - 1) / cast({{0}} as double) end"
    whole = path.format(f"least({_ISOLATION_SAMPLE}, (select count(*) from tr))")
    return text + f""", z as ({sizes}),
h as (select t.txn_id, avg(floor(log2(t.place)) + {path.format('n')}) as h from t{_ISOLATION_DEPTH} t join z using (tree, place) group by t.txn_id)
select txn_id, round(pow(2, -h / ({whole})), {ROUNDED}) as anomaly_score from h"""


def small_isolation_forest(train: DataFrame) -> IsolationForest:
    names = [f"b{j}" for j in range(len(BINNED))]
    binned = SQLTransformer(statement="select *, " + ", ".join(f"cast({e} as double) as {n}" for e, n in zip(BINNED, names)) + " from __THIS__")
    ready = PipelineModel([binned, VectorAssembler(inputCols=names, outputCol="features")])
    return IsolationForest.fit(train, trees=_ISOLATION_TREES, sample_size=_ISOLATION_SAMPLE, preprocess=ready)


@query("iforest_fixed_score", _isolation_sql())
def iforest_fixed_score(spark, sf_dir):
    """A small isolation forest on binned inputs: sampled, grown and walked."""
    txn, cuts = split_txn(spark, sf_dir)
    forest = small_isolation_forest(txn.where(cuts.condition("train")))
    return forest.score(txn.where(cuts.condition("test"))).select("txn_id", F.round("anomaly_score", ROUNDED).alias("anomaly_score"))


# ---------------------------------------------------------------------- batch jobs

_THRESHOLD, _CUTOFF = 0.3, 0.5
_JOB = ("with iso as (" + _isolation_sql() + "), fx as (with " + O.SPLIT + ", ft as (" + R._FEATURES_SQL + " from sp where split = 'test') select txn_id, 1 / (1 + exp(-("
        + f"{R._BASE} + " + " + ".join(f"{w} * coalesce({c}, 0)" for c, w in R._COEF.items()) + " + " + R._METHOD_SQL + "))) as fraud_score from ft), job as ("
        + f"select txn_id, fraud_score, cast(fraud_score >= {_THRESHOLD} as int) as predicted_fraud, anomaly_score, cast(anomaly_score >= {_CUTOFF} as int) as anomaly_flag from fx join iso using (txn_id))")


def scored_file(spark, sf_dir) -> str:
    """A file of test transactions through the scoring job: models are loaded from a run's folder, scores are written as text.  The folder of the scores."""
    from txnrisk.plans import batch
    from txnrisk.session import working_path
    from txnrisk.sources import writers as W

    txn, cuts = split_txn(spark, sf_dir)
    run, given, out = (working_path(spark, n) for n in ("job-run", "job-input", "job-scores"))
    terms = " + ".join(f"{w}D * coalesce(f_{c}, 0D)" for c, w in R._COEF.items())
    bonus = " ".join(f"when method = '{v}' then {w}D" for v, w in R._METHOD_COEF.items())
    classifier = PipelineModel([
        SQLTransformer(statement=feature_select()),
        SQLTransformer(statement=f"select *, 1D / (1D + exp(-({R._BASE}D + {terms} + case {bonus} else 0D end))) as prediction from __THIS__"),
    ])
    MD.save_model(classifier, f"{run}/models/classifier")
    small_isolation_forest(txn.where(cuts.condition("train"))).save(spark, f"{run}/models/iforest")
    W.write_document(spark.createDataFrame([(_THRESHOLD, _CUTOFF)], "threshold double, anomaly_cutoff double"), f"{run}/selection")
    W.write_text(txn.where(cuts.condition("test")).drop("pseudo_score"), given)
    batch.score_file(spark, given, out, run)
    return out


@query("score_job", _JOB + f""" select txn_id, round(fraud_score, {ROUNDED}) as fraud_score, predicted_fraud, anomaly_score, anomaly_flag,
  case when predicted_fraud = 1 then 'Model review' when anomaly_flag = 1 then 'Anomaly review' else 'Lower score' end as review_status from job""")
def score_job(spark, sf_dir):
    """What the scoring job's file holds."""
    from txnrisk.sources import readers

    rows = readers.read_scored(spark, scored_file(spark, sf_dir))
    return rows.select(
        F.col("txn_id").cast("long").alias("txn_id"), F.round("fraud_score", ROUNDED).alias("fraud_score"), "predicted_fraud", F.round("anomaly_score", ROUNDED).alias("anomaly_score"),
        "anomaly_flag", "review_status")


@query("alerts_job", _JOB + f""" select cast(txn_id as varchar) as transaction_id, round(fraud_score, {ROUNDED}) as fraud_score, anomaly_flag, 'SIMULATED_ONLY' as status
  from job where predicted_fraud = 1 order by job.fraud_score desc, cast(txn_id as varchar) limit 25""")
def alerts_job(spark, sf_dir):
    """The alert file made from the scoring job's file."""
    from txnrisk.operators import scoring
    from txnrisk.session import working_path
    from txnrisk.sources import readers
    from txnrisk.sources import writers as W

    path = working_path(spark, "job-alerts")
    wanted = scoring.alerts(readers.read_scored(spark, scored_file(spark, sf_dir)))
    W.write_alerts(wanted, path)
    rows = spark.read.schema(wanted.schema).json(path)
    return rows.select("transaction_id", F.round("fraud_score", ROUNDED).alias("fraud_score"), "anomaly_flag", "status")


# -------------------------------------------------------------- trees and regression

_GINI = (_LONG + ", y0 as (select txn_id, '' as node, cast(label as double) as g, cast(1 as double) as h from src)"
         + _splits("q0", "y0", 0) + _sides("y1", "y0", "q0") + _splits("q1", "y1", 0) + _sides("y2", "y1", "q1")
         + " select node as path, f as feature, round(cut, 6) as threshold, cast(null as double) as share from q0 join steps using (f, x)"
         + " union all select node, f, round(cut, 6), null from q1 join steps using (f, x) union all select node, -1, null, round(avg(g), 6) from y2 group by node")


@query("tree_small", _GINI)
def tree_small(spark, sf_dir):
    """A decision tree of depth two with the production leaf size: every node with its split or, at leaves, the share of frauds."""
    rows = binned_train(spark, sf_dir).select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))
    estimator = MD.tree(0).setMaxDepth(2)
    root = estimator.fit(rows)._java_obj.rootNode()
    out = []

    def walk(node, path):
        if node.subtreeDepth() == 0:
            out.append((path, -1, None, node.prediction()))
            return
        out.append((path, node.split().featureIndex(), node.split().threshold(), None))
        walk(node.leftChild(), path + "L")
        walk(node.rightChild(), path + "R")

    walk(root, "")
    nodes = spark.createDataFrame(out, "path string, feature int, threshold double, share double")  # seven nodes at most
    return nodes.select("path", "feature", F.round("threshold", ROUNDED).alias("threshold"), F.round("share", ROUNDED).alias("share"))


_STEPS = 12  # of Newton's method; the differences halve their digits at each


def _newton_sql() -> str:
    text = "with " + O.SPLIT + """, fold as (select floor(amount / 25000) / 10 as x, count(*) as n, sum(label) as pos from sp where split = 'train' group by 1),
s0 as (select ln(sum(pos) / (sum(n) - sum(pos))) as b0, cast(0 as double) as b1 from fold)"""
    for k in range(_STEPS):
        text += f""", p{k} as (select b0, b1, x, n, pos, 1 / (1 + exp(-(b0 + b1 * x))) as p from fold, s{k}),
d{k} as (select b0, b1, sum(n * p * (1 - p)) as h00, sum(n * p * (1 - p) * x) as h01, sum(n * p * (1 - p) * x * x) + 1 as h11,
  sum(n * p - pos) as g0, sum((n * p - pos) * x) + b1 as g1 from p{k} group by b0, b1),
s{k + 1} as (select b0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) as b0, b1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) as b1 from d{k})"""
    return text + f" select round(b0, {ROUNDED}) as intercept, round(b1, {ROUNDED}) as coefficient from s{_STEPS}"


@query("lr_small", _newton_sql())
def lr_small(spark, sf_dir):
    """The production logistic regression on one binned input."""
    txn, cuts = split_txn(spark, sf_dir)
    x = F.expr("array(cast(floor(amount / 25000) as double) / 10)")
    rows = txn.where(cuts.condition("train")).select(array_to_vector(x).alias("features"), F.col("label").cast("double").alias("label"))
    model = MD.logistic(rows.count()).fit(rows)
    numbers = spark.createDataFrame([(model.intercept, float(model.coefficients[0]))], "intercept double, coefficient double")
    return numbers.select(*[F.round(c, ROUNDED).alias(c) for c in numbers.columns])
