import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnrisk.operators import categories as C
from txnrisk.operators.preprocess import Preprocess


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_numbers_follow_the_order_of_values(spark, rows_per_range):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("B", "x"), ("é", "y"), ("a", "z"), (None, "")], "p string, q string")
    got = {(r["column"], r["value"]): r["idx"] for r in C.numbered_values(df, ["p", "q"], rows_per_range).collect()}
    assert got == {("p", "B"): 0, ("p", "a"): 1, ("p", "b"): 2, ("p", "é"): 3, ("q", ""): 0, ("q", "x"): 1, ("q", "y"): 2, ("q", "z"): 3}


def vectors(model, df):
    return [(r["txn_id"], r["v"]) for r in model.transform(df).select("txn_id", vector_to_array("features").alias("v")).orderBy("txn_id").collect()]


def test_dictionary_and_lists_give_the_same_features(monkeypatch, parts, tmp_path):
    listed = Preprocess(scale=True).fit(parts["train"])
    monkeypatch.setattr(C, "LITERAL_LABELS", 4)  # some columns have more values, some fewer
    mixed = Preprocess(scale=True).fit(parts["train"])
    assert [type(s).__name__ for s in mixed.stages].count("CategoryIndex") == 1 and any(type(s).__name__ == "StringIndexerModel" for s in mixed.stages)
    strange = parts["test"].withColumn("location", F.when(F.col("txn_id") % 3 == 0, "Atlantis").otherwise(F.col("location")))
    assert vectors(mixed, strange) == vectors(listed, strange)
    mixed.write().overwrite().save(str(tmp_path / "p"))
    assert vectors(PipelineModel.load(str(tmp_path / "p")), strange) == vectors(listed, strange)


def test_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(n).select(F.concat(F.lit("m"), F.lpad((F.col("id") * 7 % n).cast("string"), 7, "0")).alias("merchant"), "id")
    assert C.many_valued(df, ["merchant"]) == ["merchant"]
    index = C.CategoryIndex.fit(df, {"merchant": "at"})
    assert index.sizes == {"merchant": n}
    wrong = index.transform(df).where(F.col("at") != F.substring("merchant", 2, 7).cast("double")).count()
    new = index.transform(spark.createDataFrame([("m9999999x",), (None,)], "merchant string")).select("at").collect()
    assert wrong == 0 and [r["at"] for r in new] == [n, n]
