import numpy as np
import public_tokenizers
import pytest
from llm.helpers import empty_frame
from llm.test_simhash import groups, plain_print
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from txnrisk.llm import decontaminate, pii, quality, queries
from txnrisk.llm.common import remainder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_pipeline(spark, sf):
    """Every stage's decisions on rows in the driver's memory; only the learned quality model is shared."""
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(remainder(F.col("doc_id"), 5) != 0)
    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    docs = [d for d in docs if model.score(np.array([quality.features(d["text"].encode())]))[0] >= quality.THRESHOLD]
    prints = [plain_print(d["text"]) for d in docs]
    root = groups(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for g, d in zip(root, docs):
        least[g] = min(d["doc_id"], least.get(g, d["doc_id"]))
    docs = [d for g, d in zip(root, docs) if least[g] == d["doc_id"]]
    words = lambda t: decontaminate.plain(t).decode().split()
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    five = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in items]

    def leaked(text):  # in these tables passages are whole, so half of an item's five-word runs settle it
        w = words(text)
        own = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        return any(len(f & own) >= len(f) / 2 for f in five)

    docs = [d for d in docs if not leaked(d["text"])]
    return [{**d, "text": pii.redact(d["text"], pii.find_spans(d["text"]))} for d in docs]


def test_run_equals_plain_stages(spark, sf):
    expected = {d["doc_id"]: d for d in plain_pipeline(spark, sf)}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in queries.pipeline(spark, sf).collect()}
    assert set(got) == set(expected) and 100 < len(got) < 200
    for k, d in expected.items():
        ids = library.encode(d["text"], add_special_tokens=False).ids
        r = got[k]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["n_chars"] == len(d["text"]) and r["lang"] == d["lang"]
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_stage_names_and_columns(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "tokenize"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, sf).columns == COLUMNS, name


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_every_stage_takes_odd_and_empty_tables(spark, sf, name, stage):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(5)
    odd = docs.unionByName(docs.limit(2)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string"))).unionByName(docs.limit(1).withColumn("text", F.lit("")))
    odd = odd.withColumns({"fp": F.lit(1), "ids": F.lit("x"), "score": F.lit(0.5), "item_id": F.lit(3), "__key": F.lit("k"), "__key_": F.lit(2), "__coded": F.lit(3), "row": F.lit(4)})
    out = stage(spark, odd, sf)
    rows = out.collect()
    assert {"fp", "score", "item_id", "__key", "__key_", "__coded", "row"} <= set(out.columns) and {r["__key"] for r in rows} <= {"k"}
    if name in ("pii", "tokenize"):
        assert len(rows) == odd.count()
    if name == "near_dedup":  # equal texts are one document, empty and null texts too
        assert len(rows) <= 6 and len({r["text"] for r in rows}) == len(rows)
    if name == "decontaminate":
        assert len(rows) >= 2  # null and empty texts hold nothing
    assert stage(spark, empty_frame(spark), sf).count() == 0
