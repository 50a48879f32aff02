import zlib
from collections import Counter

import numpy as np
from llm.helpers import empty_frame, odd_frame
from pyspark.sql import functions as F

from txnrisk.llm import language, quality, queries

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    rows = queries.op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(spark):
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(train)
    out = odd_frame(spark).select("doc_id", "text", language.identified(F.col("text"), model).alias("l")).collect()
    for r in out:
        assert (r["l"]["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language.train(empty_frame(spark)).predict(["abc", None]) == (["und", "und"], [0.0, 0.0], [True, True])
    one = language.train(train.where("lang = 'de'").limit(3))
    assert one.predict(["abc"])[0] == ["de"]
    same = model.predict(["the of and", "der die das und", "the of and"])
    assert same[0][0] == same[0][2] and same[1][0] == same[1][2]


def test_language_draw_is_bounded_whatever_the_ids(spark, monkeypatch):
    ids = {"null": lambda i: None, "one": lambda i: 7, "own": lambda i: i}
    rows = [(f(i), f"{name} word{i} {chr(97 + i % 26) * 5}", name) for name, f in ids.items() for i in range(400)]
    rows += [(None, "the same text again", "copies")] * 400 + [(i, f"few {i}", "few") for i in range(3)]
    seen = []
    monkeypatch.setattr(language, "fit", lambda rows, names, held: seen.append((names, held)))
    monkeypatch.setattr(language, "SNIPPETS", ())  # one example per document
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.train(df, per_language=20)
    language.train(df.repartition(7), per_language=20)
    assert seen[0] == seen[1]
    names, held = seen[0]
    assert Counter(names) == {"null": 20, "one": 20, "own": 20, "copies": 1, "few": 3}
    for name in ids:
        assert len({h for n, h in zip(names, held) if n == name}) == 2  # some learn, some calibrate


def test_language_rejects_what_it_does_not_know():
    assert language.rejection(np.array([0.9, 0.8, 0.3]), np.array([True, True, False])) == 0.8
    assert language.rejection(np.array([0.9]), np.array([False])) == 1.0


def test_slices_do_not_change_probabilities(spark, monkeypatch):
    model = language.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60))
    texts = ["the house " * 50, "das Haus", "la maison " * 9, "x"]
    whole = model.probabilities(texts)
    monkeypatch.setattr(language, "SLICE_CHARS", 10)
    assert np.allclose(whole, model.probabilities(texts))


def test_quality_of_held_out_documents(spark):
    rows = queries.op9_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    good = [r for r in held if r["quality"] == 1]
    assert np.mean([r["predicted"] for r in good]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_learns_additive_and_pairwise_signal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # no feature alone says anything
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and np.mean((model.score(x) > 0.5) == (y == 1)) > 0.9
    one = quality.fit(x, (x[:, 2] > 0.3).astype(float))
    assert np.mean((one.score(x) > 0.5) == (x[:, 2] > 0.3)) > 0.97


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(7, 1), (8, None), (None, 0), (9, 1)], "doc_id long, quality int")
    model = quality.train(odd_frame(spark), labels)
    scores = [r[0] for r in odd_frame(spark).select(quality.scored(F.col("text"), model)).collect()]
    assert len(set(scores)) == 1 and 0.5 < scores[0] < 1  # one class: its share
    none = quality.train(empty_frame(spark), labels)
    assert none.score(np.zeros((1, len(quality.NAMES))))[0] == 0.5
    assert quality.features(b"") == [0.0] * len(quality.NAMES) and len(quality.features("ü ! | a".encode())) == len(quality.NAMES)


def test_quality_fit_takes_one_text_of_every_drawn_id(spark, monkeypatch):
    docs = [(1, f"copy {i} " * (i % 9 + 1)) for i in range(400)] + [(i, f"document {i} " * i) for i in range(2, 11)] + [(11, None)]
    labels = [(i, i % 2) for i in range(1, 12)] + [(1, 1)] * 50 + [(None, 1)]
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x.tolist(), y.tolist())))
    df, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    for parts in (1, 7):
        quality.train(df.repartition(parts), known.repartition(parts), max_rows=11)
    assert seen[0] == seen[1]
    assert seen[0][1] == [i % 2 for i in range(1, 12)]
