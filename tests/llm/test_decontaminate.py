import collections
import random

import numpy as np
from llm.helpers import empty_frame, odd_frame

from txnrisk.llm import decontaminate, queries


def plain_align(a, b, penalty):
    best, row = 0.0, [0.0] * (len(b) + 1)
    for x in a:
        new = [0.0]
        for j, y in enumerate(b):
            new.append(max(0.0, row[j] + (1.0 if x == y else -penalty), row[j + 1] - penalty, new[-1] - penalty))
        best, row = max(best, *new), new
    return best


def test_alignment_equals_plain_dynamic_programming():
    rng = np.random.default_rng(0)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 20))
        assert decontaminate.align(a, b, 0.5)[0] == plain_align(a, b, 0.5)


def test_query_finds_whole_passages(spark, sf):
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in queries.op5_benchmark_decontamination(spark, sf).collect()}
    words = lambda t: decontaminate.plain(t).decode().split()
    items = {r["item_id"]: " ".join(words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: f" {' '.join(words(r['text']))} " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in t}
    assert whole and whole <= set(got) and all(got[p] == 1.0 for p in whole)
    for d, i in set(got) - whole:  # anything else must align in truth
        assert plain_align(items[i].split(), docs[d].split(), decontaminate.PENALTY) >= decontaminate.THRESHOLD * len(items[i].split())


def test_edited_copies_are_found_and_clean_documents_left(spark, sf):
    rng = random.Random(3)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows, planted = [], {}
    for k, item in enumerate(items.collect()):
        for share in (0.0, 0.1, 0.2):
            words = [w if rng.random() > share else rng.choice(docs[k].text.split()) for w in item["text"].split()]
            words = [w.upper() for w in words if rng.random() > 0.03]
            planted[10**6 + len(rows)] = (item["item_id"], share)
            rows.append((10**6 + len(rows), docs[k].text[:300] + " " + ", ".join(words) + " " + docs[k].text[300:600]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, items).collect()}
    caught = collections.Counter(s for d, (i, s) in planted.items() if (d, i) in got)
    assert caught[0.0] == caught[0.1] == 40 and caught[0.2] >= 38
    clean = spark.createDataFrame([(k, " ".join(rng.sample(d.text.split(), len(d.text.split())))) for k, d in enumerate(docs)], "doc_id long, text string")
    assert decontaminate.contaminated(clean, items).count() == 0


def test_items_that_leaked_everywhere_and_short_items(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(k, f"start {k} {item} end {k}") for k in range(50)] + [(99, "yes no")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "yes no"), (3, None), (4, ""), (None, "start 7 one two three")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(k, 1) for k in range(50)} <= got and (99, 2) in got and (7, None) in got and not any(i in (3, 4) for _, i in got)


def test_blocks_and_odd_rows(spark, sf, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    assert sorted(map(tuple, decontaminate.contaminated(docs, items).collect())) == whole
    assert decontaminate.contaminated(odd_frame(spark), items).count() == 0
    assert decontaminate.contaminated(empty_frame(spark), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
