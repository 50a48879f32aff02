import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from llm.helpers import empty_frame, odd_frame
from pyspark.sql import functions as F

from txnrisk.llm import queries, sharding, spotsigs


def test_shards_are_even_and_gapless(spark, sf):
    rows = queries.op6_sharding(spark, sf).collect()
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    count = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == len(docs) and max(count.values()) - min(count.values()) <= 1 and set(count) == set(range(40))
    for s, n in count.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert all(r["size"] == len(docs[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]]) for r in rows)


def test_hypergeometric_draws_follow_the_distribution():
    from math import comb

    rng = random.Random(3)
    drawn = collections.Counter(sharding.hypergeometric(rng, 7, 9, 6) for _ in range(20_000))
    for k in range(7):
        expected = comb(7, k) * comb(9, 6 - k) / comb(16, 6)
        assert abs(drawn[k] / 20_000 - expected) < 0.012
    big = [sharding.hypergeometric(rng, 10**10, 3 * 10**10, 10_000) for _ in range(300)]
    assert abs(np.mean(big) - 2500) < 15 and 30 < np.std(big) < 57


def test_matrix_margins():
    sizes = [5, 0, 17, 1, 30]
    matrix = sharding.communication_matrix(sizes, 4, 1)
    assert [sum(r) for r in matrix] == sizes and sorted(map(sum, zip(*matrix))) == [13, 13, 13, 14]


def test_sharding_odd_rows_and_uniformity(spark):
    out = sharding.assign(odd_frame(spark), ["doc_id", "text"], shards=3, blocks=4)
    assert out.columns == ["doc_id", "text", "spans", "fp", "shard", "slot"]
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [4, 4, 5]
    assert sharding.assign(empty_frame(spark), ["doc_id"]).count() == 0
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    means = sharding.assign(rows, ["doc_id"], shards=4, blocks=8).groupBy("shard").agg(F.avg("doc_id").alias("m"), F.corr("doc_id", "slot").alias("c")).collect()
    assert all(abs(r["m"] - 2000) < 150 and abs(r["c"]) < 0.12 for r in means)


def test_written_shards_keep_slot_order(spark, tmp_path):
    sharding.write_shards(sharding.assign(spark.range(100).withColumnRenamed("id", "doc_id"), ["doc_id"], shards=3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 3


@pytest.mark.parametrize("range_bytes", [1 << 30, 20_000])
def test_fingerprint_query(spark, sf, monkeypatch, range_bytes):
    monkeypatch.setattr(spotsigs, "RANGE_BYTES", range_bytes)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    rows = queries.op7_document_fingerprints(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    prints = {r["doc_id"]: set(r["fingerprint"].split()) for r in rows}
    by_text = {}
    for r in rows:
        text = docs[r["doc_id"]]
        third = len(text) // 3
        edited = text[:len(text) - third] + docs[following[r["doc_id"]]][:third]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        for other, near in ((prints[following[r["doc_id"]]], r["near_next"]), (set(r["edited_fingerprint"].split()), r["near_edited"])):
            mine = prints[r["doc_id"]]
            assert near == pytest.approx(len(mine & other) / len(mine | other) if mine | other else 1.0)
    assert np.median([r["near_edited"] for r in rows]) > 0.4 > np.median([r["near_next"] for r in rows])


def test_next_of_odd_rows(spark):
    frame = odd_frame(spark).select("doc_id", "text")
    out = spotsigs.with_next(frame, {}).collect()
    assert len(out) == 13
    assert collections.Counter(r["text"] for r in out) == collections.Counter(r["next_text"] for r in out)
    one = spotsigs.with_next(spark.createDataFrame([(4, "abc def")], "doc_id long, text string"), {}).collect()
    assert [(r["text"], r["next_text"]) for r in one] == [("abc def", "abc def")]
    assert spotsigs.with_next(empty_frame(spark), {}).count() == 0


def test_signatures(spark):
    texts = ["", "123 !", "a", "cat", "the cat of sat mat", "The CAT, of sat mat!", "cat\nsat", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(spotsigs.signatures(F.col("t"))).collect()]
    assert got[0] == got[1] == got[7] == [] and len(got[3]) == 1 and len(got[4]) == 2 and got[4] == got[5] and len(got[6]) == 2


def test_similar_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    sets = []
    for k in range(60):
        base = sets[rng.integers(0, k)] if k % 3 and k else set()
        base = {x for x in base if rng.random() > 0.08} | set(rng.integers(0, 10**6, 30 if not base else 2).tolist())
        sets.append(base)
    sets += [set(sets[0]), set()]
    frame = spark.createDataFrame([(k, sorted(s)) for k, s in enumerate(sets)], "doc_id long, prints array<int>")
    pairs, members = spotsigs.similar_pairs(frame)
    exact = {(i, j) for j in range(60) for i in range(j) if sets[i] != sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == exact and exact
    assert {r["doc_id"]: r["class_id"] for r in members.collect()}[60] == 0
