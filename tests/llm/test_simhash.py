import random

import numpy as np
import pytest
import xxhash
from llm.helpers import ODD, empty_frame, odd_frame, ordered

from txnrisk.llm import queries, simhash
from txnrisk.llm.components import components


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    k = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    root = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for g, (d, _) in zip(root, rows):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return ordered((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, root))


def test_query_equals_plain_version(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ordered(map(tuple, queries.op4_simhash_near_dedup(spark, sf).collect())) == plain(docs)


def test_odd_rows(spark):
    got = [(r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in simhash.cluster(odd_frame(spark)).collect()]
    assert ordered(got) == plain(ODD)
    assert simhash.cluster(empty_frame(spark)).count() == 0


def test_block_by_block_bits(monkeypatch):
    text = " ".join(map(str, np.random.default_rng(0).integers(0, 50, 700))).encode()
    whole = simhash.fingerprint_bits(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint_bits(text, 3) == whole == plain_print(text.decode()).to_bytes(8, "big")


@pytest.mark.parametrize("tile", [8, 1024])
def test_links_connect_dense_groups_exactly(spark, tile):
    rng, prints = random.Random(1), set()
    for _ in range(3):
        hub = rng.getrandbits(64)
        for _ in range(150):
            x = hub
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(100)})
    place = {p: i for i, p in enumerate(prints)}
    exact = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    got = [(place[r["u"] % 2**64], place[r["v"] % 2**64]) for r in simhash.links(frame, 2, tile).collect()]
    name = lambda roots: [roots.index(r) for r in roots]
    assert set(map(frozenset, got)) <= set(map(frozenset, exact)) or all((prints[a] ^ prints[b]).bit_count() for a, b in got)
    assert name(groups(len(prints), got)) == name(groups(len(prints), exact))


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(50)}, 300: 300, 301: 300}


def test_keep_one_of_each_group(spark):
    rows = [(3, "a b c d", "x"), (1, "A b c d", "x"), (1, "A b c d", "x"), (None, "a b c d", "x"), (2, "q r s t", "y"), (None, None, "z"), (None, "", "z"), (5, "q r s t", "y")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert kept.columns == ["doc_id", "text", "fp"]
    got = kept.collect()
    assert sorted(r["doc_id"] for r in got if r["doc_id"]) == [1, 2] and len(got) == 3
