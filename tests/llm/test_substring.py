import hashlib

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import ODD, batch, empty_frame, odd_frame, ordered

from txnrisk.llm import queries, substring
from txnrisk.llm import superkmers as S

LAST = 2**63 - 1


def plain(rows, window=13):
    first, out = {}, []
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key, v = tuple(w[i:i + window]), LAST if d is None else d
            first[key] = min(first.get(key, v), v)
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (LAST if d is None else d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return ordered(out)


def test_query_equals_plain_version(spark, sf):
    got = queries.op2_substring_dedup(spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = [(d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in plain(docs)]
    assert ordered(map(tuple, got)) == ordered(expected)
    assert sum(r["n_removed"] for r in got) > 0


def test_odd_rows(spark):
    got = substring.deduplicate(odd_frame(spark))
    assert ordered(map(tuple, got.collect())) == plain(ODD)
    assert substring.deduplicate(empty_frame(spark)).count() == 0


@pytest.mark.parametrize("chunk", [200, 2_000, 1 << 20])
@pytest.mark.parametrize("hot", [False, True])
def test_any_chunk_size_and_hot_grams(monkeypatch, chunk, hot):
    """Long documents in parts, many chunks, parts of buckets, and minimisers that are all hot: the same windows."""
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substring, "PART_BYTES", 3 * chunk)
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(30)]
    base = " ".join(rng.choice(words, 300))
    texts = [base, base[100:800], " ".join(rng.choice(words, 200)) + " " + base[50:400], "z " * 300, "z " * 40, base + "  " + base]
    rows = [(k, 2 * k, t) for k, t in enumerate(texts)]
    slots = np.full(2**S.SLOT_BITS, hot)
    sent = pa.Table.from_batches([*substring.segment_task(13, 1, slots, 3)(iter([batch(rows)]))])
    found = {}
    for b in range(3):
        segments, through = substring.received(sent.filter(pa.compute.equal(sent["bucket"], b)))
        owner, offset = substring.judge_windows(segments, 13)
        start = segments.start[owner] + offset
        for r, _, s in [*through, *S.merged(segments.row[owner], segments.mark[owner], start, start + 13)]:
            found.setdefault(r, []).append(s)
    got = []
    for r, _, t in rows:
        gone = {i for s, e in zip(*(x.tolist() for x in S.unpack_spans(found.get(r)))) for i in range(s, e)}
        w = t.split()
        got.append((r, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert ordered(got) == plain([(r, t) for r, _, t in rows])


def test_hash_collisions_are_told_apart(monkeypatch):
    """Every window hash made equal: the words themselves decide."""
    monkeypatch.setattr(substring, "window_hashes", lambda words, window: np.zeros(len(words) - window + 1, np.uint64))
    rows = [(1, 0, " ".join(f"a{k}" for k in range(20))), (2, 2, " ".join(f"a{k}" for k in range(5, 25))), (3, 4, " ".join(f"b{k}" for k in range(20)))]
    sent = pa.Table.from_batches([*substring.segment_task(13, 1, np.zeros(2**S.SLOT_BITS, bool), 1)(iter([batch(rows)]))])
    segments, _ = substring.received(sent)
    owner, offset = substring.judge_windows(segments, 13)
    assert {(int(segments.row[o]), int(segments.start[o] + k)) for o, k in zip(owner, offset)} == {(2, 0), (2, 1), (2, 2)}
