import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import ODD, batch, empty_frame, odd_frame, ordered

from txnrisk.llm import queries, suffix
from txnrisk.llm import superkmers as S
from txnrisk.llm.substring import received, with_spans


def plain(rows, length=400):
    count, out = {}, []
    docs = [(d, (t or "").encode()) for d, t in rows]
    for _, w in docs:
        for i in range(len(w) - length + 1):
            count[w[i:i + length]] = count.get(w[i:i + length], 0) + 1
    for d, w in docs:
        gone = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if count[w[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return ordered(out)


def test_query_equals_plain_version(spark, sf):
    got = queries.op3_suffix_array_dedup(spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ordered(map(tuple, got)) == plain(docs)
    assert sum(r["n_removed"] for r in got) > 0


def test_odd_rows(spark):
    got = suffix.deduplicate(odd_frame(spark)).collect()
    assert ordered((*r[:4], hashlib.sha256(r["kept"]).hexdigest()) for r in got) == plain(ODD)
    assert suffix.deduplicate(empty_frame(spark)).count() == 0


@pytest.mark.parametrize("chunk", [300, 5_000, 1 << 20])
@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("letters", [2, 20])
def test_any_chunk_size_alphabet_and_hot_grams(monkeypatch, chunk, hot, letters):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(letters)
    text = lambda n: "".join(chr(97 + c) for c in rng.integers(0, letters, n))
    base = text(400)
    texts = [base, text(50) + base[20:200] + text(30), base[:150] + text(5) + base[100:300], text(90) + base[60:260] + "\0\0", "ab" * 200, "ab" * 90 + base[20:200], base, "q" * 130]
    rows = [(k, 2 * k, t) for k, t in enumerate(texts)]
    sent = pa.Table.from_batches([*suffix.segment_task(60, 16, np.full(2**S.SLOT_BITS, hot), 3)(iter([batch(rows)]))])
    found = {}
    for b in range(3):
        segments, through = received(sent.filter(pa.compute.equal(sent["bucket"], b)))
        _, member, left, right = suffix.maximal_repeats(segments, 60)
        anchor = segments.start[member] + segments.anchor[member]
        for r, _, s in [*through, *S.merged(segments.row[member], segments.mark[member], anchor - left, anchor + right)]:
            found.setdefault(r, []).append(s)
    got = []
    for r, _, t in rows:
        spans = [*zip(*(x.tolist() for x in S.unpack_spans(found.get(r))))]
        kept, behind = "", 0
        for s, e in spans:
            kept, behind = kept + t[behind:s], e
        kept += t[behind:]
        got.append((r, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept.encode()).hexdigest()))
    assert ordered(got) == plain([(r, t) for r, _, t in rows], 60)


def test_repeat_groups_hold_all_occurrences(spark):
    rng = np.random.default_rng(5)
    text = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 20, n))
    shared = text(500)
    df = spark.createDataFrame([(k, text(100) + shared + text(100)) for k in range(5)], "doc_id long, text string")
    groups = suffix.repeat_groups(df).toPandas()
    pieces = groups[groups["n_bytes"] >= 400].groupby(["repeat", "n_bytes"])["row_id"].nunique()
    assert (pieces == 5).any()  # all occurrences, not pairs of neighbours
    whole = groups[groups.groupby(["repeat", "n_bytes"])["row_id"].transform("nunique") == 5]
    assert {(a["start"].min(), (a["start"] + a["n_bytes"]).max()) for _, a in whole.groupby("row_id")} == {(100, 600)}


def common_passages(rng, n):
    """Documents that differ but for common passages, some of which are nearly a window of 60 long, and some real repeats."""
    text = lambda k: "".join(chr(97 + c) for c in rng.integers(0, 20, k))
    shared, whole = [text(30), text(54), text(59)], text(75)
    return [(k, text(40) + shared[k % 3] + text(40) + (whole if k % 40 == 0 else "") + text(20)) for k in range(n)]


@pytest.mark.parametrize("bucket_bytes", [4_000, 24 << 20])
def test_common_passages_do_not_make_large_groups(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket_bytes)
    docs = common_passages(np.random.default_rng(3), 240)
    rows = S.row_keys(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), "doc_id", "text")

    def largest(table):
        segments, _ = received(table)
        size = np.bincount(np.unique(segments.minimiser, return_inverse=True)[1], segments.size)
        return pa.table({"n": [int(size.max(initial=0))]})

    sizes = [r["n"] for r in suffix.segments_by_bucket(rows, 60, 16).applyInArrow(largest, "n long").collect()]
    assert max(sizes) <= max(1_000, bucket_bytes // 4)
    spans = with_spans(rows, suffix.repeated_spans(rows, 60, 16)).select("doc_id", "text", "spans").collect()
    got = []
    for d, t, packed in spans:
        places = [*zip(*(x.tolist() for x in S.unpack_spans(packed)))]
        kept = "".join(t[a:b] for a, b in zip([0, *(e for _, e in places)], [*(s for s, _ in places), len(t)]))
        got.append((d, len(t), len(t) - len(kept), len(places), hashlib.sha256(kept.encode()).hexdigest()))
    assert ordered(got) == plain(docs, 60)


@pytest.mark.parametrize("chunk", [300, 5_000])
@pytest.mark.parametrize("depth", [1, 2, 3])
def test_divided_groups_find_the_same_repeats(monkeypatch, chunk, depth):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    docs = [*common_passages(np.random.default_rng(4), 60), (60, "ab" * 200), (61, "ab" * 90 + "q" * 130)]
    cold, every = np.zeros(2**S.SLOT_BITS, bool), []
    for _ in range(depth):  # all keys are too large
        every.append(np.unique(np.concatenate([f.minimiser for f, _ in suffix.segments_of(iter([batch([(d, 2 * d, t) for d, t in docs])]), 60, 16, cold, every)])))
    sent = pa.Table.from_batches([*suffix.segment_task(60, 16, cold, 1, every)(iter([batch([(d, 2 * d, t) for d, t in docs])]))])
    segments, through = received(sent)
    _, member, left, right = suffix.maximal_repeats(segments, 60)
    anchor = segments.start[member] + segments.anchor[member]
    found = {}
    for r, _, s in [*through, *S.merged(segments.row[member], segments.mark[member], anchor - left, anchor + right)]:
        found.setdefault(r, []).append(s)
    gone = {d: sum(e - s for s, e in zip(*(x.tolist() for x in S.unpack_spans(found.get(d))))) for d, _ in docs}
    assert [(d, gone[d]) for d, _ in docs] == sorted((d, n) for d, _, n, _, _ in plain(docs, 60))


def held_bytes(n):
    return [S.Piece(0, 0, 0, n, np.random.default_rng(n).integers(0, 4, n, np.uint8).tobytes())]


@pytest.mark.parametrize("n", [60, 64, 1_000])
@pytest.mark.parametrize("gram", [8, 16, 32])
def test_hashes_and_anchors_do_not_depend_on_blocks(monkeypatch, n, gram):
    held, hot = held_bytes(n), np.random.default_rng(1).random(2**S.SLOT_BITS) < 0.5
    whole = suffix.grams_of(held, gram)[1]
    places = S.anchors(whole, hot, 60 - gram + 1)
    keys = S.order_keys(whole, hot)
    assert places.tolist() == [i + int(np.argmin(keys[i:i + 60 - gram + 1])) for i in range(n - 59)]
    words = [int.from_bytes(held[0].data[i:i + 8], "little") for i in range(n - 7)]
    for i in (0, n // 2, n - gram):
        if i + gram <= n:
            hashed = np.array(words[i:i + 1], np.uint64)
            for k in range(8, gram, 8):
                hashed = S.join_hashes(hashed, np.array(words[i + k:i + k + 1], np.uint64))
            assert whole[i] == S.mix(hashed)[0]
    for block in (1, 7, 64):
        monkeypatch.setattr(suffix, "HASH_BLOCK", block)
        monkeypatch.setattr(S, "MIN_BLOCK", block)
        assert (suffix.grams_of(held, gram)[1] == whole).all()
        assert (S.anchors(whole, hot, 60 - gram + 1) == places).all()


def test_a_chunk_is_hashed_in_small_blocks():
    """Arrays as long as the chunk for every step of the hash are what made the passes over the texts slow."""
    held, hot, valid = held_bytes(1 << 20), np.zeros(2**S.SLOT_BITS, bool), np.zeros(1 << 20, bool)
    suffix.grams_of(held, 32)
    tracemalloc.start()
    grams = suffix.grams_of(held, 32)[1]
    hashing = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    S.runs(grams, hot, 369, valid)
    seeking = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert hashing < 16 * len(grams) and seeking < 16 * len(grams)
