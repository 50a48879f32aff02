import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import ODD, empty_frame, odd_frame

from txnrisk.llm import periodic, queries


def plain(words, min_length=24, min_exponent=3):
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            run = words[start:start + length]
            if i > start and length >= max(min_length, min_exponent * q) and all(run[d:] != run[:-d] for d in range(1, q)):
                out.append((start, length, q))
            i += i == start
    return sorted(out)


def noisy(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n:
            start, p = rng.randrange(n), rng.randint(1, 14)
            for i in range(start, min(n, start + rng.randint(1, n))):
                words[i] = words[start + (i - start) % p]
    return words


@pytest.mark.parametrize("limits", [(24, 3), (6, 2), (2, 2), (10, 4)])
def test_runs_equal_plain_version(limits):
    rng = random.Random(sum(limits))
    for _ in range(300):
        words = noisy(rng, rng.randint(0, 120), rng.choice([1, 2, 3, 6, 40]))
        assert periodic.stretch_runs(words, *limits) == plain(words, *limits)
        text = " ".join(map(str, words)).encode()
        found = periodic.find([b"", text, b"1 2", text[::-1], text], *limits)
        assert found[1] == found[4] == ([str(w).encode() for w in words], plain(words, *limits))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(1, 6), st.integers(2, 5))
def test_planted_runs(head, period, times):
    words = [*head, *[f"w{i % period}" for i in range(period * times)], "end"]
    assert [(s, n, p) for s, n, p in periodic.stretch_runs([hash(w) for w in words], 1, 2)] == plain(words, 1, 2)


def test_access_returns_the_last_ends():
    words = [random.Random(5).randrange(3) for _ in range(60)]
    length, link, prefix = periodic.suffix_automaton(words)
    tree, last = periodic.LinkCutTree(link), {}
    for i, state in enumerate(prefix):
        path, at = [], state
        while at:
            path.append(at)
            at = link[at]
        expected = []
        for x in path:  # the deepest node of every stretch of one colour
            if not expected or last.get(x, -1) != expected[-1][0]:
                expected.append((last.get(x, -1), x))
        got = tree.access(state, i)
        merged = [g for k, g in enumerate(got) if not k or g[0] != got[k - 1][0]]
        assert merged == expected
        last.update(dict.fromkeys(path, i))


def test_query_equals_plain_version(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op12_periodic_runs(spark, sf).collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows) > 5
    for r in rows:
        words, h = docs[r["doc_id"]].encode().split(), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain(words) if len(words) < 3000 else periodic.find([b" ".join(words)])[0][1]
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()


def test_odd_rows(spark):
    got = periodic.detect(odd_frame(spark)).select("doc_id", "text", "spans", "shard", "fp", "periodic.*").collect()
    assert len(got) == len(ODD) and {r["fp"] for r in got} == {"y"}
    for r in got:
        words = (r["text"] or "").split(" ") if (r["text"] or "").strip() else []
        words = [w for w in words if w.strip(" \t\n")]
        runs = plain(words)
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == runs
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic.detect(empty_frame(spark)).count() == 0
