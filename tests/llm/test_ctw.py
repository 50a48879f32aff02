import math
import zlib
from collections import Counter, defaultdict

import pytest
from llm.helpers import ODD, empty_frame, odd_frame
from pyspark.sql import functions as F

from txnrisk.llm import ctw, queries


class Plain:
    """Context-tree weighting by its definition: a prediction is the ratio of weighted probabilities with and without one more bit."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, defaultdict(lambda: [0, 0])
        for t in texts:
            for place, context, bit in self.bits(t):
                for d in range(depth + 1):
                    self.counts[place, context[depth - d:]][bit] += 1
        self.children = defaultdict(set)
        for place, context in self.counts:
            if context:
                self.children[place, context[1:]].add((place, context))

    def bits(self, text):
        whole = b"\xff" * self.depth + b" ".join(text.lower().split()) + b"\xff"
        for i in range(self.depth, len(whole)):
            for j in range(8):
                yield (1 << j) | (whole[i] >> (8 - j)), whole[i - self.depth:i], (whole[i] >> (7 - j)) & 1

    @staticmethod
    def kt(n0, n1):
        return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)

    def weighted(self, node, extra):
        """Log weighted probability; ``extra``: node -> bit counted once more."""
        n = list(self.counts[node]) if node in self.counts else [0, 0]
        if node in extra:
            n[extra[node]] += 1
        own = self.kt(*n)
        if len(node[1]) == self.depth:
            return own
        below = sum(self.weighted(c, extra) for c in self.children.get(node, set()) | {e for e in extra if e[0] == node[0] and len(e[1]) == len(node[1]) + 1 and e[1][1:] == node[1]})
        return max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)

    def score(self, text):
        total = 0.0
        for place, context, bit in self.bits(text):
            extra = {(place, context[self.depth - d:]): bit for d in range(self.depth + 1)}
            total += self.weighted((place, b""), extra) - self.weighted((place, b""), {})
        return total / math.log(10)


def plain_base(train, texts):
    tokens = lambda t: [*t.lower().split(), None]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for t in texts]


@pytest.mark.parametrize("chunk", [1, 1 << 20])
@pytest.mark.parametrize("tiers", [(5, 3, 1), (3, 1), (4, 2, 1)])
def test_equals_the_definition(spark, monkeypatch, chunk, tiers):
    monkeypatch.setattr(ctw, "BUCKET_ROWS", 40)
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 50)
    texts = ["abracadabra abra", "ABRA cadabra", None, "", "  the\tcat\nsat on the mat ", "été à la", "the cat", "abra", "aaaaaaaaaaaaaaaaaaaaaaaaaa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in ctw.score(df, F.col("doc_id") < 6, chunk_bytes=chunk, tiers=tiers).collect()}
    whole = [(t or "").encode() for t in texts]
    model = Plain(whole[:6], tiers[0])
    for i, (t, base) in enumerate(zip(whole, plain_base(whole[:6], whole))):
        r = got[i]
        assert r["score"] == pytest.approx(model.score(t), rel=1e-6)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[:3] and r["base_score"] == pytest.approx(base[3], abs=1e-9)
        assert r["held_out"] == (i >= 6) and r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / r["n_bytes"])


def test_pieces_of_long_texts(spark, monkeypatch):
    df = spark.createDataFrame([(1, "one two three " * 40), (2, "x" * 700), (3, "four five")], "doc_id long, text string")
    whole = {r["doc_id"]: r for r in ctw.score(df, F.col("doc_id") < 3).collect()}
    pieces = [*ctw.cut(b"one two three", 5)]
    monkeypatch.setattr(ctw, "PIECE_BYTES", 4)
    cut = [*ctw.cut(b"one two three", 5)]
    assert len(pieces) == 1 and len(cut) == 2 and b"".join(p[5:] for p in cut) == pieces[0][5:]
    assert [w for p in cut for w in ctw.words_of(p, 5)] == [b"one", b"two", b"three", ctw.END_WORD]
    assert whole[1]["n_bytes"] == len("one two three " * 40)


def test_probabilities_of_a_byte_sum_to_one(spark):
    train = [(0, "ab ac ad"), (1, "ba bb")]
    ends = [(10 + c, "a" + chr(c)) for c in range(33, 128) if not chr(c).isupper()]
    df = spark.createDataFrame(train + ends, "doc_id long, text string")
    got = ctw.score(df, F.col("doc_id") < 2).where("doc_id >= 10").agg(F.sum(F.pow(F.lit(10.0), "score"))).first()[0]
    assert 0 < got < 1


def test_large_counts():
    import numpy as np
    n = np.array([0, 1, ctw.TABLE - 1, ctw.TABLE, ctw.TABLE + 1, 10**9])
    for start in (0.5, 1.0):
        assert ctw.log_rise(n, start) == pytest.approx([math.lgamma(x + start) - math.lgamma(start) for x in n.tolist()], rel=1e-12)


def test_query_equals_plain_base(spark, sf):
    rows = queries.op11_context_tree_lm(spark, sf).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    base = dict(zip(docs, plain_base([t for d, t in docs.items() if not held[d]], docs.values())))
    assert len(rows) == len(docs)
    for r in rows:
        n, known, total, score = base[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], n, known, total)
        assert r["base_score"] == pytest.approx(score)


def test_query_beats_word_frequencies(spark):
    out = [r for r in queries.op11_context_tree_lm(spark, "/root/testdata/sf0.1").collect() if r["held_out"]]
    assert len(out) > 1000 and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_odd_rows(spark):
    got = ctw.score(odd_frame(spark), F.col("doc_id") != 9).collect()
    assert len(got) == len(ODD) and all(r["score"] < 0 for r in got)
    assert ctw.score(empty_frame(spark), F.lit(True)).count() == 0
    none = ctw.score(odd_frame(spark), F.lit(None).cast("boolean")).collect()
    assert all(r["score"] == pytest.approx(-8 * r["n_bytes"] * math.log10(2), rel=1e-6) and r["train_tokens"] == 0 for r in none)
