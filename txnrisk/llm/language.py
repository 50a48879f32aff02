"""Language identification: averaged embeddings of hashed subwords, a linear softmax, calibrated rejection.

Subwords are runs of 2 to 4 bytes of the lower-cased text with everything but letters turned into blanks; a blank may
stand at either end only, so that beginnings and ends of words count.  Each hashes to one of ``BUCKETS`` embeddings; a text is the
average of its subwords' embeddings, and a linear layer with softmax gives the languages.  Embeddings and layer are trained in
numpy on the driver by stochastic gradient descent, from a bounded number of documents per language; only their hashed counts
leave the tasks.  One part of them, kept back, sets the temperature of the softmax and the score below which an answer is marked
as rejected (``rejected``; the best language is given all the same).

A text that is null or has no letter is ``und`` with score 1.  Without any labelled row every text is ``und`` with score 0.  Texts without
subwords (one letter) get the learned prior.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
SIZES = (2, 3, 4)
DIMENSIONS = 16
MAX_DOCS_PER_LANGUAGE = 300
MAX_LANGUAGES = 1000       # values of the language column; more are an error
EPOCHS, BATCH, RATE = 12, 32, 4.0
KEPT_BACK = 5              # one in so many training documents calibrates
WANTED_PRECISION = 0.995   # of answers that are not rejected
SLICE_CHARS = 400_000
SNIPPETS = (40, 160)       # characters of the extra training pieces taken from each document
UNKNOWN = "und"

_BLANKS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """Lower-cased UTF-8 bytes with ASCII characters other than letters as blanks, one blank at either end."""
    return b" " + text.lower().encode("utf-8", "replace").translate(_BLANKS) + b" "


def subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the start and the bucket of every subword."""
    blank = data == 32
    wide = data.astype(np.uint64)
    for size in SIZES:
        n = len(data) - size + 1
        if n <= 0:
            continue
        inner = np.zeros(n, bool)
        for k in range(1, size - 1):
            inner |= blank[k:k + n]
        bad = inner | (blank[:n] & blank[size - 1:])
        code = np.full(n, size, np.uint64)
        for k in range(size):
            code = code * np.uint64(257) + wide[k:k + n]
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
        at = np.flatnonzero(~bad)
        yield at, code[at].astype(np.int32)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    data = np.frombuffer(letters(text), np.uint8)
    found = [b for _, b in subwords(data)]
    return np.unique(np.concatenate(found) if found else np.zeros(0, np.int32), return_counts=True)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray      # logits per bucket: embedding times layer, at the calibrated temperature
    bias: np.ndarray
    reject_below: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Softmax rows; texts are joined and worked on in slices."""
        out, held, size = [], [], 0
        for t in [*texts, None]:
            if t is not None:
                held.append(letters(t))
                size += len(held[-1])
            if held and (t is None or size > SLICE_CHARS):
                out.append(self.slice(held))
                held, size = [], 0
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def slice(self, held: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(h) for h in held])
        data = np.frombuffer(b"".join(held), np.uint8)  # a blank at both ends: no subword crosses texts
        total, n = np.zeros((len(held), len(self.languages))), np.zeros(len(held))
        for at, bucket in subwords(data):
            edge = np.searchsorted(at, np.concatenate([[0], ends]))
            n += np.diff(edge)
            for k in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.table[bucket, k], dtype=np.float64)])
                total[:, k] += sums[edge[1:]] - sums[edge[:-1]]
        return softmax(total / np.maximum(n, 1)[:, None] + self.bias)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        language, score, rejected = [UNKNOWN] * len(texts), [1.0] * len(texts), [True] * len(texts)
        if not self.languages:
            return language, [0.0] * len(texts), rejected
        for i, p in zip(known, self.probabilities([texts[i] for i in known])):
            best = int(p.argmax())
            language[i], score[i], rejected[i] = self.languages[best], float(p[best]), bool(p[best] < self.reject_below)
        return language, score, rejected


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def averages(rows: list[tuple[np.ndarray, np.ndarray]], embeddings: np.ndarray) -> np.ndarray:
    return np.stack([c @ embeddings[b] / max(1, c.sum()) for b, c in rows]) if rows else np.zeros((0, embeddings.shape[1]))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], names: list[str], held: list[bool], seed: int = 42) -> LanguageModel:
    """Train on the rows (buckets, counts) that are not ``held`` back, calibrate on the others."""
    languages = sorted(set(names))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    y = np.array([languages.index(n) for n in names])
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer, bias = rng.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    learn = np.flatnonzero(~np.array(held)) if not all(held) else np.arange(len(y))
    weight = 1 / np.bincount(y[learn], minlength=len(languages)).clip(1)  # languages count alike
    weight = weight / weight[y[learn]].mean()
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            some = learn[at:at + BATCH]
            batch = [rows[i] for i in some]
            mean = averages(batch, embeddings)
            slope = softmax(mean @ layer + bias)
            slope[np.arange(len(some)), y[some]] -= 1
            slope *= weight[y[some]][:, None] / len(some)
            back = slope @ layer.T
            layer -= rate * mean.T @ slope
            bias -= 0.1 * rate * slope.sum(axis=0)
            for (b, c), g in zip(batch, back):  # buckets of one row are distinct
                embeddings[b] -= rate * len(some) * (c / max(1, c.sum()))[:, None] * g
    check = np.flatnonzero(held) if any(held) else learn
    logits = averages([rows[i] for i in check], embeddings) @ layer + bias
    heat = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0), key=lambda t: -np.log(softmax(logits / t)[np.arange(len(check)), y[check]].clip(1e-12)).mean())
    p = softmax(logits / heat)
    return LanguageModel(languages, (embeddings @ layer / heat).astype(np.float32), bias / heat, rejection(p.max(axis=1), p.argmax(axis=1) == y[check]))


def rejection(score: np.ndarray, right: np.ndarray) -> float:
    """Smallest score from which on the answers are right often enough."""
    order = np.argsort(-score)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(precise >= WANTED_PRECISION)
    return float(score[order][enough[-1]]) if len(enough) else 1.0


# --------------------------------------------------------------------------- Spark

def train(df: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", per_language: int = MAX_DOCS_PER_LANGUAGE) -> LanguageModel:
    """Model from the ``per_language`` documents of each language with the smallest hashes of ``key`` and text, over all rows of ``df``.

    Equal rows count as one document; a missing or repeated ID does not matter.
    """
    rows = df.select(F.col(text).cast("string").alias("t"), F.col(language).cast("string").alias("l"), F.col(key).alias("k")).where("t is not null and l is not null")
    rows = rows.select("t", "l", F.shiftrightunsigned(F.xxhash64("k", "t"), 1).alias("h"))
    last = last_hashes(rows.select("l", "h"), per_language)
    if not last:
        return fit([], [], [])

    @F.arrow_udf("array<struct<held:boolean,bucket:array<int>,n:array<int>>>")
    def examples(texts: pa.Array, keys: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("held", pa.bool_()), ("bucket", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))
        out = []
        for t, k in zip(texts.to_pylist(), keys.to_pylist()):
            parts = [t, *(t[(at := k % max(1, len(t) - size)):at + size] for size in SNIPPETS)]
            found = [counts(p) for p in parts]
            out.append([{"held": k % KEPT_BACK == 0, "bucket": b, "n": n.astype(np.int32)} for b, n in found if len(b)])
        return pa.array(out, type=kind)

    # Hashes as literals: a join would send all texts to their languages' tasks.
    drawn = rows.where(F.col("h") <= by_language(last)).groupBy("l", "h").agg(F.min("t").alias("t"))
    drawn = drawn.select("l", F.explode(examples("t", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)))).alias("e"))
    found = drawn.select("l", "e.held", "e.bucket", "e.n").collect()
    found.sort(key=lambda r: (r["l"], r["bucket"], r["n"]))
    return fit([(np.array(r["bucket"], np.int32), np.array(r["n"], float)) for r in found], [r["l"] for r in found], [r["held"] for r in found])


def by_language(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("l")]


def smallest_task(wanted: int):
    """Task that keeps the ``wanted`` smallest distinct hashes per language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, np.ndarray] = {}
        for b in batches:
            codes = b["l"].dictionary_encode()
            index, h = codes.indices.to_numpy(), b["h"].to_numpy()
            for k, name in enumerate(codes.dictionary.to_pylist()):
                least[name] = np.unique(np.concatenate([least.get(name, h[:0]), h[index == k]]))[:wanted]
            if len(least) > MAX_LANGUAGES:
                raise ValueError(f"More than {MAX_LANGUAGES} languages")
        for name, h in least.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(h, pa.int64())], names=["l", "h"])
    return run


def last_hashes(rows: DataFrame, wanted: int) -> dict[str, int]:
    """For each language ``l``, the ``wanted``-th smallest distinct hash ``h``, or the largest if there are fewer.

    A task passes on the ``wanted`` smallest hashes it saw of each language, no others can be among the smallest of all.  These are counted in quarter
    octaves; only those up to the one that reaches ``wanted``, about a fifth more than wanted at most, come to the driver.
    """
    rows = rows.mapInArrow(smallest_task(wanted), "l string, h long")
    rows = rows.withColumn("octave", F.floor(4 * F.log2(F.col("h").cast("double") + 1)).cast("int"))  # 0 to 252
    counted = rows.distinct().groupBy("l", "octave").agg(F.count("*").alias("n")).limit(253 * MAX_LANGUAGES + 1).collect()
    edge, reached = {}, Counter()
    for r in sorted(counted, key=lambda r: r["octave"]):
        if reached[r["l"]] < wanted:
            edge[r["l"]] = r["octave"]
            reached[r["l"]] += r["n"]
    if len(edge) > MAX_LANGUAGES:
        raise ValueError(f"More than {MAX_LANGUAGES} languages")
    if not edge:
        return {}
    hashes = defaultdict(list)
    for r in rows.where(F.col("octave") <= by_language(edge)).select("l", "h").distinct().collect():
        hashes[r["l"]].append(r["h"])
    return {name: sorted(h)[:wanted][-1] for name, h in hashes.items()}


def identified(text: Column, model: LanguageModel) -> Column:
    """Struct column ``lang_pred``, ``score``, ``rejected``."""
    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        language, score, rejected = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["lang_pred", "score", "rejected"])

    return run(text)
