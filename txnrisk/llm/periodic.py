"""Periodic runs of words: stretches that repeat with a period, found by a suffix automaton with link-cut access.

Words are runs of anything but ASCII white space, compared byte by byte.  A run is a stretch of consecutive words with smallest period q (words q
apart are identical) and a length of at least max(``MIN_LENGTH``, ``MIN_EXPONENT`` * q) that no neighbouring word extends keeping the period.

Method.  The suffix automaton of the words has a tree of suffix links.  Reading the words in order, ``access`` of the state of each prefix makes its path to the
root one preferred path and gives it the number of the word just read as its colour: the last place where its strings ended.  The stretches of other
colours that it passes are the strings ending here that ended before: a stretch with colour e whose longest string has l words is a repetition with distance
p = i - e, and contains a square if p <= l.  Such a repetition is l + p words long and cannot be extended to the left (l is the longest), and a
primitive word does not occur inside its own square except at both ends, so p is the smallest period.  It is a run if the next word does not go on with the
period.  Splay trees over preferred paths make an access logarithmic on average.

Every run consists of windows of ``MIN_LENGTH`` * (1 - 1/``MIN_EXPONENT``) words that occur twice in the text, so words outside all such windows are in no run.
Equal hashes of windows find these stretches for many texts at once, and only they go through the automaton, each by itself: a run never crosses
their borders.  (Windows with equal hashes by chance only make a stretch longer.)

One pass without a shuffle; a task holds one batch of texts, and the automaton of one stretch (linear in its words).  Null and empty texts have no words and no
runs.  Rows may repeat or lack an ID: each is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import encoded, small_batches
from txnrisk.llm.substring import window_hashes
from txnrisk.llm.superkmers import mix, union

MIN_LENGTH = 24
MIN_EXPONENT = 3


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of every state, and the state of every prefix.  State 1 is the root; 0 means none."""
    follow: list[dict[int, int]] = [{}, {}]
    length, link, prefix = [0, 0], [0, 0], []
    last = 1
    for w in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(1)
        follow.append({})
        at = last
        while at and w not in follow[at]:
            follow[at][w] = new
            at = link[at]
        if at:
            to = follow[at][w]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                follow.append(follow[to].copy())
                while at and follow[at].get(w) == to:
                    follow[at][w] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
        prefix.append(new)
    return length, link, prefix


class LinkCutTree:
    """Preferred paths of a rooted tree, each a splay tree ordered by depth.  A path has one colour, kept at its splay root."""

    def __init__(self, parent: list[int]):
        n = len(parent)
        self.up = list(parent)   # parent in the splay tree, or in the tree for a splay root
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner:
                above = up[g]
                if left[above] == g:
                    side = 1
                elif right[above] == g:
                    side = 2
                else:
                    side = 0
                if left[g] == p:
                    if left[p] == x:    # both to the left: the grandparent turns first
                        b, c = right[p], right[x]
                        left[g], right[p], left[p], right[x] = b, g, c, p
                        up[b], up[g], up[c], up[p] = g, p, p, x
                    else:
                        b, c = left[x], right[x]
                        right[p], left[g], left[x], right[x] = b, c, p, g
                        up[b], up[c], up[p], up[g] = p, g, x, x
                elif right[p] == x:
                    b, c = left[p], left[x]
                    right[g], left[p], right[p], left[x] = b, g, c, p
                    up[b], up[g], up[c], up[p] = g, p, p, x
                else:
                    b, c = right[x], left[x]
                    left[p], right[g], right[x], left[x] = b, c, p, g
                    up[b], up[c], up[p], up[g] = p, g, x, x
                top = g
            else:
                above, side = g, 0
                if left[p] == x:
                    b = right[x]
                    left[p], right[x] = b, p
                else:
                    b = left[x]
                    right[p], left[x] = b, p
                up[b], up[p] = p, x
                top = p
            up[x] = above
            if side == 1:
                left[above] = x
            elif side == 2:
                right[above] = x
            else:
                self.colour[x] = self.colour[top]
                return
            p = above

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Make the path from the root to ``x`` one preferred path of this colour.

        Returns the stretches it was made of, the deepest first: their colour and their deepest node.
        """
        up, right, shade = self.up, self.right, self.colour
        passed, below = [], 0
        while x:
            self.splay(x)
            passed.append((shade[x], x))
            cut = right[x]
            if cut:  # what lies below on the old path keeps its colour
                shade[cut] = shade[x]
            right[x] = below
            if below:
                up[below] = x
            shade[x] = colour
            below, x = x, up[x]
        return passed


def stretch_runs(words: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run."""
    length, link, prefix = suffix_automaton(words)
    tree, out, n = LinkCutTree(link), [], len(words)
    for i, state in enumerate(prefix):
        for before, deepest in tree.access(state, i):
            if before < 0:
                continue
            period, longest = i - before, length[deepest]
            if longest >= (min_exponent - 1) * period and longest + period >= min_length and (i + 1 == n or words[i + 1] != words[i + 1 - period]):
                out.append((i + 1 - longest - period, longest + period, period))
    return sorted(out)


def stretches(ids: np.ndarray, sizes: list[int], window: int) -> Iterator[tuple[int, int, int]]:
    """(text, first word, end) of the stretches covered by windows that occur twice in their text."""
    if len(ids) < window:
        return
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keys = window_hashes(mix(ids.astype(np.uint64) + np.uint64(1)), window)
    at = np.flatnonzero(owner[: len(keys)] == owner[window - 1:])
    keys = keys[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.sort(at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]) if len(at) else at
    if not len(twice):
        return
    base = np.cumsum([0, *sizes])
    # Windows that only touch are one stretch as well: a run may be just two neighbouring windows.
    for whose, start, end in sorted((int(owner[s]), int(s), int(e)) for s, e in zip(*union(twice, twice + window))):
        while end > base[whose + 1]:  # the last window of a text touches the first one of the next
            yield whose, start - int(base[whose]), int(base[whose + 1] - base[whose])
            start = int(base[whose + 1])
            whose = int(owner[start])
        yield whose, start - int(base[whose]), end - int(base[whose])


def find(texts: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of every text."""
    words = [t.split() for t in texts]
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for t in words for w in t), np.int64)
    out: list[tuple[list[bytes], list[tuple[int, int, int]]]] = [(w, []) for w in words]
    base = np.cumsum([0, *map(len, words)])
    window = max(1, min_length * (min_exponent - 1) // min_exponent)
    for whose, start, end in stretches(ids, [len(w) for w in words], window):
        if end - start >= min_length:
            at = int(base[whose])
            out[whose][1].extend((s + start, n, p) for s, n, p in stretch_runs(ids[at + start:at + end].tolist(), min_length, min_exponent))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, joined by one blank."""
    kept, behind = [], 0
    for start, end in sorted((s + p, s + n) for s, n, p in runs):
        kept += words[behind:max(behind, start)]
        behind = max(behind, end)
    return b" ".join(kept + words[behind:])


RUNS_DDL = "array<struct<start: long, length: long, period: long>>"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(df: DataFrame, text: str = "text", into: str = "periodic", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``df`` with a column ``into``: the text's number of words, its runs (by start, then period) and the collapsed text.

    ``min_exponent`` is 2 at least.
    """
    small_batches(df.sparkSession)
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

    @F.arrow_udf(f"struct<n_words: long, runs: {RUNS_DDL}, collapsed: string>")
    def run(texts: pa.Array) -> pa.Array:
        rows = [
            {"n_words": len(words), "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs], "collapsed": collapsed(words, runs)}
            for words, runs in find(encoded(texts), min_length, min_exponent)
        ]
        return pa.array(rows, kind)

    return df.withColumn(into, run(F.col(text).cast("string")))
