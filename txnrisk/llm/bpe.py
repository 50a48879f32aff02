"""Byte-pair encoding with a contiguous array of ranks per short word, and decoding.

A word is a row of parts (token IDs) and, between neighbours, the rank of their merge.  Encoding scans the row for the
smallest rank, deletes that boundary, and looks up the ranks on either side anew, until no merge is left.  All short
words of one length lie in one matrix, so a scan is one ``argmin`` over its rows.  The scan costs the square of a
word's length; words above ``SHORT`` bytes go through a heap instead, with the same result (smallest rank, then leftmost).

Texts pass through the vocabulary file's own steps: the added tokens are cut out of the raw text, the rest is NFC-
normalised, white space folded, lower-cased per code point and split into letters, single numerals and other runs;
every word's UTF-8 bytes start as one part each, the last one with the end-of-word mark.  A null text counts as empty:
no tokens, and the decoded text is empty.  Texts of any length work, in pieces cut before white space.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHORT = 48              # bytes up to which a word is merged by scanning
CACHE_WORDS = 300_000   # words a task remembers; beyond, it starts anew
PIECE_CHARS = 500_000   # a longer text is worked on in pieces
NO_RANK = np.int32(2**31 - 1)

# Fixed value: the file's pattern for words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Code points that the file's patterns count as white space.
SPACES = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_chars() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Token strings, byte parts and merge ranks of a word-end BPE file, as arrays."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.added.values()]))
        for text, k in {**ids, **self.added}.items():
            self.tokens[k] = text
        chars = byte_chars()
        self.inner = np.array([ids[c] for c in chars], np.int32)
        self.last = np.array([ids[c + self.suffix] for c in chars], np.int32)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        pairs = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], np.arange(len(pairs), dtype=np.int32)[order]
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of parts, or ``NO_RANK``."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_RANK)

    # ------------------------------------------------------------------ words to parts

    def encode_rows(self, words: list[bytes]) -> list[bytes]:
        """Packed IDs of words that all have the same, short length."""
        parts = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        parts = np.concatenate([self.inner[parts[:, :-1]], self.last[parts[:, -1:]]], axis=1)
        out: list[bytes] = [b""] * len(words)
        rows = np.arange(len(words))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            width = parts.shape[1]
            if width == 1:
                for r, p in zip(rows.tolist(), parts):
                    out[r] = p.tobytes()
                break
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NO_RANK
            if done.any():
                for r, p in zip(rows[done].tolist(), parts[done]):
                    out[r] = p.tobytes()
                left = ~done
                rows, parts, ranks, at, best = rows[left], parts[left], ranks[left], at[left], best[left]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            parts[each, at] = self.merged[best]
            keep = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])  # boundary behind part `at` goes
            parts = np.take_along_axis(parts, keep, axis=1)
            gone = np.arange(width - 2)
            ranks = np.take_along_axis(ranks, gone + (gone >= at[:, None]), axis=1)
            for side in (at - 1, at):  # ranks to the left and to the right of the new part
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[ok, side[ok]] = self.rank(parts[ok, side[ok]], parts[ok, side[ok] + 1])
        return out

    def encode_long(self, word: bytes) -> bytes:
        """Packed IDs of one word of any length: a heap of merges over linked parts."""
        raw = np.frombuffer(word, np.uint8)
        parts = [*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]
        before, after = [*range(-1, len(parts) - 1)], [*range(1, len(parts) + 1)]
        first = self.rank(np.array(parts[:-1], np.int32), np.array(parts[1:], np.int32))
        heap = [(int(first[i]), int(i), parts[i], parts[i + 1]) for i in np.flatnonzero(first != NO_RANK)]
        heapq.heapify(heap)
        table = self.pair_table()
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue  # one side was merged meanwhile
            parts[i], parts[j], after[i] = int(self.merged[rank]), -1, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else len(parts)
                if y < len(parts) and (r := table.get((parts[x] << 32) | parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    @lru_cache(maxsize=1)
    def pair_table(self) -> dict[int, int]:
        return dict(zip(self.pairs.tolist(), self.ranks.tolist()))

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        out = {}
        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            if len(raw) > SHORT:
                out[w] = self.encode_long(raw)
            else:
                by_length.setdefault(len(raw), []).append((w, raw))
        for same in by_length.values():
            out.update(zip((w for w, _ in same), self.encode_rows([r for _, r in same])))
        return out

    # ------------------------------------------------------------------ texts

    def words(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words of a text, piece by piece; an added token comes as its ID."""
        for part in self.added_pattern.split(text) if self.added_pattern and any(a in text for a in self.added) else (text,):
            if part in self.added:
                yield self.added[part]
                continue
            for piece in pieces(part):
                yield WORDS.findall(normalise(piece))

    def encode(self, texts: Iterable[str], cache: dict[str, bytes]) -> Iterator[bytes]:
        """Packed IDs (little-endian unsigned 32-bit integers) of each text.

        Texts go in slices of about ``PIECE_CHARS``, so that words new to the task are merged many at a time;
        ``cache`` is what the task remembers, and is emptied here when it grows too large.
        """
        waiting: list[tuple[bool, list[str] | int]] = []  # (ends a text, words or an added token)
        size, done = 0, b""

        def flush() -> Iterator[bytes]:
            nonlocal waiting, size, done
            needed = set().union(*(w for _, w in waiting if not isinstance(w, int)))
            if len(cache) + len(needed) > CACHE_WORDS and len(needed.difference(cache)) + len(cache) > CACHE_WORDS:
                cache.clear()
            cache.update(self.encode_words(list(needed.difference(cache))))
            for ends, words in waiting:
                done += words.to_bytes(4, "little") if isinstance(words, int) else b"".join(map(cache.__getitem__, words))
                if ends:
                    yield done
                    done = b""
            waiting, size = [], 0

        for text in texts:
            for words in self.words(text):
                waiting.append((False, words))
                size += 1 if isinstance(words, int) else len(words)
                if size > PIECE_CHARS // 4:
                    yield from flush()
            waiting.append((True, []))
            if size > PIECE_CHARS // 4:
                yield from flush()
        yield from flush()

    def decode(self, packed: bytes) -> str:
        """Token strings joined by blanks, as the file has no decoder; an unknown ID adds nothing."""
        ids = np.frombuffer(packed, "<u4")
        return " ".join(map(self.tokens.__getitem__, ids[ids < len(self.tokens)].tolist()))


def pieces(text: str) -> Iterator[str]:
    """Pieces of a long text, each cut before an ASCII white-space character: no word crosses a cut."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = max(text.rfind(" ", start + 1, start + PIECE_CHARS), text.rfind("\n", start + 1, start + PIECE_CHARS))
        if cut < 0:
            found = regex.compile(r"[ \n]").search(text, start + PIECE_CHARS)
            cut = found.start() if found else len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


def normalise(text: str) -> str:
    """NFC, white space folded, and each code point lower-cased by itself (no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        text = SPACES.sub(" ", text).replace("\u03a3", "\u03c3")
    return text.lower()


# ---------------------------------------------------------------------- Spark columns

class Codec:
    """Column functions for one vocabulary file.  The file is read on the driver and sent to tasks (a few MB, the
    size of the vocabulary whatever the data)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            self.shared = spark.sparkContext.broadcast(f.read())

    def encode_packed(self, text: Column) -> Column:
        """Binary column: the IDs as little-endian unsigned 32-bit integers."""
        shared = self.shared

        @F.arrow_udf("binary")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary, cache = Vocabulary(shared.value), {}
            for texts in batches:
                yield pa.array(vocabulary.encode((t.as_py() or "" for t in texts), cache), type=pa.binary())

        return run(text)

    def encode(self, text: Column) -> Column:
        """Array column of token IDs."""
        return unpacked(self.encode_packed(text))

    def round_trip(self, text: Column, packed: bool = False) -> Column:
        """Struct of ``ids`` (array, or binary if ``packed``) and ``decoded``, the text decoded from them: one Python worker for both."""
        shared = self.shared

        @F.arrow_udf(f"struct<ids:{'binary' if packed else 'array<int>'},decoded:string>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary, cache = Vocabulary(shared.value), {}
            for texts in batches:
                raw = [*vocabulary.encode((t.as_py() or "" for t in texts), cache)]
                ids = pa.array(raw, type=pa.binary()) if packed else as_lists(raw)
                yield pa.StructArray.from_arrays([ids, pa.array(map(vocabulary.decode, raw), type=pa.string())], ["ids", "decoded"])

        return run(text)

    def decode_packed(self, packed: Column) -> Column:
        """Text column from packed IDs; null gives the empty text."""
        shared = self.shared

        @F.arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = Vocabulary(shared.value)
            for ids in batches:
                yield pa.array((vocabulary.decode(i.as_py() or b"") for i in ids), type=pa.string())

        return run(packed)


def as_lists(raw: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(r) // 4 for r in raw)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def unpacked(packed: Column) -> Column:
    """Array column of the IDs in a packed column; null gives no IDs."""
    @F.arrow_udf("array<int>")
    def run(ids: pa.Array) -> pa.Array:
        return as_lists([i or b"" for i in ids.to_pylist()])

    return run(packed)


def encode_documents(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with an array of token IDs as column ``into`` (an existing column of that name is replaced)."""
    return df.withColumn(into, Codec(df.sparkSession, path).encode(F.col(text)))
