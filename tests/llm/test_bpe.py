import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import ODD, empty_frame, odd_frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnrisk.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def same(library, own, texts):
    for text, packed in zip(texts, own.encode(texts, {})):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_hard_texts(library, own):
    same(library, own, [
        "", " ", "it's I'LL o're 'sun", "<|startoftext|>Hi <|endoftext|>x<|startoftext|", "é Å ẛ̣", "ΑΣ Σ İ ǅ", "12 3４ ½ ⅷ", "x" * 5000, "ab" * 100 + "!" * 300,
        "日本語のテキスト", "a\u0085b c d​e", "👩‍👩‍👧 ok", "\x00\x1c\x1f", "naïve CAFÉ ﬁ",
    ])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", categories=("L", "M", "N", "P", "S", "Z")).filter(lambda c: ord(c) < 0x530), max_size=60))
def test_random_texts(library, own, text):
    same(library, own, [text])


def test_short_and_long_words_agree(own):
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 20, bpe.SHORT):
        word = bytes(rng.choice(list(b"theanrieos"), n).tolist())
        assert own.encode_rows([word])[0] == own.encode_long(word)


def test_pieces_and_cache_bounds(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    same(library, own, ["the quick brown fox " * 40, "a" * 200 + " b", "one\ntwo three"])


def test_query_equals_the_library(spark, sf, library):
    rows = {r["doc_id"]: r for r in queries.op10_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    out = bpe.encode_documents(odd_frame(spark), PATH, into="spans").collect()
    assert sorted(r["spans"] for r in out) == sorted(library.encode(t or "", add_special_tokens=False).ids for _, t in ODD)
    assert bpe.encode_documents(empty_frame(spark), PATH).count() == 0
    codec = bpe.Codec(spark, PATH)
    nothing = spark.createDataFrame([(None,)], "x binary").select(codec.decode_packed(F.col("x")).alias("t"), bpe.unpacked(F.col("x")).alias("i")).first()
    assert nothing["t"] == "" and nothing["i"] == []
