import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import empty_frame, odd_frame
from pyspark.sql import functions as F

from txnrisk.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(text):
    total = 0
    for k, c in enumerate(reversed([c for c in text if c in "0123456789"])):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = sum(c in "0123456789" for c in m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= digits <= 19 and plain_luhn(m[0]), "phone": 9 <= digits <= 15}[kind]
            if ok:
                out.append((m.start(), list(BASE).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def base_of(text):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in pii.find_spans(text) if s["base"]]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+-_% ()9:2é4", max_size=60))
def test_base_spans_follow_the_plain_patterns(text):
    assert base_of(text) == plain_base(text)


def test_hard_cases():
    for text in ("x@y.com_z@w.org", "a@b@c.de", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "4111 1111 1111 1111-", "+1 (743) 555-3824.", "+49 30) 12345678 9", "@a.b"):
        assert base_of(text) == plain_base(text)
    assert base_of("9" * 200_000 + "@" + "a" * 200_000) == []  # linear on long runs


def test_further_kinds_need_their_checks_and_context():
    kinds = lambda t: [s["kind"] for s in pii.find_spans(t)]
    assert "iban" in kinds("IBAN GB82 WEST 1234 5698 7654 32.")
    assert "iban" not in kinds("IBAN GB83 WEST 1234 5698 7654 32.")
    assert "ssn" in kinds("social security 123-45-6789") and "ssn" not in kinds("part 123-45-6789")
    assert "secret" in kinds('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"')
    near, far = (pii.find_spans(t)[0]["score"] for t in ("my card 4111111111111111", "xx 4111111111111111"))
    assert near > far


def test_ibans_of_the_whole_registry():
    ibans = """HR1210010051863000160 SI56263300012039086 BG80BNBG96611020345678 LT121000011101001000 LV80BANK0000435195001 EE382200221020145685
        CY17002001280000001200527600 MT84MALT011000012345MTLCAST001S IS140159260076545510730339 LI21088100002324013AA
        MC5811222000010123456789030 SA0380000000608010167519 AE070331234567890123456 IL620108000000099999999"""
    for iban in ibans.split():
        assert [(s["kind"], s["start"], s["end"]) for s in pii.find_spans(f"account {iban}.") if s["kind"] == "iban"] == [("iban", 8, 8 + len(iban))]


def test_long_secrets_are_found_whole(spark):
    for n in (16, 512, 513, 5_000):
        text = f'token = "{"a7" * n}" and more'
        assert [s["end"] - s["start"] for s in pii.find_spans(text) if s["kind"] == "secret"] == [2 * n]
        assert spark.createDataFrame([(text,)], "t string").select(pii.redacted(F.col("t")).alias("t")).first()["t"] == 'token = "[SECRET]" and more'


def test_query_equals_plain_version(spark, sf):
    rows = {r["doc_id"]: r for r in queries.op1_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        spans, r = plain_base(d["text"]), rows[d["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k + ":") for s in spans) for k in BASE]
        assert set(spans) <= set(r["spans"].split(","))


def test_odd_rows_and_redaction(spark):
    out = pii.detect(odd_frame(spark), into="fp")
    assert out.columns == ["doc_id", "text", "spans", "shard", "fp"] and out.count() == 13
    assert all(r["fp"] == [] for r in out.where("text is null or text = ''").collect())
    assert pii.detect(empty_frame(spark)).count() == 0
    text = "é a.b@c.de, +1 (743) 555-3824 and 4111111111111111!"
    row = spark.createDataFrame([(text,), (None,)], "t string").select(pii.redacted(F.col("t")).alias("t")).collect()
    assert row[0]["t"] == "é [EMAIL], [PHONE] and [CARD]!" and row[1]["t"] is None
