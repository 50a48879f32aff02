import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from txnrisk.llm import queries, repair

BLANK = " \t\n\x0b\x0c\r"


def plain_solve(rows):
    """Dynamic programme over rows and last roles."""
    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            table = dict(table)
            for state, (cost, audit) in list(table.items()):
                better(table, repair.NEXT[state], (cost + 3, audit + "I"))
        return table

    now = {repair.START: (0, "")}
    for row in rows:
        after = {}
        for state, (cost, audit) in inserted(now).items():
            better(after, state, (cost + 4, audit + "D"))
            if row != repair.GONE:
                extra = 3 * row.isupper()
                if (state, row.lower()) in repair.KEEPS:
                    better(after, repair.KEEPS[state, row.lower()], (cost + extra, audit + "K"))
                better(after, repair.NEXT[state], (cost + extra + 3, audit + "R"))
        now = after
    return min(v for s, v in inserted(now).items() if s in repair.ACCEPTS)


def plain_report(rows):
    """Expected row of one conversation from its (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    seen, letters, faults = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        end = text.rstrip(BLANK)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters.append("-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        if fault:
            faults[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = plain_solve("".join(letters))
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        last = out[-1][0][:1] if out else ""
        role = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((role, ""))
        else:
            out.append((rows[at][1] if edit == "K" else role, rows[at][2]))
            at += 1
    text = "\n".join(f"{r}:{t}" for r, t in out)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("block", [1, 2, 5, 32])
def test_search_equals_dynamic_programme(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rng = random.Random(block)
    for _ in range(600):
        rows = "".join(rng.choice("suauauaSUAx-X") for _ in range(rng.randint(0, 16)))
        assert repair.solve(rows) == plain_solve(rows), rows
    rows = "".join(rng.choice("uauauaUAx-") for _ in range(500))
    assert repair.solve(rows) == plain_solve(rows)


def damaged(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["conv_id"]]
        h = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = r["role"] or " ", r["text"] if r["text"] is not None else " "
        if h == 0:
            continue
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        out[r["conv_id"]] += [(r["turn"], "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_plain_version(spark, size):
    sf = f"/root/testdata/{size}"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    expected = {c: plain_report(x)[0] for c, x in damaged(rows).items()}
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op13_conversation_repair(spark, sf).collect()}
    assert got == expected


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [
        (1, 0, "user", "Hi.", "x"), (1, 0, "user", "Hi.", "x"), (1, None, "system", "Be kind.", "x"), (1, 3, None, "what", "x"), (1, 9, "assistant", None, "x"),
        (None, None, "assistant", "No ID.", "x"), (None, None, "assistant", "No ID.", "x"), (2, 5, "user", " \t", "x"), (3, 1, "user", "Same.", "x"), (3, 2, "assistant", "Yes!", "x"),
        (3, 3, "user", "Same.", "x"), (3, 4, "tool", "run.", "x"), (4, None, "", "", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, digest string").repartition(3)
    groups = defaultdict(list)
    for c, t, r, x, _ in sorted(rows, key=lambda v: (v[0] is None, v[0] or 0, v[1] is not None, v[1] or 0)):
        groups[c].append((t, " " if r is None else r, " " if x is None else x))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.report(df).collect()}
    assert got == {c: plain_report(x)[0] for c, x in groups.items()}
    fixed = defaultdict(list)
    for r in repair.repair(df).orderBy("position").collect():
        fixed[r["conv_id"]].append((r["role"], r["text"]))
    assert fixed == {c: out for c, x in groups.items() if (out := plain_report(x)[1])}


def test_a_conversation_with_a_third_of_all_rows(spark):
    rng = random.Random(1)
    hot = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"n{i}.", f"cut {i}", " "])) for i in range(3000)]
    rest = [(100 + i // 4, i % 4, ("user", "assistant")[i % 2], f"t{i}.") for i in range(6000)]
    df = spark.createDataFrame(hot + rest, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.report(df).collect()}
    assert got[7] == plain_report([(t, r, x) for _, t, r, x in hot])[0] and len(got) == 1501


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair.report(df).count() == 0 and repair.repair(df).count() == 0
