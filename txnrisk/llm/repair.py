"""Conversation structure repair: the cheapest edits that make a conversation well formed, by iterative-deepening A*.

A well-formed conversation is empty, or an optional system turn and then user and assistant turns by turns, ending with the assistant: its role
initials match ``(s?(ua)+)?``.  A row's first fault counts: *blank* (nothing but ASCII white space), *duplicate* (role and text seen earlier in the
conversation), *truncated* (the last such character is none of ``.!?``).  Edits of a row: Keep (0), Rerole to user or assistant (3), Delete (4; the only
one for blank and duplicate rows); an empty row of user or assistant can be Inserted anywhere (3).  A truncated row that is not deleted costs 3 more.
The audit names the edits by their initials in order; of equally cheap ones the smallest in ASCII order is the answer.

Search.  Depth-first in the order D, I, K, R under a bound on cost so far plus the cost that faults still to come force at least.  States that failed
are kept with the budget they failed under and not tried again with that or less.  If nothing is accepted, the bound grows to the least sum
that went over it.  The first accepting path is the answer.  A conversation of over ``BLOCK_ROWS`` rows is searched block by block, from every role that may
stand before a block to every role that may end it, and the blocks' answers are chained: equally cheap paths over the same rows to the same role are never a
prefix of each other, so the cheapest and then smallest chain is the whole answer.

Work.  Rows equal in conversation, turn, role and text are folded to one with a count; a digest of role and text marks the first of repeated ones by a
partial aggregate.  Rows without texts are then sorted by conversation and turn, and a task reads one conversation after the other, holding one letter a row.
The repaired texts are written (or hashed) by a second pass over rows in the same order, each conversation led by its audit; no task holds a conversation's texts.
A conversation's audit and digest are one cell each, so one task passes over it.

Null roles and texts are one blank.  A null conversation ID is a conversation like any other.  Null turns come first.  Rows with the same turn are taken in
the order of role and digest.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 32
RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # the last role of what is repaired so far
BLANK = " \t\n\x0b\x0c\r"

# The role that must follow each state, and the state after it (user or assistant).
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTS = (START, ASSISTANT)
ROLE = {USER: "user", ASSISTANT: "assistant"}

# A row as one letter: its initial (other ones as "x"), in upper case if truncated, or "-" if it has to go.
GONE = "-"


def cheapest(rows: str, start: int, goals: tuple[int, ...], closing: bool) -> tuple[int, str, int] | None:
    """Cost, audit and last state of the cheapest path from ``start`` over all rows to one of ``goals``.

    ``closing``: rows may be inserted after the last one, as only the last block does.  None if no path leads there.
    """
    forced = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        forced[i] = forced[i + 1] + (DELETE if rows[i] == GONE else TRUNCATED if rows[i].isupper() else 0)
    failed: dict[tuple[int, int], int] = {}
    over = None  # the least sum beyond the bound

    def search(i: int, state: int, cost: int, bound: int) -> tuple[int, str, int] | None:
        nonlocal over
        total = cost + forced[i]
        if total > bound:
            over = total if over is None else min(over, total)
            return None
        if i == len(rows) and state in goals:
            return cost, "", state
        budget = bound - cost
        if failed.get((i, state), -1) >= budget:
            return None
        if i < len(rows):
            if found := search(i + 1, state, cost + DELETE, bound):
                return found[0], "D" + found[1], found[2]
        follows = NEXT[state]
        if i < len(rows) or closing:
            if found := search(i, follows, cost + INSERT, bound):
                return found[0], "I" + found[1], found[2]
        if i < len(rows) and rows[i] != GONE:
            letter, extra = rows[i].lower(), TRUNCATED * rows[i].isupper()
            kept = KEEPS.get((state, letter))
            if kept is not None and (found := search(i + 1, kept, cost + extra, bound)):
                return found[0], "K" + found[1], found[2]
            if kept != follows and (found := search(i + 1, follows, cost + extra + RETAG, bound)):
                return found[0], "R" + found[1], found[2]
        failed[i, state] = budget
        return None

    # No path needs more than this: delete every row, then insert to the goal, or insert one row of each role around every row that stays.
    bound, most = forced[0], (DELETE + 2 * INSERT + TRUNCATED) * (len(rows) + 1) + 2 * INSERT
    while bound <= most:
        over = None
        if found := search(0, start, 0, bound):
            return found
        if over is None:
            return None
        bound = over
    return None


class Chain:
    """Cheapest (cost, audit) by last state, over the blocks so far."""

    def __init__(self):
        self.best: dict[int, tuple[int, list[str]]] = {START: (0, [])}

    def add(self, rows: str) -> None:
        after: dict[int, tuple[int, list[str]]] = {}
        for state, (cost, audit) in self.best.items():
            for goal in (START, SYSTEM, USER, ASSISTANT):
                found = cheapest(rows, state, (goal,), closing=False)
                if found is None:
                    continue
                total = cost + found[0]
                held = after.get(goal)
                if held is None or total < held[0] or (total == held[0] and "".join(audit) + found[1] < "".join(held[1])):
                    after[goal] = (total, [*audit, found[1]])
        self.best = {state: (cost, ["".join(audit)]) for state, (cost, audit) in after.items()}

    def close(self, rows: str) -> tuple[int, str]:
        ends = [(cost + found[0], "".join(audit) + found[1]) for state, (cost, audit) in self.best.items() if (found := cheapest(rows, state, ACCEPTS, closing=True))]
        return min(ends)


def solve(rows: str) -> tuple[int, str]:
    """Cost and audit of one conversation from its rows' letters."""
    chain = Chain()
    while len(rows) > BLOCK_ROWS:
        chain.add(rows[:BLOCK_ROWS])
        rows = rows[BLOCK_ROWS:]
    return chain.close(rows)


# --------------------------------------------------------------------------- Spark

def marked(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows: ``conv``, ``turn``, ``role``, ``text``, ``digest``, ``copies``."""
    rows = df.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    return rows.withColumn("digest", digest)


def letter(role: Column, text: Column) -> Column:
    """A row's letter, without regard to duplicates."""
    end = F.rtrim(text, F.lit(BLANK))
    initial = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise("x")
    whole = F.right(end, F.lit(1)).isin(".", "!", "?")
    return F.when(end == "", F.lit("b")).otherwise(F.when(whole, initial).otherwise(F.upper(initial)))


AUDITS = pa.schema([
    ("first", pa.bool_()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()),
])


class Conversation:
    """What one pass keeps of a conversation: counts, the rows not yet searched, and the chain."""

    def __init__(self):
        self.turns = self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last = self.before = None
        self.waiting, self.chain = "", Chain()

    def add(self, turn: int | None, initial: str, mark: str, copies: int, first: bool) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        self.illegal += (self.before is not None and self.before + initial not in ("su", "ua", "au")) + (copies - 1) * (initial + initial not in ("su", "ua", "au"))
        self.before = initial
        if mark == "b":
            self.blank += copies
            self.put(GONE, copies)
            return
        if first:
            self.truncated += mark.isupper()
            self.put(mark, 1)
        self.duplicate += copies - first
        self.put(GONE, copies - first)

    def put(self, mark: str, n: int) -> None:
        while n > 0:
            take = min(n, BLOCK_ROWS + 1 - len(self.waiting))
            self.waiting += mark * take
            n -= take
            if len(self.waiting) > BLOCK_ROWS:  # a block is searched once a row beyond it is known
                self.chain.add(self.waiting[:BLOCK_ROWS])
                self.waiting = self.waiting[BLOCK_ROWS:]

    def result(self) -> tuple:
        cost, audit = self.chain.close(self.waiting)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation from ``marked`` rows: its counts, cost and audit."""
    kind = rows.schema["conv"].dataType.simpleString()
    folded = rows.groupBy("conv", "turn", "role", "digest", letter(F.col("role"), F.col("text")).alias("mark")).agg(F.count("*").alias("copies"))
    firsts = rows.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("at"))
    same = F.expr("l.conv <=> r.conv and l.digest = r.digest")
    flat = folded.alias("l").join(firsts.alias("r"), same).select(
        "l.conv", "l.turn", "l.role", "l.digest", F.substring("l.role", 1, 1).alias("initial"), "mark", "copies", F.col("l.turn").eqNullSafe(F.col("r.at.turn")).alias("first"))
    ordered = flat.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, id_type, out, at = None, None, [], None

        def answer() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, f.type) for c, f in zip(columns[1:], list(AUDITS)[1:]))], names=["conv", *AUDITS.names[1:]])

        for b in batches:
            id_type = b["conv"].type
            for conv, turn, initial, mark, copies, first in zip(*(b[c].to_pylist() for c in ("conv", "turn", "initial", "mark", "copies", "first"))):
                if held is None or conv != at:
                    if held is not None:
                        out.append((at, *held.result()))
                    held, at = Conversation(), conv
                held.add(turn, initial, mark, copies, first)
            if len(out) >= 1000:
                yield answer()
        if held is not None:
            out.append((at, *held.result()))
        if out:
            yield answer()

    return ordered.select("conv", "turn", "initial", "mark", "copies", "first").mapInArrow(
        run, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) of a conversation from its audit and its rows, one at a time."""
    state = START
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        follows = NEXT[state]
        if edit == "I":
            state = follows
            yield ROLE[state], ""
            continue
        role, text = next(rows)
        state = KEEPS[state, role[:1]] if edit == "K" else follows
        yield (role if edit == "K" else ROLE[state]), text


def led(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows in conversation order, each conversation after a row that holds its audit."""
    leads = found.select("conv", F.lit(0).alias("lead"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"))
    follow = rows.select("conv", F.lit(1).alias("lead"), "turn", "role", "digest", "text")
    return leads.unionByName(follow).repartition("conv").sortWithinPartitions("conv", "lead", "turn", "role", "digest").select("conv", "lead", "role", "text")


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.DataType, str, Iterator[tuple[str, str]]]]:
    """ID, its type, audit and rows of one conversation after the other; a conversation's rows must be used up before the next."""
    def flat():
        for b in batches:
            kind = b["conv"].type
            for row in zip(*(b[c].to_pylist() for c in ("conv", "lead", "role", "text"))):
                yield kind, *row

    rows = flat()
    head = next(rows, None)
    while head is not None:
        kind, conv, _, _, audit = head
        following = [None]

        def own():
            for r in rows:
                if not r[2]:
                    following[0] = r
                    return
                yield r[3], r[4]

        mine = own()
        yield conv, kind, audit, mine
        for _ in mine:
            pass
        head = following[0]


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv``, ``position`` (from 0), ``role``, ``text``."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, id_type = [], None

        def answer() -> pa.RecordBatch:
            c = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c[0], id_type), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.string())], names=["conv", "position", "role", "text"])

        for conv, id_type, audit, mine in conversations(batches):  # noqa: B007
            for position, (role, text) in enumerate(edited(audit, mine)):
                out.append((conv, position, role, text))
                if len(out) >= 1000:
                    yield answer()
        if out:
            yield answer()

    return led(rows, found).mapInArrow(run, f"conv {kind}, position long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv`` and the SHA-256 of its repaired rows as ``role:text``, joined by line feeds."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out, id_type = [], [], None
        for conv, id_type, audit, mine in conversations(batches):
            total, gap = hashlib.sha256(), b""
            for role, text in edited(audit, mine):
                total.update(gap + f"{role}:{text}".encode())
                gap = b"\n"
            ids.append(conv)
            out.append(total.hexdigest())
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(out, pa.string())], names=["conv", "repaired_sha256"])

    return led(rows, found).mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def report(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``df``: ``conv_id``, gaps in its turns, faults, illegal neighbours, cost and audit of the repair, digest of the result."""
    rows = marked(df, conv_id, turn, role, text)
    found = audits(rows)
    both = found.alias("l").join(digests(rows, found).alias("r"), F.expr("l.conv <=> r.conv"))
    return both.select(F.col("l.conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations of ``df``: ``conv_id``, ``position``, ``role``, ``text``."""
    rows = marked(df, conv_id, turn, role, text)
    return repaired(rows, audits(rows)).withColumnRenamed("conv", "conv_id")
