"""Small frames and plain versions shared by the tests of the training-data operators."""

from __future__ import annotations

import pyarrow as pa

ODD = [
    (None, None), (None, "no id " * 30), (None, "no id " * 30), (7, ""), (7, None), (8, " \t\n"), (9, "one"), (9, "one two"),
    (10, "é" * 900), (11, "a b " * 500), (11, "a b " * 500), (12, "x" * 3000), (13, "Straße 12, İstanbul ΑΣ \u0000 z"),
]


def odd_frame(spark):
    """Nulls, empty and repeated rows, repeated IDs, and extra columns whose names operators use themselves."""
    rows = [(i, t, "x", 1, "y") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, shard int, fp string")


def empty_frame(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


def batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "row_id": pa.array([r[0] for r in rows], pa.int64()), "mark": pa.array([r[1] for r in rows], pa.int32()), "text": pa.array([r[2] for r in rows], pa.string()),
    })
