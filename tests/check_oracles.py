"""Compare registered queries with their DuckDB statements: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return "null"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float) and x == int(x) if isinstance(x, float) and abs(x) < 1e15 else False:
            return str(int(x))
        return str(x)

    return sorted(tuple(cell(x) for x in row) for row in pdf.itertuples(index=False, name=None))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(duck_pdf.columns)}"
    a, b = canonical(spark_pdf), canonical(duck_pdf)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    import __spark_entry__ as entry
    from txnrisk.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows-only {name}: {len(got)} rows in {took:.2f}s", flush=True)
                continue
            problem = compare(got, con.execute(oracles[name]).df())
        except Exception as e:  # report and go on with the next query
            problem, took = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
