"""Runs every query in Spark and its statement in DuckDB and compares the results.

    python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

LAST: dict[str, float] = {}  # when the Spark side of the latest comparison was done
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_value(r[i]) for i in order) for r in rows)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, statement: str) -> str:
    """'' if both give the same columns and rows, else what differs."""
    got_names, got = _bag(df.columns, df.collect())
    LAST["spark"] = time.time()
    result = con.execute(statement)
    want_names, want = _bag([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if got != want:
        extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} / {sum(want.values())} rows\n  spark  {extra}\n  duckdb {lacking}"
    return "" if got else "no rows"


def main(sf_dir: str, *wanted: str) -> int:
    from voxsift.functions import staging
    from voxsift.session import build_session

    from .oracle import all_statements
    from .queries import all_queries

    spark = build_session("compare", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, statements, bad = oracle(sf_dir), all_statements(), 0
    for name, run in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in statements:
                problem = difference(df, con, statements[name])
            else:
                problem = "" if df.collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        spent, oracle_spent = LAST.get("spark", start) - start, time.time() - LAST.get("spark", start)
        print(
            f"{'DIFF' if problem else 'ok  '} {name:26} spark {spent:6.2f} s, "
            f"duckdb {oracle_spent:5.2f} s {problem}", flush=True,
        )
    staging.clear(spark)
    print("all equal" if not bad else f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
