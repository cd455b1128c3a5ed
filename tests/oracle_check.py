"""Run registered queries and their SQL twins side by side; used by the tests and by hand.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


#: Whole numbers by DuckDB's name, as Pandas makes floats of those with nulls.
WHOLE = {"TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint"}
FLOATS = {"FLOAT": "float", "DOUBLE": "double"}


def spark_kinds(frame) -> dict[str, str]:
    return dict(frame.dtypes)


def duck_kinds(con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    """DuckDB's types under Spark's names where values depend on them."""
    return {r[0]: {**WHOLE, **FLOATS}.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def normal(frame: pd.DataFrame, kinds: dict[str, str]) -> pd.DataFrame:
    """Columns by name, values as text, rows in a fixed order."""
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        values = frame[name]
        if kinds[name] in WHOLE.values():
            out[name] = values.map(lambda v: "null" if pd.isna(v) else str(int(v)))
        elif pd.api.types.is_float_dtype(values):
            out[name] = values.map(lambda v: "null" if pd.isna(v) else repr(float(v)))
        elif pd.api.types.is_datetime64_any_dtype(values):
            out[name] = values.map(lambda v: "null" if pd.isna(v) else v.strftime("%Y-%m-%d %H:%M:%S.%f"))
        else:
            out[name] = values.map(lambda v: "null" if v is None or v is pd.NA or v != v else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame, spark_types: dict[str, str], sql_types: dict[str, str]) -> list[str]:
    """What differs in columns, rows, values and number types; types are those of the engines."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"]
    if len(spark_frame) != len(sql_frame):
        return [f"rows {len(spark_frame)} != {len(sql_frame)}"]
    left, right = normal(spark_frame, spark_types), normal(sql_frame, sql_types)
    numbers, problems = {*WHOLE.values(), *FLOATS.values()}, []
    for name in left.columns:
        wrong = left[name] != right[name]
        if wrong.any():
            at = wrong.idxmax()
            problems.append(f"{name}: {int(wrong.sum())} values, first {left[name][at]!r} != {right[name][at]!r}")
        a, b = spark_types[name], sql_types[name]
        if a != b and (a in numbers or b in numbers):
            problems.append(f"{name}: type {a} != {b}")
    return problems


def main(folder: str, names: list[str]) -> int:
    from tillworks.session import build_session
    import __spark_entry__ as entry

    spark = build_session(
        "check", "local[8]", **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            result = frame.toPandas()
        except Exception as problem:  # noqa: BLE001
            print(f"FAIL {name}: {str(problem)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(result)} rows {took:.2f}s", flush=True)
            continue
        try:
            problems = differences(result, con.execute(sql[name]).df(), spark_kinds(frame), duck_kinds(con, sql[name]))
        except Exception as problem:  # noqa: BLE001
            problems = [f"SQL: {str(problem)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name}: {len(result)} rows {took:.2f}s {problems or ''}", flush=True)
    spark.stop()
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, args) else 0)
