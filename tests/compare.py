"""Run registered queries against their SQL and compare rows, types and values."""

from __future__ import annotations

import numbers
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False):
        rows.append(tuple(map(_value, row)))
    return sorted(rows, key=repr)


def _value(v):
    if pd.isna(v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, numbers.Number):
        return float(v)
    return str(pd.Timestamp(v)) if hasattr(v, "year") else v


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(_plain(got), _plain(want)):
        if a != b:
            return f"{sorted(got.columns)}\n  got  {a}\n  want {b}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidemark import session

    spark = session.local(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            got = df.toPandas()
            took = time.time() - started
            if name in sql:
                result = connection.execute(sql[name])
                want = result.df()
                problem = difference(got, want)
                types = dict(zip(want.columns, [str(d[1]) for d in result.description or []]))
                kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            else:
                problem, types, kinds = "no sql", {}, {}
        except Exception as error:
            problem, took, got = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - started, []
            types, kinds = {}, {}
        bad += problem is not None
        print(f"{name:24} {took:6.2f}s rows={len(got):6} {'OK' if not problem else problem}", flush=True)
        same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
        for column, kind in kinds.items():
            if column in types and same.get(kind) != types[column]:
                print(f"    type {column}: {kind} / {types[column]}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
