"""Run a registered query on Spark and its oracle on DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

from placestats.fixtures import TABLES

KINDS = {
    "int": "i32", "bigint": "i64", "double": "f64", "string": "str", "boolean": "bool", "date": "date",
    "timestamp_ntz": "ts", "timestamp": "ts",
    "INTEGER": "i32", "BIGINT": "i64", "DOUBLE": "f64", "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date",
    "TIMESTAMP": "ts",
}


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when schema and rows agree."""
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    otypes = {d[0]: str(d[1]) for d in cur.description}
    orows = rows_of(ocols, cur.fetchall())
    cols = spark_df.columns
    problems = []
    if sorted(cols) != sorted(ocols):
        return [f"columns: {sorted(cols)} != {sorted(ocols)}"]
    for c, kind in spark_df.dtypes:
        a, b = KINDS.get(kind, kind), KINDS.get(otypes[c], otypes[c])
        if a != b and "array" not in a:
            problems.append(f"type of {c}: {a} != {b}")
    srows = rows_of(cols, [tuple(r) for r in spark_df.collect()])
    if len(srows) != len(orows):
        problems.append(f"row count: {len(srows)} != {len(orows)}")
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ; columns {sorted(cols)}; first:\n  spark  {bad[0][0]}\n  oracle {bad[0][1]}")
    return problems
