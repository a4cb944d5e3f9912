"""Runs a Spark query and its DuckDB oracle on the same parquet tables and
compares schema names, row count and order-insensitive values (doubles
rounded to 6 places, as both sides already do)."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (2, str(int(v)))
    if isinstance(v, int):
        return (3, str(v))
    return (4, str(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT", "date": "DATE"}


def type_mismatches(spark_df, rel) -> list[str]:
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [f"{c}: spark {s_types[c]} duck {d_types.get(c)}" for c in s_types
            if c in d_types and s_types[c] != d_types[c]]


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [r.asDict() for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [dict(zip(d_cols, r)) for r in rel.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    bad_types = type_mismatches(spark_df, rel)
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    cols = sorted(s_cols)
    a, b = rows_of(s_rows, cols), rows_of(d_rows, cols)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ (cols={cols}): {diffs}"
    return True, f"{len(s_rows)} rows"
