"""Run queries in Spark and their checking SQL in DuckDB and compare names, types, counts and values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    out = [tuple(_cell(v) for v in row) for row in df.astype(object).itertuples(index=False)]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


_KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "double": "double", "float": "double",
    "string": "text", "boolean": "bool", "timestamp": "ts", "timestamp_ntz": "ts", "date": "date",
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool",
    "TIMESTAMP": "ts", "DATE": "date",
}


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    rel = con.sql(sql)
    want_types = {c: _KIND.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    have_types = {f.name: _KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    diffs = []
    if sorted(want_types) != sorted(have_types):
        return [f"columns {sorted(have_types)} != {sorted(want_types)}"]
    for c, t in want_types.items():
        if have_types[c] != t:
            diffs.append(f"type of {c}: {have_types[c]} != {t}")
    have, want = rows(spark_df.toPandas()), rows(rel.df())
    if len(have) != len(want):
        diffs.append(f"rows {len(have)} != {len(want)}")
    bad = [(a, b) for a, b in zip(have, want) if a != b]
    if bad:
        diffs.append(f"{len(bad)} rows differ, first {bad[0][0]} != {bad[0][1]}")
    return diffs
