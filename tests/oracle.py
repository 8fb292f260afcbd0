"""Compare a query with its SQL counterpart run by DuckDB on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in value order, one text form per value."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        df[c] = df[c].map(lambda v: None if pd.isna(v) else v).astype(object)
        df[c] = df[c].map(lambda v: "∅" if v is None else (repr(float(v)) if isinstance(v, float) else str(v)))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


KINDS = {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when the two agree."""
    want = con.execute(sql).fetchdf()
    schema = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    got = spark_df.toPandas()
    problems = []
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    duck = {name: str(kind) for name, kind in zip(want.columns, [d[1] for d in con.execute(sql).description])}
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    for c, kind in schema.items():
        if pairs.get(kind, kind) != duck[c]:
            problems.append(f"type of {c}: {kind} vs {duck[c]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    a, b = normal(got), normal(want)
    if len(a) == len(b) and not a.equals(b):
        bad = (a != b).any(axis=1)
        problems.append(f"{bad.sum()} of {len(a)} rows differ, such as\n{a[bad].head(3)}\n{b[bad].head(3)}")
    elif len(a) != len(b):
        merged = a.merge(b, how="outer", indicator=True)
        problems.append(str(merged[merged["_merge"] != "both"].head(6).to_string()))
    return problems
