"""Compare a query with its SQL on the same tables: names, row count and every value."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    names = {"bigint": "int64", "int": "int32", "integer": "int32", "string": "text", "varchar": "text",
             "timestamp_ntz": "timestamp"}
    return names.get(dtype, dtype)


def _rows(frame: pd.DataFrame, columns: list[str]) -> list[tuple]:
    def plain(value):
        return None if value is None or value is pd.NaT or value != value else value

    return sorted(([tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False)]), key=repr)


def mismatch(df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, otherwise the first difference."""
    spark_types = {n: _kind(t) for n, t in df.dtypes}
    relation = db.sql(sql)
    sql_types = {n: _kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    if spark_types != sql_types:
        return f"schema: {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    columns = sorted(spark_types)
    left = _rows(pd.DataFrame([r.asDict() for r in df.collect()], columns=columns, dtype=object), columns)
    right = _rows(pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object), columns)
    if len(left) != len(right):
        return f"rows: {len(left)} against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"values of {columns}: {a} against {b}"
    return None if left else "no rows"
