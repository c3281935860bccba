"""Relational targets: create table, replace, upsert.

An upsert writes the rows to a staging table from all executors, then runs one statement in the
database. Rows never pass through the driver, and a repeated run gives the same table.
``connect`` is a function that returns a DB-API connection; credentials stay with the caller.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column types of the target database.
SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE PRECISION", "float": "REAL", "bigint": "BIGINT", "int": "INTEGER",
             "smallint": "SMALLINT", "tinyint": "SMALLINT", "date": "DATE", "boolean": "BOOLEAN", "binary": "BYTEA",
             "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def sql_type(dtype: T.DataType) -> str:
    name = dtype.simpleString()
    if isinstance(dtype, T.DecimalType):
        return f"NUMERIC({dtype.precision}, {dtype.scale})"
    if re.match("(var)?char", name):
        return name.upper()
    if name not in SQL_TYPES:
        raise TypeError(f"no column type for {name}; cast it first")
    return SQL_TYPES[name]


def _quoted(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def create_statement(table: str, schema: T.StructType, keys: list[str] | None = None) -> str:
    columns = [f'"{f.name}" {sql_type(f.dataType)}' for f in schema.fields]
    if keys:
        columns.append(f"PRIMARY KEY ({_quoted(keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def upsert_statement(table: str, staging: str, keys: list[str], columns: list[str]) -> str:
    """Insert the staged rows; on a key conflict overwrite every other column."""
    rest = [c for c in columns if c not in keys]
    action = "DO UPDATE SET " + ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in rest) if rest else "DO NOTHING"
    names = _quoted(columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({_quoted(keys)}) {action}"


def run_statements(connect: Callable, *statements: str) -> None:
    """Run the statements in one transaction."""
    connection = connect()
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement)
        connection.commit()
    finally:
        connection.close()


def replace_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                 connections: int | None = None) -> None:
    """Write ``df`` as the table's new content.

    ``connections`` bounds the load on the database. Rows are then dealt out anew before the write, so
    that the steps before it keep their own parallelism.
    """
    out = df if connections is None else df.repartition(connections)
    out.write.mode("overwrite").jdbc(url, table, properties=properties or {})


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: list[str], connect: Callable,
                staging: str | None = None, properties: dict[str, str] | None = None,
                connections: int | None = None) -> None:
    """Upsert ``df`` (one row per key) into ``table`` by way of a staging table of this run, which is dropped."""
    stage = staging or f"{table}_staging_{uuid.uuid4().hex[:12]}"
    try:
        replace_jdbc(df, url, stage, properties, connections)
        run_statements(connect, create_statement(table, df.schema, keys),
                       upsert_statement(table, stage, keys, df.columns))
    finally:
        run_statements(connect, f"DROP TABLE IF EXISTS {stage}")
