"""Catalog tables: create if missing, replace, append; a declared key is enforced.

A table's rows are a folder of its own below the location; a replacement writes the next folder and then moves the
table there in one step of the catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook.operators.keys import require_new, require_unique
from tallybook.session import list_files, modified, remove

KEYS = "tallybook.keys"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _root(spark: SparkSession, table: str, location: str | None) -> str:
    return location.rstrip("/") if location else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}_versions"


def create_table(spark: SparkSession, table: str, schema: T.StructType, location: str | None = None,
                 keys: list[str] | None = None) -> None:
    """Create an empty parquet table unless it exists; ``location`` holds its versions. ``keys`` declares its key."""
    if spark.catalog.tableExists(table):
        return
    declared = f" TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}')" if keys else ""
    place = f"{_root(spark, table, location)}/v_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING parquet LOCATION '{place}'{declared}")


def declared_keys(spark: SparkSession, table: str) -> list[str]:
    """The key that the table was created with, if any."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{KEYS}'").first()
    return found["value"].split(",") if found else []


def replace_table(df: DataFrame, table: str, location: str | None = None, keep: int = 2) -> None:
    """Replace the table's rows: written as a new version, to which the table is then moved.

    Readers see the old rows until that step and the new ones from then on; a crash leaves the old ones. New columns are
    added before it (null in the old rows). Where a column is gone or of another type the catalog has no
    such step: the table is then dropped and created, and readers in between miss it. The newest ``keep`` versions stay,
    so that running reads can end. A declared key that stands twice fails the job before anything changes.
    """
    spark = df.sparkSession
    root = _root(spark, table, location)
    place = f"{root}/v_{uuid.uuid4().hex}"
    there = spark.catalog.tableExists(table)
    keys = declared_keys(spark, table) if there else []
    (require_unique(df, keys) if keys else df).write.parquet(place)
    old = {f.name: f.dataType for f in spark.table(table).schema.fields} if there else {}
    new = {f.name: f.dataType for f in df.schema.fields}
    if there and all(new.get(n) == t for n, t in old.items()) and list(new)[:len(old)] == list(old):
        added = T.StructType([f for f in df.schema.fields if f.name not in old])
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    else:
        declared = f" TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}')" if keys else ""
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({_columns(df.schema)}) USING parquet LOCATION '{place}'{declared}")
    spark.catalog.refreshTable(table)
    versions = [p for p in list_files(spark, root) if p.rsplit("/", 1)[1].startswith("v_") and not p.endswith(place[-34:])]
    for path in sorted(versions, key=lambda p: modified(spark, p), reverse=True)[max(keep - 1, 0):]:
        remove(spark, path)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, matching columns by name. Keys that the table has declared have to be new."""
    spark = df.sparkSession
    rows, keys = df.select(*spark.table(table).columns), declared_keys(spark, table)
    if keys:
        rows = require_new(require_unique(rows, keys), spark.table(table), keys).select(*rows.columns)
    rows.write.insertInto(table)
