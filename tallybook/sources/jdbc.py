"""Table scans over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 bounds: tuple | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; a partition column with bounds splits the scan into range queries.

    The bounds only place the cuts: rows outside them go to the first and last range.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options.update({k: v for k, v in (("user", user), ("password", password), ("driver", driver)) if v})
    if partition_column:
        if bounds is None or num_partitions is None:
            raise ValueError("a partitioned scan needs bounds and num_partitions")
        options.update({"partitionColumn": partition_column, "lowerBound": str(bounds[0]),
                        "upperBound": str(bounds[1]), "numPartitions": str(num_partitions)})
    return options


def hash_predicates(columns: list[str], parts: int, hash_function: str = "hashtext") -> list[str]:
    """Conditions that deal a table's rows out to ``parts`` queries by a hash of its keys, of any type.

    ``hash_function`` is the database's (it takes a text and gives a whole number). Every row meets one.
    """
    text = " || '|' || ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '')" for c in columns)
    slot = f"mod(mod({hash_function}({text}), {parts}) + {parts}, {parts})"
    return [f"{slot} = {i}" for i in range(parts)]


def read_jdbc(spark: SparkSession, url: str, table: str, *, predicates: list[str] | None = None,
              single_connection: bool = False, **settings) -> DataFrame:
    """Scan a table: split by a partition column, or by ``predicates`` (one query each), else on request by one query."""
    options = jdbc_options(url, table, **settings)
    if predicates:
        properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if "partitionColumn" not in options and not single_connection:
        raise ValueError("split the scan by partition_column or predicates, or ask for a single connection")
    return spark.read.format("jdbc").options(**options).load()
