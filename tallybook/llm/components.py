"""Connected components of a table of links, in DataFrame steps that write their edges to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``low``: the least v of each u. A u with very many edges is spread over salts.

    The planner takes the salted rows for an eighth of what they are, so it is not left to broadcast them.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    low = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(low.hint("merge"), ["u", "salt"]).drop("salt")


def connected_components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b: bigint) that is not its own root; root is the least node.

    Alternating large-star and small-star steps: all neighbours of a node move to its least one, which
    ends when nothing changes. Each round's edges are a table in ``folder``, so no plan grows and a lost
    executor costs one round. Links of a node with itself are ignored; an empty table gives no rows.
    """
    spark = links.sparkSession
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, turn = None, 0
    while True:
        path = f"{folder}/edges-{turn}"
        edges.write.parquet(path)
        edges = spark.read.schema("u bigint, v bigint").parquet(path)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, turn = state, turn + 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct())
        least = _with_least(large)
        edges = (least.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"),
                              F.col("low").alias("v"))
                 .union(least.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
