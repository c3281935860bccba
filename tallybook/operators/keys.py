"""Declared keys: one row per key, no nulls in it; checked in the plan, or kept apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_text(keys: list[str]) -> Column:
    """``date=Mar 2020, company_name=A``"""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, as long as no key stands twice or holds a null; else the job fails and names the key.

    The check is part of the plan: it deals and sorts the rows by key, which a join or write by the same
    key goes on with. A key with very many rows fails at its second one.
    """
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*keys))
    sound = (F.when(F.col("_nth") > 1, F.raise_error(F.concat(F.lit("key stands twice: "), key_text(keys))))
             .when(_any_null(keys), F.raise_error(F.concat(F.lit("key holds a null: "), key_text(keys)))).otherwise(F.lit(True)))
    return df.withColumn("_nth", nth).where(sound.cast("boolean")).drop("_nth")


def require_new(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, as long as none of its keys stands in ``existing``; else the job fails and names the key."""
    there = existing.select(*keys, F.lit(True).alias("_there"))
    sound = F.when(F.col("_there"), F.raise_error(F.concat(F.lit("key is there already: "), key_text(keys)))).otherwise(F.lit(True))
    return df.join(there, keys, "left").where(sound.cast("boolean")).select(*df.columns)


def split_repeated(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is theirs alone, and those to set aside: all rows of keys that stand twice or hold a null.

    Keys are counted on the map side too; what is joined back is the repeated keys only.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | _any_null(keys)) \
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")
