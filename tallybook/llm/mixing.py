"""Order documents so that sources appear in target shares from the first block on, in SQL functions only.

Method: Pfair scheduling. Each source's documents are cut into blocks, and block k of a source of weight
w is released at slot floor((k - 1) / w) and due by slot ceil(k / w); every slot takes, of the released
blocks, the one that is due first. At every slot each source is then less than one block from its share.

The weights are whole parts of ``SLOTS``, so the schedule repeats after ``SLOTS`` slots: one period is
computed, a table of SLOTS rows at most, and block k of a source stands k // parts periods later. Documents
get their place from their rank within the source, which is counted by ranges of a hash: no source is ever
in one task. A source that runs out leaves its later slots empty; the others keep their slots and so their
order and their shares among one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.session import scratch_dir

SLOTS = 1000
RANGES = 4096   # ranges of the hash that each source is ranked by
BLOCK_ROWS = 16
BANDS = 16  # bands of slots for each shuffle partition, from which equal partitions are made
LAST_SLOT = 1 << 62  # where sources without a weight begin


def weights_by_power(counts: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Target weights in proportion to size ** power: small sources come up more often than their size says."""
    return {s: float(n) ** power for s, n in counts.items()}


def whole_parts(weights: dict[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Parts of ``slots`` in proportion to the weights, one at least, by largest remainders; ties by name."""
    weights = {s: w for s, w in weights.items() if w > 0}
    if not weights:
        return {}
    slots = max(slots, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * slots for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    while sum(parts.values()) < slots:
        for s in order:
            if sum(parts.values()) < slots:
                parts[s] += 1
    while sum(parts.values()) > slots:
        largest = max(parts, key=lambda s: (parts[s], s))
        parts[largest] -= 1
    return parts


def schedule_sql(parts: list[int]) -> str:
    """SQL for the source (number) in each slot of one period, by earliest deadline among the released blocks.

    Block k (from 0) of a source with p parts of the period P is released at k * P div p and due at
    ceil((k + 1) * P / p). The shares add up to one, so in every slot some block is ready.
    """
    period = sum(parts)
    p = "array(" + ", ".join(f"{x}L" for x in parts) + ")"
    ready = (f"filter(transform(a.done, (k, i) -> named_struct('due', ((k + 1) * {period} + p[i] - 1) div p[i], "
             f"'i', i, 'from', k * {period} div p[i])), b -> b.from <= t and b.due <= {period})")
    pick = f"array_min({ready})"
    step = (f"transform(array({pick}), c -> named_struct('done', transform(a.done, (k, i) -> k + if(i = c.i, 1L, 0L)), "
            "'out', concat(a.out, array(c.i))))[0]")
    return (f"transform(array({p}), p -> aggregate(sequence(0L, {period - 1}L), named_struct('done', "
            f"array_repeat(0L, {len(parts)}), 'out', cast(array() as array<int>)), (a, t) -> {step}, a -> a.out))[0]")


def period_table(spark, parts: dict[str, int]) -> DataFrame:
    """(source, parts, turn, slot): in which slot of a period a source has its turn-th block."""
    names = sorted(parts)
    numbers = [parts[n] for n in names]
    slots = (spark.range(1).select(F.posexplode(F.expr(schedule_sql(numbers))).alias("slot", "i"))
             .withColumn("turn", F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1))
    rows = spark.createDataFrame([(i, n, parts[n]) for i, n in enumerate(names)], "i int, source string, parts long")
    return slots.join(rows, "i").select("source", "parts", F.col("turn").cast("long"), F.col("slot").cast("long"))


def _range(key: Column) -> Column:
    return F.pmod(F.shiftright(key, 48), F.lit(RANGES))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, source_column: str = "source",
                key: Column | None = None, block_rows: int = BLOCK_ROWS, power: float = 0.5) -> DataFrame:
    """``docs`` with mix_slot, mix_offset (place in the slot's block) and mix_block (block of its source).

    Ordered by mix_slot and mix_offset the rows are in the target shares. ``weights`` are per source, in any
    unit; by default size ** ``power``. A null source is a source of its own, named "" like an empty one.
    Sources without a positive weight come after all others, one row per block, in order of ``key``. Within
    a source rows are ordered by a hash of ``key`` (default: all columns), equal rows in any order. No row
    is dropped; an empty table stays empty; columns of docs with the new names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("mix_slot", "mix_offset", "mix_block")]
    key = F.xxhash64(*[F.col(c) for c in columns]) if key is None else F.xxhash64(key)
    rows = docs.select(*columns, F.coalesce(F.col(source_column), F.lit("")).alias("__source"), key.alias("__key"))
    rows = rows.withColumn("__range", _range(F.col("__key")))
    counts = rows.groupBy("__source", "__range").agg(F.count(F.lit(1)).alias("__n"))
    if weights is None:
        sizes = counts.groupBy("__source").agg(F.sum("__n").alias("n"))
        weights = weights_by_power({r[0]: r.n for r in sizes.collect()}, power)  # one row per source
    parts = whole_parts({s or "": w for s, w in weights.items()})
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__source").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__source", "__range", before.alias("__before"))
    own = Window.partitionBy("__source", "__range").orderBy("__key", *[F.col(c) for c in columns if c in ("doc_id",)])
    ranked = (rows.withColumn("__row", F.row_number().over(own)).join(starts, ["__source", "__range"])
              .withColumn("__rank", F.col("__before") + F.col("__row") - 1)
              .withColumn("mix_block", F.expr(f"__rank div {block_rows}"))
              .withColumn("mix_offset", F.col("__rank") % block_rows))
    placed = _with_slots(ranked, parts)
    return placed.select(*columns, "mix_slot", "mix_offset", "mix_block")


def _with_slots(ranked: DataFrame, parts: dict[str, int]) -> DataFrame:
    """``ranked`` (__source, mix_block) with mix_slot."""
    if not parts:
        return ranked.withColumn("mix_slot", F.col("mix_block"))
    sizes = F.create_map(*[x for s, p in sorted(parts.items()) for x in (F.lit(s), F.lit(p).cast("long"))])
    slots = period_table(ranked.sparkSession, parts).select(
        F.col("source").alias("__source"), F.col("turn").alias("__turn"), F.col("slot").alias("__slot"))
    ranked = ranked.withColumn("__parts", sizes[F.col("__source")])
    ranked = ranked.withColumn("__turn", F.expr("mix_block % __parts"))
    period = sum(parts.values())
    return ranked.join(F.broadcast(slots), ["__source", "__turn"], "left").withColumn(  # a row per slot of a period
        "mix_slot", F.coalesce(F.expr(f"(mix_block div __parts) * {period} + __slot"), F.lit(LAST_SLOT) + F.col("mix_block")))


def _parts(docs: DataFrame, source: Column, weights: dict[str, float] | None, power: float) -> dict[str, int]:
    """Whole parts by the weights, by size if none are given."""
    if weights is None:
        sizes = docs.groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n"))
        weights = weights_by_power({r.s: r.n for r in sizes.collect()}, power)  # one row per source
    return whole_parts({s or "": w for s, w in weights.items()})


def in_mix_order(docs: DataFrame, weights: dict[str, float] | None = None, source_column: str = "source",
                 key: Column | None = None, block_rows: int = BLOCK_ROWS, power: float = 0.5) -> DataFrame:
    """``docs`` in the order that ``mix_sources`` gives: every row of a partition stands before those of the next.

    Whole rows move once, or twice where the planner does not broadcast the table of bands (a row per source and range of the
    hash). The order is first worked out for source and key alone; of that, only where each band of slots
    begins in each source and range of the hash goes back to the rows, which are dealt out by band and find
    their slots there by counting on. Rows with one key stay in one band. Nulls, empty tables and weights as in ``mix_sources``.
    """
    spark = docs.sparkSession
    source = F.coalesce(F.col(source_column), F.lit(""))
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]) if key is None else key
    parts = _parts(docs, source, weights, power)
    by = {s: float(p) for s, p in parts.items()}
    folder = scratch_dir(spark, "mix")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    hashed = F.xxhash64("k")
    places = kept(mix_sources(docs.select(source.alias("source"), key.alias("k")), by, "source", F.col("k"), block_rows)
                  .select(F.col("source").alias("__source"), hashed.alias("__key"), _range(hashed).alias("__range"), "mix_slot",
                          (F.col("mix_block") * block_rows + F.col("mix_offset")).alias("rank")), "places")
    last = places.where(F.col("mix_slot") < LAST_SLOT).agg(F.max("mix_slot")).first()[0] or 0
    width = max(last // (BANDS * int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    ties = places.groupBy("__source", "__range", "__key").agg(F.min("rank").alias("rank"), F.expr(f"min(mix_slot) div {width}").alias("band"))
    begins = ties.groupBy("__source", "__range", "band").agg(F.min("__key").alias("from"), F.min("rank").alias("rank"))
    cells = kept(begins.groupBy("__source", "__range").agg(
        F.sort_array(F.collect_list(F.struct("from", "band", "rank"))).alias("__bands")), "cells")

    own = docs.select("*", source.alias("__source"), F.xxhash64(key).alias("__key"))
    own = own.withColumn("__range", _range(F.col("__key"))).join(cells, ["__source", "__range"])
    own = own.withColumn("__at", F.element_at(F.filter("__bands", lambda b: b["from"] <= F.col("__key")), -1)).drop("__bands")
    own = own.withColumn("__band", F.col("__at.band")).repartitionByRange("__band")
    nth = F.row_number().over(Window.partitionBy("__band", "__source", "__range").orderBy("__key"))
    ranked = own.withColumn("__rank", F.col("__at.rank") + nth - 1)
    ranked = ranked.withColumn("mix_block", F.expr(f"__rank div {block_rows}"))
    placed = _with_slots(ranked, parts)
    return placed.sortWithinPartitions("__band", "mix_slot", F.col("__rank") % block_rows).select(
        *[F.col(f"`{c}`") for c in docs.columns])
