"""Document fingerprints by winnowing, in SQL functions only.

A text is cut into units at places that its characters give: behind every character of a fixed set, at
every blank, and after ``unit`` characters without either. Every ``k`` successive units give a polynomial
hash modulo 2^31 - 1, the value a rolling hash has there. Of each window of ``w`` successive hashes the least is
kept, the rightmost one on ties, with its position (the number of the unit at which it begins).

Units begin alike in two texts from the first blank or character of the set on that they share, wherever the passage
stands in them; with ``w + k - 1`` units from there on it shares a kept hash. Hashes at every character would need no
such place, but cost two and a half times the time here.

The window minima come from log2(w) passes: the minima of windows of 2, 4, 8 … hashes are each the lesser of
two shorter ones. Hash and position share one long (hash above, position counted down below), so the least
long is the least hash furthest to the right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
BASE = 1_000_003
LAST_POSITION = (1 << 31) - 1
UNIT = 8
BLANK = r"\\x20\\x09-\\x0D"
# Characters behind which a unit ends: of alphabets one or two that are frequent, of ASCII also some that stand in keys and
# paths, and all of the scripts of many characters.
CUT = "eAEQW05/_" + "еоαאاाา" + r"\\x{3000}-\\x{10FFFF}"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def unit_pattern(unit: int = UNIT) -> str:
    """Up to ``unit`` characters, the last of which is a cut character, the last before a blank, or any."""
    return f"[^{BLANK}{CUT}]{{0,{unit - 1}}}[^{BLANK}]"


def winnow_sql(text: str, k: int = 4, w: int = 8, unit: int = UNIT) -> str:
    """SQL for the kept (hash, position) longs of a text, in order of position; null and empty give none.

    With fewer than k units the hashes of what is there are chained; with fewer than w hashes their least is kept.
    """
    if w < 2 or w & (w - 1):
        raise ValueError("w has to be a power of two, 2 or more")
    grams = "h"
    for i in range(1, k):
        grams = (f"zip_with({grams}, slice(h, {i + 1}, size(h)), "
                 f"(a, b) -> (a * {BASE} + coalesce(b, 0)) % {PRIME})")
    grams = f"slice({grams}, 1, greatest(size(h) - {k - 1}, 1))"
    packed = f"transform({grams}, (g, i) -> shiftleft(g, 31) | ({LAST_POSITION}L - i))"
    step, name = 1, "m1"
    bindings = [(name, packed)]
    while step < w:
        new = f"m{step * 2}"
        bindings.append((new, f"zip_with({name}, slice({name}, {step + 1}, size({name})), (a, b) -> least(a, b))"))
        step, name = step * 2, new
    body = f"array_distinct(slice({name}, 1, greatest(size({name}) - {w - 1}, 1)))"
    for bound, value in reversed(bindings):
        body = _let(value, bound, body)
    hashes = f"transform(regexp_extract_all({text}, '{unit_pattern(unit)}', 0), u -> (xxhash64(u) & {PRIME}L))"
    filled = _let(hashes, "h", f"if(size(h) = 0, cast(array() as array<bigint>), {body})")
    return f"coalesce({filled}, cast(array() as array<bigint>))"


def hashes_sql(kept: str) -> str:
    return f"transform({kept}, x -> shiftright(x, 31))"


def positions_sql(kept: str) -> str:
    """Number of the unit at which each kept hash begins."""
    return f"transform({kept}, x -> cast({LAST_POSITION}L - (x & {LAST_POSITION}L) as int))"


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of the hash sets in two columns of hashes; two empty ones are alike."""
    union = f"size(array_union({a}, {b}))"
    return F.expr(f"if({union} = 0, 1.0D, size(array_intersect({a}, {b})) / {union})").cast("double")


def fingerprints(docs: DataFrame, text: str = "text", k: int = 4, w: int = 8, unit: int = UNIT) -> DataFrame:
    """``docs`` with ``hashes`` (array of bigint) and ``positions`` (array of int, in units), by position.

    Null and empty texts have empty arrays; repeated rows each get theirs; an empty table stays empty. Columns of the same
    names are replaced.
    """
    kept = docs.withColumn("__kept", F.expr(winnow_sql(f"`{text}`", k, w, unit)))
    return (kept.withColumn("hashes", F.expr(hashes_sql("__kept")))
            .withColumn("positions", F.expr(positions_sql("__kept"))).drop("__kept"))


# -- each document beside the next one by descending id -------------------------------------------------

CELLS = 256  # quantiles of the id; within them, ranges of equal width
ROWS = 1024  # documents in a range, about


def with_range(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``cell`` and ``sub``: ranges of the id of about ``ROWS`` rows, ascending with it.

    The bounds are ``CELLS`` quantiles and so of bounded size; the number of ranges grows with the table.
    """
    points = ", ".join(str(i / CELLS) for i in range(CELLS))
    bounds, top, rows = docs.select(
        F.expr(f"percentile_approx({key}, array({points}), {CELLS * 20})"), F.max(key), F.count(F.lit(1))).first() \
        if key in docs.columns else (None, None, 0)
    bounds = sorted(set(bounds or []))
    per_cell = max(1, -(-rows // (max(len(bounds), 1) * ROWS)))
    edges = bounds + [(top if top is not None else 0) + 1]
    steps = [max(1.0, (edges[i + 1] - edges[i]) / per_cell) for i in range(len(bounds))]
    if not bounds:
        return docs.withColumns({"cell": F.lit(0), "sub": F.lit(0).cast("long")})
    lows = F.lit([float(b) for b in bounds])
    cell = F.when(F.col(key).isNull(), 0).otherwise(
        F.size(F.filter(F.lit(bounds), lambda b: b <= F.col(key))))
    sub = F.floor((F.col(key).cast("double") - F.element_at(lows, F.col("cell"))) /
                  F.element_at(F.lit(steps), F.col("cell")))
    return docs.withColumn("cell", cell).withColumn(
        "sub", F.when(F.col("cell") == 0, F.lit(0)).otherwise(sub).cast("long"))


def beside_next(docs: DataFrame, key: str, columns: dict[str, str], order: list[str]) -> DataFrame:
    """Each row with ``next_<name>`` for every entry (name: SQL) of ``columns``, taken from the row that follows.

    Rows follow one another by descending ``key`` (nulls last), then by ``order``; the first follows the last.
    One shuffle of the rows: they are grouped by ranges of the key, and the first row of each range is also
    sent to the range before it. The entries are computed after the shuffle.
    """
    ranged = with_range(docs, key)
    found = ranged.groupBy("cell", "sub").agg(F.max(key).alias("head"))
    cells = found.groupBy("cell").agg(F.min("sub").alias("low"))
    up = Window.orderBy("cell")  # one row per cell, CELLS + 1 at most
    whole = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = cells.select("cell", F.coalesce(F.lead("cell").over(up), F.first("cell").over(whole)).alias("above_cell"),
                         F.coalesce(F.lead("low").over(up), F.first("low").over(whole)).alias("above_low"))
    within = F.lead("sub").over(Window.partitionBy("cell").orderBy("sub"))
    heads = (found.withColumn("above", within).join(cells, "cell")
             .select(F.coalesce("head", F.lit(-1 << 63)).alias("__head"), F.col("cell").alias("__cell"),
                     F.when(F.col("above").isNotNull(), F.col("cell")).otherwise(F.col("above_cell")).alias("to_cell"),
                     F.coalesce("above", "above_low").alias("to_sub")))
    own = F.struct(F.col("cell"), F.col("sub"), F.lit(False).alias("extra"))
    also = F.struct(F.col("to_cell").alias("cell"), F.col("to_sub").alias("sub"), F.lit(True).alias("extra"))
    sent = (ranged.join(heads, (F.coalesce(F.col(key), F.lit(-1 << 63)) == F.col("__head"))
                        & (F.col("cell") == F.col("__cell")), "left")
            .withColumn("__at", F.explode(F.when(F.col("to_cell").isNull(), F.array(own)).otherwise(
                F.array(own, also))))
            .drop("cell", "sub", "__head", "__cell", "to_cell", "to_sub").select("*", "__at.*").drop("__at")
            .repartition("cell", "sub"))
    for name, sql in columns.items():
        sent = sent.withColumn(name, F.expr(sql))
    following = Window.partitionBy("cell", "sub").orderBy(F.col("extra"), F.col(key).desc_nulls_last(), *order)
    for name in columns:
        sent = sent.withColumn(f"next_{name}", F.lead(name).over(following))
    return sent.where(~F.col("extra")).drop("cell", "sub", "extra")


def edit_check(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: the last third replaced by the start of the next document.

    Returns the id, n_chars, edited (text), hashes, positions, edited_hashes, near_edited and near_next.
    Null texts count as empty; repeated ids follow one another by text; a null id comes last; an empty table stays empty.
    """
    own = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    near = beside_next(own, "id", {"body": "text", "kept": winnow_sql("text")}, ["text"])
    n, third = F.length("body"), F.expr("length(body) div 3")
    edited = F.concat(F.substring("body", F.lit(1), (n - third).cast("int")),
                      F.substring("next_body", F.lit(1), third.cast("int")))
    near = near.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"),
                       F.expr(hashes_sql("kept")).alias("hashes"), F.expr(positions_sql("kept")).alias("positions"),
                       F.expr(hashes_sql("next_kept")).alias("next_hashes"))
    near = near.withColumn("edited_kept", F.expr(winnow_sql("edited")))
    near = near.withColumn("edited_hashes", F.expr(hashes_sql("edited_kept")))
    return near.select(F.col("id").alias(id_column), "n_chars", "edited", "hashes", "positions", "edited_hashes",
                       likeness("hashes", "edited_hashes").alias("near_edited"),
                       likeness("hashes", "next_hashes").alias("near_next"))
