"""Quality rules by robust multivariate outliers, in SQL functions only.

Each text gives a vector of transformed statistics (word length, symbols, repeated lines, repeated words,
capitals). Per language and source the minimum covariance determinant estimate finds location and scatter of
the densest three quarters: concentration steps from a start by medians, each taking the rows with the least
Mahalanobis distances of the step before, then a reweighted estimate. Texts far from it are rejected.

All estimates are grouped aggregates with map-side partial results, so a source with a third of all rows is
no heavier than another. Estimates of small groups lean on those of the whole table: with n rows a group
counts n, the whole ``PRIOR_ROWS``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import scratch_dir

WORD = r"[^\\x20\\x09-\\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
VECTOR = ["log_word_length", "log_symbols", "log_dup_lines", "log_repeats", "log_capitals"]
#: Least standard deviation of each entry: most texts have no symbols or repeats at all, so their own scatter is nil.
#: Small enough that each entry alone passes the limit within its range (repeats: below the base rule's 30 %).
FLOOR = [0.08, 0.2, 0.13, 0.065, 0.2]
SUPPORT = 0.75
STEPS = 4
PRIOR_ROWS = 50
REJECT = 1e-4  # share of clean texts beyond the limit if the vectors were normal


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def repeated_words_sql(words: str, size: int = 8) -> str:
    """SQL for the number of words in ``size``-word windows that occur twice or more; ``size`` is a power of two."""
    hashes, step = f"transform({words}, x -> xxhash64(x))", 1
    while step < size:
        hashes = _let(hashes, f"h{step}", f"zip_with(h{step}, slice(h{step}, {step + 1}, size(h{step})), "
                                          "(a, b) -> xxhash64(a, b))")
        step *= 2
    windows = f"slice({hashes}, 1, size({words}) - {size - 1})"
    twice = "filter(s, (e, j) -> coalesce(get(s, j - 1).h = e.h, false) or coalesce(get(s, j + 1).h = e.h, false))"
    covered = (f"aggregate(transform(p, (x, j) -> least({size}, coalesce(get(p, j + 1) - x, {size}))), 0L, "
               "(a, x) -> a + x)")
    places = _let(f"sort_array(transform({twice}, e -> e.i))", "p", covered)
    ordered = _let("sort_array(transform(v, (x, i) -> named_struct('h', x, 'i', i)))", "s", places)
    counted = _let(windows, "v", f"if(size(array_distinct(v)) = size(v), 0L, {ordered})")
    return f"if(size({words}) < {size}, 0L, {counted})"


def text_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_capitals (long).

    A null text counts as empty. A line counts if it has a word; it is a repeat if an earlier line is equal.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sql = f"coalesce(`{text_column}`, '')"
    from_words = _let(f"regexp_extract_all({sql}, '{WORD}+', 0)", "w",
                      f"named_struct('n', size(w), 'r', {repeated_words_sql('w')})")
    from_lines = _let(f"filter(split({sql}, '\\n'), l -> l rlike '{WORD}')", "l",
                      "named_struct('n', size(l), 'd', size(l) - size(array_distinct(l)))")
    return (docs.withColumn("__w", F.expr(from_words)).withColumn("__l", F.expr(from_lines))
            .withColumns({"n_words": F.col("__w.n").cast("long"), "n_repeat_words": F.col("__w.r").cast("long"),
                          "n_lines": F.col("__l.n").cast("long"), "n_dup_lines": F.col("__l.d").cast("long"),
                          "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
                          "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
                          "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long")})
            .drop("__w", "__l"))


def vector_of() -> list[Column]:
    """The transformed statistics; zero for a text without words."""
    def per(part: str, whole: str, scale: float):
        return F.coalesce(F.log1p(scale * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0.0))

    def unlike(part: str, whole: str):
        return F.coalesce(-F.log1p(-0.99 * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0.0))

    return [F.coalesce(F.log(F.col("word_chars") / F.nullif(F.col("n_words"), F.lit(0))), F.lit(0.0)),
            per("n_symbols", "word_chars", 100), unlike("n_dup_lines", "n_lines"), unlike("n_repeat_words", "n_words"),
            per("n_capitals", "word_chars", 20)]


def chi_square_cdf(x: float, dof: int) -> float:
    """By the series of the lower incomplete gamma function."""
    a, x = dof / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(p: float, dof: int) -> float:
    low, high = 1e-12, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dof) < p else (low, middle)
    return low


def consistency(share: float, dof: int) -> float:
    """Factor that makes the scatter of the ``share`` nearest rows that of all, for normal rows."""
    return share / chi_square_cdf(chi_square_quantile(share, dof), dof + 2)


def distance(vector: list[Column]) -> Column:
    """Squared Mahalanobis distance from the row's group: columns m<i> and l<i>_<j> (Cholesky factor)."""
    solved = []
    for i, x in enumerate(vector):
        rest = x - F.col(f"m{i}") - sum((F.col(f"l{i}_{j}") * solved[j] for j in range(i)), start=F.lit(0.0))
        solved.append(rest / F.col(f"l{i}_{i}"))
    return sum((s * s for s in solved), start=F.lit(0.0))


class RobustGroups:
    """Minimum-covariance-determinant estimates of the columns x0, x1, … per ``group``."""

    def __init__(self, rows: DataFrame, floor: list[float], folder: str):
        self.rows, self.floor, self.folder, self.n = rows, floor, folder, len(floor)
        self.x = [F.col(f"x{i}") for i in range(self.n)]
        self.round = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.round += 1
        path = f"{self.folder}/estimate-{self.round}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def factored(self, moments: DataFrame, scale: float) -> DataFrame:
        """(group, n, m<i>, s<i>_<j>) with the scatter scaled, floored and factored."""
        def cov(i, j):
            own = F.coalesce(F.col(f"s{max(i, j)}_{min(i, j)}"), F.lit(0.0)) * scale
            return own + self.floor[i] ** 2 if i == j else own

        # Statement by statement, as an entry of the factor uses those before it.
        out = moments
        for i in range(self.n):
            for j in range(i + 1):
                rest = cov(i, j)
                for k in range(j):
                    rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
                out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j
                                     else rest / F.col(f"l{j}_{j}"))
        return out

    def moments(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("group").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(self.n)],
            *[F.covar_pop(f"x{i}", f"x{j}").alias(f"s{i}_{j}") for i in range(self.n) for j in range(i + 1)])

    def start(self) -> DataFrame:
        middle = self.rows.groupBy("group").agg(
            F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(self.n)])
        spread = self.rows.join(middle, "group").groupBy("group").agg(
            F.first("n").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(self.n)],
            *[(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 1000) * 1.4826).alias(f"d{i}") for i in range(self.n)])
        zero = {f"s{i}_{j}": F.pow(F.col(f"d{i}"), 2) if i == j else F.lit(0.0) for i in range(self.n) for j in range(i + 1)}
        return self.keep(self.factored(spread.withColumns(zero), 1.0))

    def distances(self, estimate: DataFrame) -> DataFrame:
        return self.rows.join(estimate.drop("n"), "group").withColumn("d2", distance(self.x))

    def fit(self) -> DataFrame:
        estimate = self.start()
        for _ in range(STEPS):
            near = self.distances(estimate)
            limit = self.keep(near.groupBy("group").agg(F.percentile_approx("d2", SUPPORT, 1000).alias("limit")))
            core = near.join(limit, "group").where("d2 <= limit").select("group", *self.x)
            estimate = self.keep(self.factored(self.moments(core), consistency(SUPPORT, self.n)))
        core = self.distances(estimate).where(F.col("d2") <= chi_square_quantile(0.975, self.n)).select("group", *self.x)
        return self.keep(self.moments(core))


def reject_outliers(docs: DataFrame, text_column: str = "text", group_columns: tuple[str, ...] = ("lang", "source"),
                    min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``docs`` with the statistics, base_failed, distance (squared Mahalanobis) and kept; no row is dropped.

    base_failed: fewer than ``min_words`` words, or over ``max_repeat_percent`` of them in repeated windows. Those
    rows do not enter the estimates. kept: not base_failed, and the distance within the chi-square limit for
    ``REJECT``. A null language or source is a group value of its own. An empty table stays empty.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "outliers")
    stats = text_statistics(docs, text_column).withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    group = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in group_columns]))
    stats = stats.withColumns({"group": group, **{f"x{i}": x for i, x in enumerate(vector_of())}})
    stats.drop(text_column).write.parquet(f"{folder}/statistics")
    stats = spark.read.schema(stats.drop(text_column).schema).parquet(f"{folder}/statistics")
    xs = [f"x{i}" for i in range(len(FLOOR))]
    rows = stats.where(~F.col("base_failed")).select(F.explode(F.array("group", F.lit("all"))).alias("group"), *xs)
    groups = RobustGroups(rows, FLOOR, folder)
    found = groups.fit()
    whole = found.where(F.col("group") == "all").select(*[F.col(c).alias(f"a_{c}") for c in found.columns if c not in ("group", "n")])
    names = stats.select("group").distinct()
    n = F.coalesce(F.col("n"), F.lit(0))
    blended = names.join(found, "group", "left").crossJoin(F.broadcast(whole)).select(  # whole: one row
        "group", *[((n * F.coalesce(F.col(c), F.lit(0.0)) + PRIOR_ROWS * F.col(f"a_{c}")) / (n + PRIOR_ROWS)).alias(c)
                   for c in found.columns if c not in ("group", "n")])
    final = groups.keep(groups.factored(blended, 1.0))
    limit = chi_square_quantile(1 - REJECT, len(FLOOR))
    judged = (stats.join(final, "group", "left").withColumn("distance", distance([F.col(x) for x in xs]))
              .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))))
    return judged.drop("group", *xs, *[c for c in final.columns if c != "group"])
