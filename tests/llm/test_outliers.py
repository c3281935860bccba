"""Quality rules: statistics against plain counting, robust estimates against numpy."""

import math
import re

import numpy as np
import pytest

from tallybook.llm import queries
from tallybook.llm.outliers import RobustGroups, chi_square_cdf, chi_square_quantile, consistency, reject_outliers, text_statistics
from tallybook.session import scratch_dir

FOLDER = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    w = re.findall(WORD, text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    counts = {}
    for v in windows:
        counts[v] = counts.get(v, 0) + 1
    covered = {i + k for i, v in enumerate(windows) if counts[v] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


CASES = [None, "", " \n\t ", "one", "a b c d e f g h a b c d e f g h", "x " * 50, "x\ny\nx\n\nx ", "# * | <b> 100%",
         "a b c d e f g h i a b c d e f g h z a b c d e f g", "é ü 漢字 😀 \x0b x\x0cy", "l1\r\nl1\r\nl1", "q" * 9000]
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_plain_counts(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(CASES)], "doc_id long, text string, n_lines string")
    for row in text_statistics(docs).collect():
        assert tuple(row[c] for c in COLUMNS) == plain(CASES[row.doc_id]), CASES[row.doc_id]


def test_chi_square():
    assert chi_square_cdf(2 * math.log(2), 2) == pytest.approx(0.5)
    assert chi_square_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert chi_square_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)
    assert consistency(0.75, 5) > 1


def test_estimate_withstands_a_fifth_of_outliers(spark):
    rng = np.random.default_rng(3)
    cov = np.array([[1.0, 0.6], [0.6, 2.0]])
    good = rng.multivariate_normal([1, -2], cov, 4000)
    bad = rng.multivariate_normal([25, 30], 0.1 * np.eye(2), 1000)
    rows = [("g", float(a), float(b)) for a, b in np.vstack([good, bad])]
    frame = spark.createDataFrame(rows, "group string, x0 double, x1 double")
    got = RobustGroups(frame, [0.01, 0.01], scratch_dir(spark, "mcd")).fit().first()
    assert abs(got.m0 - 1) < 0.1 and abs(got.m1 + 2) < 0.15
    assert np.allclose([got.s0_0, got.s1_0, got.s1_1], [1.0, 0.6, 2.0], atol=0.25)


def test_nulls_empty_and_small_tables(spark):
    schema = "doc_id long, text string, lang string, source string, distance string"
    assert reject_outliers(spark.createDataFrame([], schema)).count() == 0
    docs = [(1, None, None, None, "x"), (2, "", "en", None, "x"), (3, "word " * 40, "en", "a", "x"),
            (4, " ".join(f"w{i}" for i in range(40)), "en", "a", "x"), (4, " ".join(f"w{i}" for i in range(40)), "en", "a", "x")]
    got = reject_outliers(spark.createDataFrame(docs, schema)).collect()
    assert len(got) == 5
    assert [(r.doc_id, r.base_failed, r.kept) for r in sorted(got, key=lambda r: r.doc_id)] == [
        (1, True, False), (2, True, False), (3, True, False), (4, False, True), (4, False, True)]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.QUERIES["op7_quality_outliers"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 20 or 100 * rest[-1] > 30 * n)
        assert not (r.base_failed and r.kept)
    clean = [r for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r for r in rows if label.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(r.kept for r in junk) <= 0.25 * len(junk)


def test_each_statistic_alone_leads_to_rejection(spark):
    rng = np.random.default_rng(5)

    def words(n, low=3, high=8):
        return ["".join(rng.choice(list("abcdefghijklmnopqrst"), rng.integers(low, high))) + "uvwxyz"[i % 6] for i in range(n)]

    def plain_text(n=97):
        w = words(n)
        return "\n".join(" ".join(w[i:i + 12]) for i in range(0, n, 12))

    block = words(14)
    odd = {"word length": " ".join(words(97, 28, 32)),
           "symbols": " ".join(w + "#" * (i % 3 == 0) for i, w in enumerate(words(97))),
           "lines": "\n".join(f"{w}\nread more\nlog in" for w in words(30)),
           "repeats": " ".join(block + words(60) + block + words(9)),
           "capitals": " ".join(w.upper() if i % 2 else w for i, w in enumerate(words(97)))}
    docs = [(f"plain {i}", plain_text(), "en", "a") for i in range(300)] + [(k, t, "en", "a") for k, t in odd.items()]
    rows = {r.doc_id: r for r in reject_outliers(spark.createDataFrame(docs, "doc_id string, text string, lang string, source string")).collect()}
    assert not any(rows[k].base_failed for k in odd)
    assert {k for k in odd if rows[k].kept} == set(), {k: rows[k].distance for k in odd}
    assert sum(rows[f"plain {i}"].kept for i in range(300)) >= 297


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert "Python" not in reject_outliers(docs)._jdf.queryExecution().toString()
