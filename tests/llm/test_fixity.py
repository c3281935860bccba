"""Fixity audit: damaged records found through the tree are those whose bytes differ."""

import pytest
from oracle import connect, mismatch
from pyspark.sql import functions as F

from tallybook.llm import queries
from tallybook.llm.fixity import FILE_RECORDS, audit_pages

SF_DIR = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    name = "op8_warc_fixity"
    assert mismatch(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) is None


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("seq", F.lit("clash"))


@pytest.mark.parametrize("ids", [[5], list(range(3 * FILE_RECORDS)), [-5000, -1, 0, 7, 10**7, 10**9], [None, 1, 1, None]])
def test_damage_is_located(spark, ids):
    pages = pages_of(spark, [(k, f"http://x/{i}", f"text {i}" if i % 3 else None) for i, k in enumerate(ids)])
    copy = F.when(F.col("html").endswith("1"), F.concat("html", F.lit("!"))).when(F.col("html").endswith("4"), F.lit(None)).otherwise(F.col("html"))
    got = audit_pages(pages, copy).collect()
    assert len(got) == len(ids)
    want = sum(i % 3 > 0 and f"{i}"[-1] in "14" for i in range(len(ids)))
    assert sum(r.damaged for r in got) == want
    by_file = {}
    for r in got:
        by_file.setdefault(r.file, []).append(r)
    for rows in by_file.values():
        rows.sort(key=lambda r: r.seq)
        assert [r.start for r in rows] == [0] + [r.end for r in rows[:-1]]


def test_equal_replicas_and_empty_table(spark):
    pages = pages_of(spark, [(i, None, "x") for i in range(40)])
    assert not audit_pages(pages, F.col("html")).where("damaged").count()
    assert audit_pages(pages.limit(0), F.col("html")).count() == 0
