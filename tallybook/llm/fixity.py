"""Fixity audit of WARC replicas by Merkle trees.

Records stand in files in a fixed order; a record's leaf is the hash of its bytes together with its offset
range. ``FANOUT`` successive nodes make a node of the next level, hashed with the range that they cover, up
to a root per file and on to one root of all files. Two replicas are compared from the root: only children
of nodes that differ are looked at on the next level, down to the records that are damaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.session import scratch_dir

FANOUT = 16
FILE_RECORDS = 1024


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a response record; its bytes are the UTF-8 of it. Nulls count as empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def manifest(records: DataFrame, file: Column, order: list) -> DataFrame:
    """``records`` with file, seq (from 0), start and end: each record's place in its file, by ``order``.

    Takes the column ``size`` (bytes). Files are bounded by how they are named, so a file's records fit one task.
    """
    inside = Window.partitionBy("file").orderBy(*order)
    end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (records.withColumn("file", file).withColumn("seq", F.row_number().over(inside).cast("long") - 1)
            .withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("size")))


def file_node() -> Column:
    """A file's number above the file roots, from 0; numbers below zero stand between the others."""
    return F.when(F.col("file") < 0, -2 * F.col("file") - 1).otherwise(2 * F.col("file"))


class MerkleTree:
    """The levels of a tree in the shared folder; ``level(i)`` has (node, parent, start, end, hash), level 0 the leaves.

    Up to the file roots nodes are numbered within their file, above that by file. Build it from leaves
    (file, seq, start, end, content): content is the hash of the record's bytes, null if they could not be read.
    """

    def __init__(self, leaves: DataFrame, name: str):
        self.spark, self.folder = leaves.sparkSession, scratch_dir(leaves.sparkSession, f"merkle-{name}")
        self.depth = 0
        ranged = leaves.select(
            "file", F.col("seq").alias("node"), "start", "end",
            F.sha2(F.concat_ws(":", F.col("start").cast("string"), F.col("end").cast("string"), F.coalesce("content", F.lit("unreadable"))), 256).alias("hash"))
        current = self._write(ranged)
        while current.agg(F.max("node")).first()[0] not in (None, 0):  # within the files
            current = self._write(self._above(current, "file", F.expr(f"node div {FANOUT}")))
        self.file_level = self.depth - 1
        current = current.select(F.lit(0).cast("long").alias("file"), file_node().alias("node"), "start", "end", "hash")
        while True:  # over the files
            low, high = current.agg(F.min("node"), F.max("node")).first()
            if low == high:
                break
            current = self._write(self._above(current, "file", F.expr(f"node div {FANOUT}")))

    def _above(self, nodes: DataFrame, file: str, parent: Column) -> DataFrame:
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))  # FANOUT at most
        return (nodes.withColumn("parent", parent.cast("long")).groupBy(file, "parent")
                .agg(F.min("start").alias("start"), F.max("end").alias("end"), children.alias("children"))
                .select("file", F.col("parent").alias("node"), "start", "end", F.sha2(F.concat_ws(
                    ":", F.col("start").cast("string"), F.col("end").cast("string"), F.col("children.hash")), 256).alias("hash")))

    def _write(self, nodes: DataFrame) -> DataFrame:
        path = f"{self.folder}/level-{self.depth}"
        nodes.write.parquet(path)
        self.depth += 1
        return self.spark.read.schema(nodes.schema).parquet(path)

    def level(self, i: int) -> DataFrame:
        """(file, node, up_file, up_node, start, end, hash): a node and the one above it."""
        nodes = self.spark.read.parquet(f"{self.folder}/level-{i}")
        node = file_node() if i == self.file_level else F.col("node")
        up_file = F.col("file") if i < self.file_level else F.lit(0).cast("long")
        return nodes.select("file", "node", up_file.alias("up_file"), F.floor(node / FANOUT).alias("up_node"), "start", "end", "hash")


def audit(first: MerkleTree, second: MerkleTree) -> DataFrame:
    """(file, seq, start, end) of the records that differ between two replicas of one manifest, found from the root down.

    Each level is read only below nodes that differ. Two equal trees give an empty frame after the roots.
    """
    if first.depth != second.depth:
        raise ValueError("the replicas have manifests of different shape")
    differing = None
    for i in reversed(range(first.depth)):
        a, b = first.level(i), second.level(i)
        if differing is not None:
            above = differing.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            a, b = (t.join(above, ["up_file", "up_node"], "left_semi") for t in (a, b))
        differing = (a.alias("a").join(b.alias("b"), ["file", "node"], "full")
                     .where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
                     .select("file", "node", F.coalesce("a.start", "b.start").alias("start"), F.coalesce("a.end", "b.end").alias("end")))
        path = f"{first.folder}/differing-{i}-{second.folder.rsplit('-', 1)[-1]}"
        differing.write.parquet(path)
        differing = first.spark.read.schema(differing.schema).parquet(path)
    return differing.withColumnRenamed("node", "seq")


def audit_pages(pages: DataFrame, replica_html: Column) -> DataFrame:
    """Every page as a WARC record, with its place and whether its copy, as ``replica_html`` has it, is whole.

    One row per row of ``pages`` (page_id, url, html): page_id, file, seq, start, end, content (hash of the
    record), damaged. A null in the replica means that the record could not be read. Null urls and texts are
    empty; a null page_id goes to file -1; rows with equal ids are ordered by their content. An empty table gives no rows.
    """
    readable = replica_html.isNotNull() | F.col("html").isNull()
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    copy = F.when(readable, F.sha2(warc_record(F.col("page_id"), F.col("url"), replica_html), 256))
    hashed = pages.select("page_id", F.octet_length(record).alias("size"), F.sha2(record, 256).alias("content"), copy.alias("copy"))
    file = F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), F.lit(-1)).cast("long")
    placed = manifest(hashed, file, ["page_id", "content", "copy"])
    path = f"{scratch_dir(pages.sparkSession, 'manifest')}/records"
    placed.write.parquet(path)
    placed = pages.sparkSession.read.schema(placed.schema).parquet(path)
    first = MerkleTree(placed.select("file", "seq", "start", "end", "content"), "first")
    second = MerkleTree(placed.select("file", "seq", "start", "end", F.col("copy").alias("content")), "second")
    found = audit(first, second).select("file", "seq", F.lit(True).alias("damaged"))
    return placed.join(found, ["file", "seq"], "left").select(
        "page_id", "file", "seq", "start", "end", "content", F.coalesce("damaged", F.lit(False)).alias("damaged"))
