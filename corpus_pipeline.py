"""From raw documents to packed training sequences, in five stages.

toxicity            documents of a toxic probability of one half or more go
ngram_jaccard_join  of each class of near duplicates the document with the least id stays
secret_scans        secrets are masked in the text; every document stays
mix_sources         documents are put into the order in which sources reach their target weights
best_fit_packing    texts become token sequences of 1,024, numbered in the order of the mix; one row per piece

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next one's
documents. All but the last return the columns that they got. The stages train and use hashes that SQL does
not have, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.mixing import in_mix_order
from tallybook.llm.ngram_join import near_duplicate_classes
from tallybook.llm.packing import pack_documents
from tallybook.llm.queries import vocabulary
from tallybook.llm.secret_scan import redact
from tallybook.llm.toxicity import score_toxicity, train_toxicity
from tallybook.session import remove, scratch_dir

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below one half; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, train_toxicity(docs, labels, ["toxic"]))
    return scored.where("p_toxic < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class. Of rows with one id in one class one stays; rows without id all stay."""
    classes = near_duplicate_classes(docs)
    path = f"{scratch_dir(spark, 'kept-ids')}/ids"
    (classes.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"))
     .write.parquet(path))
    kept = spark.read.schema("doc_id bigint, copies bigint").parquet(path)
    single = docs.join(kept.where("copies = 1"), "doc_id", "left_semi")
    repeated = docs.join(kept.where("copies > 1"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(docs.where("doc_id is null")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked. Null and empty texts, repeated rows and an empty table stay as they are."""
    return redact(docs, length_column="n_chars").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mix. Nulls and repeated rows stay; an empty table stays empty."""
    return in_mix_order(docs, key=F.col("doc_id"))


def in_written_order(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a table of Spark's part files, dealt out in the order in which its rows were written.

    A plain read deals files out by size. Here a row of a lower partition stands before all rows of a higher one.
    Frames that do not come from files have no such order and stay as they are.
    """
    try:
        rows = docs.select(*columns, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return docs.select(*columns)
    place = [F.expr("try_cast(regexp_extract(__file, '^part-([0-9]+)', 1) as bigint)"), F.col("__file"), F.col("__row")]
    return rows.repartitionByRange(*place).sortWithinPartitions(*place).select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ascending sequence_id follows the mix, as far as the open sequences of a partition reach.

    A null text counts as empty and gives one piece; repeated rows are packed one by one; an empty table gives no rows.
    """
    rows = in_written_order(docs, ["doc_id", "text"])
    return pack_documents(rows, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"),
                          keep_order=True)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates), ("secret_scans", mask_secrets),
          ("mix_sources", mix), ("best_fit_packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each but the last returns is a table in the shared folder, until the next is there."""
    folder, before = scratch_dir(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
