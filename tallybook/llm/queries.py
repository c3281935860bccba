"""The operators as queries on the test tables, with production parameters and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.fixity import audit_pages
from tallybook.llm.mixing import mix_sources
from tallybook.llm.ngram_join import near_duplicate_classes
from tallybook.llm.outliers import reject_outliers
from tallybook.llm.packing import pack_documents
from tallybook.llm.periodic_runs import detect_runs
from tallybook.llm.quality import score_quality, train_quality
from tallybook.llm.secret_scan import BASE_KINDS, find_secrets
from tallybook.llm.token_alignment import align_tokens
from tallybook.llm.token_counts import count_pieces
from tallybook.llm.toxicity import score_toxicity, train_toxicity
from tallybook.llm.vector_packing import Limits, pack_examples
from tallybook.llm.winnowing import edit_check

QUERIES, ORACLE = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, the same on every machine of the cluster."""
    from public_tokenizers import path

    return path(name)


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                            vocabulary("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id",
                         "offset")


@query
def op3_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = edit_check(table(spark, sf_dir, "documents"))

    def text_of(hashes: str):
        return F.expr(f"array_join(transform({hashes}, x -> hex(x)), ' ')")

    return checked.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                          text_of("hashes").alias("fingerprint"), text_of("edited_hashes").alias("edited_fingerprint"),
                          "near_edited", "near_next", "positions")


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(secret_spans, s -> s.kind in ({}))".format(", ".join(f"'{k}'" for k in BASE_KINDS))
    count = "cast(size(filter(secret_spans, s -> s.kind = '{}')) as bigint)"
    return found.select("doc_id", *[F.expr(count.format(k)).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(F.expr(listed.format(base)), 256).alias("base_sha256"),
                        F.expr(listed.format("secret_spans")).alias("spans"))


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(docs, key=F.col("doc_id"))


@query
def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return reject_outliers(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "base_failed", "kept", "distance")


@query
def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train_toxicity(docs, table(spark, sf_dir, "labels"), ["toxic"])
    return score_toxicity(docs, chain).select("doc_id", "p_toxic", "p_severe", (F.col("p_toxic") >= 0.5).alias("toxic"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = train_quality(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_pieces(docs, vocabulary("piece_bpe_32k.model")).drop("text")


@query
def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 4,096 tokens of at most 64 documents; every token of a plain document bears loss."""
    pieces = pack_examples(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                           limits=Limits(tokens=4096, segments=64, loss_tokens=4096))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "loss_tokens")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of about a tenth of the documents repeat a stretch from some place to their end."""
    split = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
                        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    placed = split.selectExpr("doc_id", "text", "h", "w", "size(w) as n", "h div 10 as g",
                              "case when size(w) > 0 then (h div 10) % size(w) end as a")
    again = F.expr("""array_join(transform(sequence(0, n - 1), i ->
        w[cast(if(i < a, i, a + (i - a) % (1 + (n - a) div (3 + g % 8))) as int)]), ' ')""")
    return placed.select("doc_id", F.when(F.expr("h % 10 = 0 and n > 0"), again).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second replica has a changed character in some records and some that cannot be read."""
    half = F.expr("length(html) div 2")
    changed = F.concat(F.substring("html", F.lit(1), half), F.lit("~"), F.expr("substring(html, length(html) div 2 + 2)"))
    replica = (F.when(F.expr("page_id % 499 = 7"), F.lit(None).cast("string"))
               .when(F.expr("page_id % 101 = 3"), changed).otherwise(F.col("html")))
    return audit_pages(table(spark, sf_dir, "pages"), replica)


ORACLE["op8_warc_fixity"] = """
WITH two AS (
  SELECT page_id, url, html, CASE WHEN page_id % 499 = 7 THEN NULL
    WHEN page_id % 101 = 3 THEN substr(html, 1, length(html) // 2) || '~' || substr(html, length(html) // 2 + 2)
    ELSE html END AS copy
  FROM pages),
records AS (
  SELECT page_id, copy IS NOT NULL OR html IS NULL AS readable,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
      || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
    coalesce(html, '') AS html, coalesce(copy, '') AS copy, chr(13) || chr(10) || chr(13) || chr(10) AS gap
  FROM two),
hashed AS (
  SELECT page_id, strlen(head || strlen(html) || gap || html || gap) AS size, sha256(head || strlen(html) || gap || html || gap) AS content,
    CASE WHEN readable THEN sha256(head || strlen(copy) || gap || copy || gap) END AS copy
  FROM records),
placed AS (
  SELECT page_id, page_id // 1024 AS file, size, content, copy,
    row_number() OVER (PARTITION BY page_id // 1024 ORDER BY page_id, content, copy) - 1 AS seq,
    CAST(sum(size) OVER (PARTITION BY page_id // 1024 ORDER BY page_id, content, copy ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end"
  FROM hashed)
SELECT page_id, file, seq, "end" - size AS "start", "end", content, content IS DISTINCT FROM copy AS damaged FROM placed
"""
