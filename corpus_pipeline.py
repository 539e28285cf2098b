"""From raw documents to token ids: reject, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last keep the columns
of ``documents``. What a stage returns is written as Parquet and read again as the next
stage's documents. Rows without a doc_id pass the deduplicating stages as they are; null texts
are scored as blanks, have no passages, and encode to no ids. Documents need doc_id and text;
other columns stay, and ``n_chars``, where there is one, follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm import bpe, decontaminate, passages, quality, simhash
from tagpulse.llm.queries import QUALITY_THRESHOLD, learnable
from tagpulse.llm.shared import free_names, settle, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labels not held out, accepts."""
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels")), label="quality")
    return docs.where(quality.score(F.col("text"), model) >= QUALITY_THRESHOLD)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates. Rows that share an id
    are versions of one document: of those with equal texts one stays, different texts all
    stay, and a null text goes where there is another."""
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    heads = found.where("doc_id = component_id").select("doc_id").distinct()
    columns = docs.columns
    row, texts = free_names(columns, "row", "texts")
    # By digest, so that hot ids and long texts meet in no task.
    digest = F.sha2(F.col("text"), 256)
    one = F.row_number().over(Window.partitionBy("doc_id", digest).orderBy("doc_id"))
    some = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    single = docs.join(heads, "doc_id", "left_semi").withColumn(row, one).where(F.col(row) == 1).drop(row)
    marked = single.join(some.withColumn(texts, F.lit(True)), "doc_id", "left")
    kept = marked.where(F.col("text").isNotNull() | F.col(texts).isNull()).select(*columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def _recounted(docs: DataFrame) -> DataFrame:
    """Where texts are counted, counted again."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars"))


def without_copied_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that documents of smaller ids have."""
    return _recounted(passages.remove(docs)).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of benchmark items; documents that are mostly such passages go."""
    clean = decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))
    return _recounted(clean).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and digests of ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = bpe.load(path, public_tokenizers.PATTERN)
    both = bpe.encode_and_decode(F.col("text"), vocabulary).alias("both")
    return docs.select("doc_id", both).select("doc_id", "both.*").select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("copied_passages", without_copied_passages),
    ("benchmark", without_benchmark),
    ("token_ids", token_ids),
]

#: SQL expresses neither the network, the fingerprints nor the merges; tests hold every stage
#: against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
