"""From raw documents to packed training sequences: each stage takes what its predecessor kept.

A stage gets documents (doc_id, text, lang, source, n_chars) and returns those it keeps with the same columns; the last one returns pieces
of sequences. Decisions hold for a doc_id: a row goes if a row with its doc_id is rejected. Rows with a null doc_id
are decided together. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm import decontamination, near_duplicates, packing, quality, secret_scan
from starkit.llm.common import membership, with_membership
from starkit.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"
#: Documents are near duplicates from this similarity on, in hundredths. The contract of the query op10 has its own.
NEAR_PERCENT = 80
LIMITS = packing.Limits(tokens=2048, segments=128, loss_tokens=2048)

#: Fitted forests are not SQL, so the rows of a whole run have no SQL either.
ORACLE_SQL = None


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is rejected.

    Rows that a filter of fixed size tells apart from all rejected ones stay where they are; only the others are joined.
    """
    gone = stage(rejected.select(F.col("doc_id").alias("_gone")).distinct(), "rejected")
    marked = with_membership(docs, F.xxhash64(F.col("doc_id").cast("long")), membership(gone, F.xxhash64("_gone")))
    doubtful = marked.where("_maybe").join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    return marked.where("NOT _maybe").select(*COLUMNS).unionByName(doubtful.select(*COLUMNS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the isolation forests."""
    found = quality.assess(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, found.where("NOT kept"))


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id; of repeated rows one."""
    found = near_duplicates.group(docs, NEAR_PERCENT)
    kept = without(docs, found.where("NOT kept"))
    repeated = docs.groupBy("doc_id").count().where("count > 1").limit(1)
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.where("contaminated"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and n_chars as it then is."""
    found = secret_scan.scan(docs).where(F.size("spans") > 0)
    spans = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans").dropDuplicates(["_id", "_hash"])
    spans = stage(spans, "secret-spans")
    key = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text"))
    marked = with_membership(docs, key, membership(spans, F.xxhash64("_id", "_hash")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = marked.where("_maybe").join(spans, same, "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(secret_scan.redacted(F.col("text"), F.col("spans")))
    n_chars = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("_text").cast("long"))
    masked = joined.withColumn("_text", text).withColumn("n_chars", n_chars)
    masked = masked.select("doc_id", F.col("_text").alias("text"), "lang", "source", "n_chars")
    return marked.where("NOT _maybe").select(*COLUMNS).unionByName(masked)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), LIMITS, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicate_groups),
    ("benchmark decontamination", benchmark_free),
    ("secret scan", secrets_masked),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
