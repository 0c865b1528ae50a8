"""The corpus pipeline: stages that each apply one operator to what the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.llm import bpe, decontamination, line_dedup, near_dedup, quality_rules
from hexledger.llm.frames import counted, fresh, read_table, same
from hexledger.session import materialize

TOKENIZER = "word_bpe_49k.json"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    trusted = quality_rules.trusted(read_table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, trusted).where("kept").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are deleted from the texts; documents of which no word is left go."""
    deduped = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = deduped.where(~F.coalesce(emptied, F.lit(False)))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    judged = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    found = materialize(judged.where("contaminated").select("doc_id", "text_hash").distinct(), "contaminated")
    gone = counted(found, found.count(), near_dedup.BROADCAST_NODES)
    own = fresh("_hash", docs)
    rows = docs.withColumn(own, F.xxhash64("text"))
    on = same(rows["doc_id"], gone["doc_id"]) & (rows[own] == gone["text_hash"])
    return rows.join(gone, on, "left_anti").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of the text that they decode to."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", reject_low_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]

# The quality rules' hashed counts and the tokenizer's merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written as Parquet and read again as the next one's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
