"""A corpus pipeline of five operators; each stage's result is written and read again as the next one's documents.

All stages but the last return the columns of documents (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import op2_mixing, op3_bpe, op4_ngram_jaccard, op5_quality_rules, op8_suffix_dedup
from llm.common import dropped, load, ship, with_row, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the limits of their language and source."""
    ship(spark)
    return op5_quality_rules.quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays; rows that share that id stay together.

    Rows are linked by their own texts, whatever their ids. Null ids stand last; of a group of null ids one row stays.
    """
    ship(spark)
    rows = with_row(docs.select(*COLUMNS), "row")
    group = op4_ngram_jaccard.jaccard_join(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    linked = written(spark, group.join(rows.select("row", "doc_id", F.xxhash64("text").alias("h")), "row"), "linked")
    kept = linked.groupBy("group").agg(F.min("doc_id").alias("least"), F.min(F.struct("h", "row"))["row"].alias("one"), F.count("*").alias("c")).filter("c > 1")
    gone = linked.join(kept, "group").filter("CASE WHEN least IS NULL THEN row <> one ELSE NOT doc_id <=> least END").select("row")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes of 50-byte strings that an earlier document has; documents of which no word is left go.

    A character that is cut in part goes whole. Each row keeps its own columns, whatever its doc_id; null ids stand last.
    """
    cut = op8_suffix_dedup.suffix_dedup(docs.select(*COLUMNS), keep="string", carry=["lang", "source"]).withColumnRenamed("kept", "text")
    left = cut.filter("n_removed = 0 OR regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]') > 0")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document; what it takes twice is a second row."""
    ship(spark)
    return op2_mixing.taken_texts(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with the digests of the ids and of the text that they decode to."""
    ship(spark)
    return op3_bpe.bpe(docs, keep_text=False).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

#: Suffix comparison and BPE are beyond SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
