"""A corpus from documents to packed sequences, stage by stage; each stage is written and read again.

1. quality rules: documents that fail go
2. line dedup: later lines of recurring templates go, and documents of which nothing is left
3. n-gram Jaccard join: of each group of near copies the smallest `doc_id` stays
4. suffix-array dedup: byte strings that an earlier document has go, and documents of which nothing is left
5. best-fit packing: what is left, cut into pieces and placed in sequences

Where a text changes, `n_chars` follows it. Stages keep every column of the documents.
Rows without `doc_id` pass the near-duplicate stages untouched; rows that repeat a
`doc_id` stay or go together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm._shared import ship_package, staged
from tallyhouse.llm.best_fit_packing import pack_documents
from tallyhouse.llm.line_templates import without_boilerplate
from tallyhouse.llm.ngram_join import Similarity, ngram_components
from tallyhouse.llm.quality_rules import keep_good
from tallyhouse.llm.suffix_dedup import suffix_dedup


#: Near copies: sets of five-word shingles with at least four fifths of their union in common.
NEAR = Similarity(words=5, percent=80)


def _sized(docs: DataFrame) -> DataFrame:
    """`n_chars` as the length of the text, where the column is there."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _has_word(text: Column) -> Column:
    return F.coalesce(text.rlike("[^ \t\r\n\u000b\f]"), F.lit(False))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship_package(spark)
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines."""
    return _sized(without_boilerplate(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest `doc_id`."""
    ship_package(spark)
    copies = ngram_components(docs, NEAR).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, docs["doc_id"] == copies["doc_id"], "left_anti")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that an earlier document has."""
    ship_package(spark)
    found = suffix_dedup(docs, with_text=True).select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("n_removed").alias("__removed"), F.col("kept").alias("__kept")
    )
    found = found.where(F.col("__removed") > 0).dropDuplicates(["__id", "__key"])
    keyed = docs.withColumn("__hash", F.xxhash64("text"))
    joined = keyed.join(found, (keyed["doc_id"] == F.col("__id")) & (keyed["__hash"] == F.col("__key")), "left")
    # A cut may go through a character; what is left of it is dropped.
    left = F.replace(F.make_valid_utf8(F.col("__kept").cast("string")), F.lit("�"), F.lit(""))
    changed = F.col("__removed").isNotNull()
    texts = joined.withColumn("text", F.when(changed, left).otherwise(F.col("text")))
    return _sized(texts.where(~changed | _has_word(F.col("text"))).select(*docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, placed in sequences of 4096 tokens."""
    ship_package(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Compression ratios and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
