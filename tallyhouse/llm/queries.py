"""The registered queries of this package; `oracle` has SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm._shared import ship_package
from tallyhouse.llm.backtracking_bpe import round_trip
from tallyhouse.llm.best_fit_packing import pack_documents
from tallyhouse.llm.byte_cnn import score_quality
from tallyhouse.llm.flat_graph import near_duplicates
from tallyhouse.llm.license_scan import scan_licenses
from tallyhouse.llm.line_templates import line_report
from tallyhouse.llm.ngram_join import ngram_components
from tallyhouse.llm.quality_rules import quality_report
from tallyhouse.llm.spelling_trie import spelling_groups
from tallyhouse.llm.suffix_dedup import suffix_dedup
from tallyhouse.llm.token_files import read_token_files, write_token_files
from tallyhouse.llm.warc import read_archives, write_archives
from tallyhouse.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(table(spark, folder, "documents"))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, folder, "documents")))


def op4_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return line_report(table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return read_archives(write_archives(table(spark, folder, "pages")))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


def op10_flat_graph(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op12_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_spelling_trie(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_token_files": op3_token_files,
    "op4_line_templates": op4_line_templates,
    "op5_warc": op5_warc,
    "op6_license_scan": op6_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_flat_graph": op10_flat_graph,
    "op11_whitening": op11_whitening,
    "op12_byte_cnn": op12_byte_cnn,
    "op13_spelling_trie": op13_spelling_trie,
}
