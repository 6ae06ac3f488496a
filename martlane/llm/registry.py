"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlane.llm import (
    ann,
    chat,
    jaccard,
    licenses,
    lm,
    merkle,
    mixing,
    near_vectors,
    packing,
    quality,
    repair,
    substrings,
    token_files,
    tokens,
)
from martlane.llm.common import table
from martlane.session import work_folder


def _in_front(found: DataFrame, *asked: str) -> DataFrame:
    """The asked columns, then the operator's own."""
    return found.select(*asked, *[c for c in found.columns if c not in asked])


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.public(tokens.BYTE_BPE)
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary)


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return _in_front(found, "vec_id", "n_links", "component_id", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(table(spark, sf_dir, "documents"), size=3, percent=90)
    return _in_front(found, "doc_id", "n_shingles", "component_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), tokens.public(tokens.WORD_BPE), path)
    return token_files.read(spark, path)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    mixed = mixed.drop("print")
    return _in_front(mixed, "doc_id", "size", "source_size", "target", "taken")


def op10_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return lm.score(table(spark, sf_dir, "documents"), good)


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.report(rows, rows["times"])


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_near_vectors": op3_near_vectors,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_token_files": op7_token_files,
    "op8_license_scan": op8_license_scan,
    "op9_mix_sources": op9_mix_sources,
    "op10_cross_entropy_difference": op10_cross_entropy_difference,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_chat_format": op12_chat_format,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op12_chat_format": chat.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
