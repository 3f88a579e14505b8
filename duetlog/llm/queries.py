"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, debruijn, decontam, fim, langid, lexical, maintext, pieces, pii, quality, shards, simhash, warc
from .common import read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(read(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op3_de_bruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.removed(read(spark, sf_dir, "documents"))


def op4_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load()
    sampled = pieces.encoded(read(spark, sf_dir, "documents"), vocabulary)
    return pieces.decoded(sampled, vocabulary, *sampled.columns)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(read(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    queries = vectors.where(vectors["vec_id"] % ann.QUERY_STEP == 0)
    return ann.search(ann.build(vectors), queries)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_personal_data": op2_personal_data,
    "op3_de_bruijn_dedup": op3_de_bruijn_dedup,
    "op4_kd_tree_sharding": op4_kd_tree_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op6_piece_sampling": op6_piece_sampling,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_warc_archives": op9_warc_archives,
    "op10_main_text": op10_main_text,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op5_quality_rules": quality.oracle_sql(),
    "op7_benchmark_decontamination": decontam.oracle_sql(),
    "op9_warc_archives": warc.oracle_sql(),
    "op11_fill_in_middle": fim.oracle_sql(),
    "op12_nearest_vectors": ann.oracle_sql(),
    "op13_lexical_search": lexical.oracle_sql(),
}
