"""Registered queries op1 .. op13: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import byte_bpe, chat_format, id_planes, lattice_lm, license_scan, media_columns, metric_join, mixing, ngram_join, pair_search, prefix_trie, rule_classifier, token_counts

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_rows(_documents(spark, sf_dir)).drop("hits")


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice_lm.score_documents(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op4_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = turns.unionByName(extra)
    formatted = chat_format.format_conversations(rows.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts")))
    return chat_format.digests(formatted)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns.document_media(_documents(spark, sf_dir))


def op8_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return id_planes.written_digests(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rule_classifier.scored(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_pair_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_license_scan": op2_license_scan,
    "op3_lattice_lm": op3_lattice_lm,
    "op4_metric_join": op4_metric_join,
    "op5_mixing": op5_mixing,
    "op6_chat_format": op6_chat_format,
    "op7_media_columns": op7_media_columns,
    "op8_id_planes": op8_id_planes,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_rule_classifier": op10_rule_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pair_search": op12_pair_search,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.SQL, "op6_chat_format": chat_format.SQL, "op11_prefix_trie": prefix_trie.SQL, "op12_pair_search": pair_search.SQL}
