"""A corpus pipeline: quality filter, near-duplicate removal, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import byte_bpe, mixing, ngram_join, rule_classifier
from partwise.llm._batches import stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble accepts, with their columns; it learns from labels of documents not held out.

    Empty and null texts are judged by their statistics (all 0), equal texts alike, repeated rows each. Without labels
    every score is 0.5, below the cut, so nothing stays. No rows in, no rows out.
    """
    return rule_classifier.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id, with its columns.

    Texts without words and rows of a null doc_id are no one's copies and stay. Repeated rows are one. No rows in, no
    rows out.
    """
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them (0 to 2 times), with their columns.

    A null source is a source. Rows of no words are taken or not by their hash, as others are. No rows in, no rows out.
    """
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document left, repeats included; null and empty texts have no ids."""
    import public_tokenizers

    ids = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_filter", quality_filter), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("token_ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again but for the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the classifier nor the join at this scale; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None
