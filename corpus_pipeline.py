"""A training-corpus pipeline over `documents`: language ID, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a
DataFrame; run() writes it as Parquet to the shared folder and reads it again. All but the
last stage return the columns of documents. Null and empty texts: rejected by the first
stage, as they have no letter.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.bpe import bpe
from leafmill.llm.common import cut, small
from leafmill.llm.langid import reject
from leafmill.llm.line_dedup import PASSAGE_WORDS, SINGLE_WORDS, line_dedup
from leafmill.llm.mixing import mixed
from leafmill.llm.near_dedup import near_dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return reject(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines, passages of 50 words and single lines of 5 words go; a document that was
    nothing else goes as a whole."""
    out = line_dedup(docs, passage_words=PASSAGE_WORDS, single_words=SINGLE_WORDS).filter("__removed = 0 OR text RLIKE '[^\\\\s]'")
    return out.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).drop("__removed")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, from a similarity of 0.8 on, stays."""
    gone = cut(near_dedup(docs, percent=80, width=5).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "pipeline-near")
    return docs.join(small(gone), F.col("doc_id") == F.col("__gone"), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, sorted by position."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("mixing", mixing), ("bpe", tokens)]
#: Language ID and BPE have no SQL. Tests hold line dedup, near-dedup, mixing and BPE against
#: brute-force versions on each stage's input; language ID against a scorer without numpy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
