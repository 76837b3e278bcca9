"""Pipeline over ``documents``: language, repeated lines, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents.

Nulls, empty texts and repeated rows: documents without a letter go with the
first stage; texts that later lose all their lines stay, as empty texts, in
every stage. Rows without an id are never dropped as copies. An empty table
passes through. Extra columns are kept up to the last stage, which returns
doc_id, n_tokens and ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tackroom.llm.bpe import tokenize
from tackroom.llm.decontaminate import clean_documents
from tackroom.llm.langid import keep_identified
from tackroom.llm.line_dedup import dedup_lines
from tackroom.llm.near_dedup import keep_first
from tackroom.llm.storage import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents without a language go; ``lang`` becomes the identified language."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: lines that resemble an earlier line are cut out; ``n_chars`` follows the text."""
    cut = dedup_lines(docs)
    return cut.select(*(F.length("text").cast(cut.schema[c].dataType).alias(c) if c == "n_chars" else c for c in cut.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group stays (five words, similarity 0.8)."""
    return keep_first(docs, shingle=5, similarity=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents of which benchmark passages are a twentieth or more go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the token ids of what is left."""
    return tokenize(docs, TOKENIZER, outputs=("n_tokens", "ids"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe", bpe)]

ORACLE_SQL = None  # language ID and BPE cannot be expressed; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
