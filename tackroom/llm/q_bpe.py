"""Query of operator 2."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tackroom.llm.bpe import tokenize
from tackroom.llm.registry import query, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op2_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: every whole text of ``documents`` encoded and decoded, as digests."""
    return tokenize(table(spark, sf_dir, "documents"), TOKENIZER, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
