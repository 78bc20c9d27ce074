"""A corpus from raw documents to packed sequences.

Each stage takes what its predecessor kept, written as Parquet and read again, so a
stage survives the loss of executors and can be looked at by itself.  All but the
last return the columns of `documents`.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.llm import best_fit, jaccard_join, suffix_dedup, toxicity  # noqa: E402
from tidewell.llm.tables import written  # noqa: E402
from tidewell.llm.tokens import vocabulary  # noqa: E402
from tidewell.session import prepare  # noqa: E402

#: A repeated passage has more words than this, and so many bytes at least (words of one letter).
PASSAGE_WORDS = 50
PASSAGE_BYTES = 2 * PASSAGE_WORDS + 1
TOKENIZER = "byte_bpe_50k.json"


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores at 0.3 or more go; it learns from `labels`."""
    return toxicity.drop_toxic(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 of five-word shingles the document with the smallest id stays."""
    prepare(spark)
    return jaccard_join.drop_similar(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of a passage of more than 50 words are cut from the text, the first stays; n_chars is kept as it was."""
    prepare(spark)
    return suffix_dedup.without_passages(docs, words=PASSAGE_WORDS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    prepare(spark)
    return best_fit.pack(docs, tokenizer=vocabulary(TOKENIZER), end_id=0, capacity=2048)


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("packing", packed)]

#: The lexicon, the tokenizer and the packing cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{i}")
    return docs
