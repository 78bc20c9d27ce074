"""Thin registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import conversation_repair, lexical_search, license_scan, mixing
from tidewell.session import prepare

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


@query("op1_toxicity")
def op1_toxicity(spark, sf):
    from tidewell.llm import toxicity
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf):
    from tidewell.llm import suffix_dedup
    return suffix_dedup.removal_digest(table(spark, sf, "documents"), length=400)


@query("op10_jaccard_join")
def op10_jaccard_join(spark, sf):
    from tidewell.llm import jaccard_join
    return jaccard_join.similar_groups(table(spark, sf, "documents"), percent=80, words=5)


@query("op6_best_fit")
def op6_best_fit(spark, sf):
    from tidewell.llm import best_fit
    from tidewell.llm.tokens import vocabulary
    return best_fit.pack(table(spark, sf, "documents"), tokenizer=vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


@query("op3_token_files")
def op3_token_files(spark, sf):
    from tidewell.llm import token_files
    from tidewell.llm.tokens import vocabulary
    return token_files.store_digest(table(spark, sf, "documents"), tokenizer=vocabulary("word_bpe_49k.json"), end_id=1)


@query("op7_token_counts")
def op7_token_counts(spark, sf):
    from tidewell.llm import token_counts
    from tidewell.llm.tokens import vocabulary
    return token_counts.section_tokens(table(spark, sf, "documents"), tokenizer=vocabulary("byte_bpe_50k.json"))


@query("op9_piece_sampling")
def op9_piece_sampling(spark, sf):
    from tidewell.llm import piece_sampling
    from tidewell.llm.tokens import vocabulary
    return piece_sampling.sample_segmentations(table(spark, sf, "documents"), model=vocabulary("piece_bpe_32k.model"), k=2, with_ids=False)


@query("op4_license_scan", license_scan.scan_sql())
def op4_license_scan(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


@query("op2_ann_forest")
def op2_ann_forest(spark, sf):
    from tidewell.llm import ann_forest
    return ann_forest.nearest(table(spark, sf, "embeddings"), query=F.col("vec_id") % 20 == 0, k=20)


@query("op8_rp_forest")
def op8_rp_forest(spark, sf):
    from tidewell.llm import rp_forest
    return rp_forest.near_vectors(table(spark, sf, "embeddings"), cosine=0.98)


@query("op13_lexical_search", lexical_search.search_sql())
def op13_lexical_search(spark, sf):
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


@query("op12_source_mix", mixing.words_sql())
def op12_source_mix(spark, sf):
    return mixing.words_taken(table(spark, sf, "documents"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark, sf):
    return conversation_repair.damaged_report(table(spark, sf, "conversations"))
