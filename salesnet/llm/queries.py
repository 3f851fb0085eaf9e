"""The registered ``opN_*`` queries, the pipeline, and the SQL that checks them."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from salesnet.llm import (collocations, cross_parse, mil_quality, ngram_trie, packing, rp_forest, rules_forest, shard_tree,
                          simhash, source_mix, template, text_prints, token_alignment)
from salesnet.llm.common import table

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.embedding_components(table(spark, sf_dir, "embeddings"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.shard_documents(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_forest.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract_main_text(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parse.identify_languages(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.lm_scores(table(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_prints.document_fingerprints(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(table(spark, sf_dir, "documents"), *map(tokenizer_path, ALIGNED))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_embedding_near_dedup, op2_source_mix, op3_best_fit_packing, op4_quality_classifier, op5_hash_tree_sharding,
           op6_simhash_near_dedup, op7_quality_rules, op8_html_extraction, op9_language_id, op10_lm_scoring,
           op11_document_fingerprints, op12_token_alignment, op13_phrase_collocations)
    return {**{f.__name__: f for f in ops}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"op13_phrase_collocations": collocations.COLLOCATIONS_SQL, **pipeline}
