"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, divergence, html_text, language, media, minhash, packing, simhash, spelling, token_store, topk, toxicity, url_filter
from terrace.llm.common import spread, table
from terrace.llm.tokens import default_tokenizer


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table, over all cores."""
    return spread(table(spark, sf_dir, "documents"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.document_languages(_documents(spark, sf_dir))


def op2_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.page_languages(spread(table(spark, sf_dir, "pages")), _documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir), default_tokenizer())


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(table(spark, sf_dir, "pages"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(_documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), default_tokenizer())


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_check(_documents(spark, sf_dir), default_tokenizer())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spread(table(spark, sf_dir, "pages")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_language_id, op2_language_id_pages, op3_bpe, op4_top_k, op5_url_filter, op6_media, op7_packing, op8_token_store, op9_toxicity, op10_html_text, op11_minhash, op12_spelling, op13_divergence, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op4_top_k": topk.TOPK_SQL, "op5_url_filter": url_filter.FILTER_SQL, "op11_minhash": minhash.NEAR_SQL, "op13_divergence": divergence.AUDIT_SQL}
