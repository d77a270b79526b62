"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwell.llm import audit, chat, embeddings, mixing, oracle, packing, pii, ranking, rules, simhash, suffixes, tokencount, tokenfiles, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


#: Weights of the domains that documents are mixed to.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the domain classifier: languages of the documents that ``labels`` covers."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read(tokenfiles.write(table(spark, sf_dir, "documents")))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.BASE, "base_failed", "kept", "rule")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base, every = pii.joined(F.col("base")), pii.joined(F.col("spans"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed and remaining bytes of every document, for repeats of 400 bytes."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda done, s: done + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return ranking.search(ranking.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters does at each step of all 120 orders, for each language."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = (
    op1_simhash_near_duplicates,
    op2_token_counts,
    op3_toxicity,
    op4_embedding_near_duplicates,
    op5_soft_mixing,
    op6_best_fit_packing,
    op7_token_files,
    op8_chat_formatting,
    op9_quality_rules,
    op10_pii,
    op11_suffix_array_dedup,
    op12_ranked_lexical_search,
    op13_filter_interaction_audit,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL expresses neither learned models, nor tokenizers, nor walks over links; repeats of bytes are too slow in it."""
    return {"op12_ranked_lexical_search": oracle.RANKED_SEARCH, "op13_filter_interaction_audit": oracle.FILTER_AUDIT}
