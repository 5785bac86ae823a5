"""Registered queries of this subpackage: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    chat_format,
    decontaminate,
    fingerprints,
    hard_negatives,
    html_extract,
    jaccard_join,
    language,
    masked_lm,
    merkle,
    sentencepiece_codec,
    tokens,
    toxicity,
    url_filter,
)
from lodestar.llm.common import is_held_out, table
from lodestar.llm.oracles import ANCHOR_EVERY, ORACLES, PLANTED_TURN, TAMPERED_EVERY

__all__ = ["ORACLES", "QUERIES"]


def op1_crf_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    bench = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.leak_report(decontaminate.find_leaks(docs, bench))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", is_held_out("doc_id", *language.HELD_OUT).alias("held_out"), "lang_pred", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of every document in the token files."""
    return tokens.encoded_positions(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_masked_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return masked_lm.scored_corpus(docs)


def op7_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge(pages, url_filter.listed_hosts(pages))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard_join.linked_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", is_held_out("doc_id", *toxicity.HELD_OUT).alias("held_out"), "score", "predicted")


def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, decoded again."""
    coded = sentencepiece_codec.round_trips(table(spark, sf_dir, "documents", "doc_id", "text"))
    return coded.select("doc_id", "n_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


def op11_chat_prefix_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation's training examples, read back from them."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat_format.TARGET_ROLE).alias("role"), F.lit(PLANTED_TURN).alias("text"))
    return chat_format.digests(chat_format.examples(turns.unionByName(planted)))


def op12_residue_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantized(rows.withColumn("label", label))
    return hard_negatives.mine(rows, F.col("vec_id") % ANCHOR_EVERY == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, checked against the root."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")

    def leaf(n_chars):
        return merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    claimed = F.when(tampered, leaf(F.col("n_chars").cast("decimal(20,0)") + 1))
    manifest = merkle.Manifest(docs.select(F.col("lang").alias("tree_key"), F.col("doc_id").alias("id"),
                                           leaf(F.col("n_chars")).alias("leaf"), claimed.alias("claimed")))
    return manifest.proofs().withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_crf_html_extraction,
    op2_winnowing_decontamination,
    op3_document_fingerprints,
    op4_language_mixture,
    op5_token_files,
    op6_masked_lm_scoring,
    op7_bloom_url_filter,
    op8_ngram_jaccard_join,
    op9_subword_toxicity,
    op10_sentencepiece_codec,
    op11_chat_prefix_examples,
    op12_residue_hard_negatives,
    op13_merkle_manifest,
)}
