"""Corpus cleaning over ``documents``: five stages, each applied to all rows
its predecessor kept, written as Parquet and read again as the next one's
``docs``.

1. toxicity: documents scoring 0.5 or more go
2. language ID: documents without letters, or in which no language has half
   of the words, go
3. n-gram Jaccard join: of each group of linked documents the one of least
   doc_id stays
4. benchmark decontamination: documents holding a window of the benchmark go
5. SentencePiece: the rest is encoded to ids, and the ids are decoded again

Stages 1 to 4 return the columns of ``documents``; the last returns doc_id,
n_ids, ids and whether they decode to the text.  Models are fitted on what the
stage is given (with the labels table for toxicity).

Defined cases: null and empty texts are not toxic, but have no language and go
in stage 2, as do texts without a letter.  Repeated rows are judged alike; stage
3 keeps one row of them (equal ids and equal words), and of linked documents of
equal doc_id the one of least text key.  Documents with a null doc_id are judged
by their text and stay only if their group has no other id.  Columns beyond
those of ``documents`` pass through stages 1 to 4 whatever their names.  Texts of
any length are worked on whole (about 35 bytes of memory a byte of the longest).
Empty tables give an empty result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import decontaminate, jaccard_join, language, sentencepiece_codec, toxicity
from lodestar.llm.common import table, written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.drop_unidentified(docs, language.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_checked(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("language ID", in_a_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", encoded),
]

#: the stages have no SQL form; tests hold each against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
