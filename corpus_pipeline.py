"""The stages of a training corpus, from raw documents to encoded texts.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. All but the last return the columns of ``docs``, also those that no stage
knows. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tieout.llm import exact_dedup, mixing, ngram_join, pieces, quality
from tieout.llm.common import table
from tieout.llm.queries import vocabulary
from tieout.session import cut_lineage, forget


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near duplicates, the one with the smallest id."""
    return ngram_join.one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as they are taken, the last time perhaps in part."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, per row of the mixture."""
    return pieces.digests(docs, vocabulary())


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing to target weights", mix),
    ("SentencePiece encoding", encode),
]

#: A learned classifier and piece encoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's result is written once, read by the next one, and deleted after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
