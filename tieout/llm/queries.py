"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import (
    exact_dedup,
    exact_topk,
    mixing,
    ngram_join,
    pages,
    periodic_runs,
    personal_data,
    pieces,
    quality,
    substring_dedup,
    token_counts,
    token_files,
    walsh_clusters,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(path: str | None = None) -> pieces.Pieces:
    """The pieces of a sentencepiece model; the public 32k one unless a path is given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.Pieces.load(path)


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"), personal_data.labelled_table(spark))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents"))


def op6_exact_dedup_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), vocabulary())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op11_token_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    rows = token_files.read_token_files(spark, folder)
    rows = cut_lineage(rows.select("file", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    return token_files.with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh_clusters.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, scale=256)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), folds=4, least=6, rewrite=periodic_runs.planted_tail)
    return periodic_runs.run_digests(runs)


QUERIES: dict[str, Query] = {
    "op1_quality_mil": op1_quality_mil,
    "op2_pii_crf": op2_pii_crf,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_host_paths": op4_host_paths,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup_tree": op6_exact_dedup_tree,
    "op7_exact_topk": op7_exact_topk,
    "op8_token_counts": op8_token_counts,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_mixing": op10_mixing,
    "op11_token_rans": op11_token_rans,
    "op12_walsh_clusters": op12_walsh_clusters,
    "op13_periodic_runs": op13_periodic_runs,
}
