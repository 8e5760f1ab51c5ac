"""Duplicates, top-k and mixing on the supplied tables (against SQL), and on awkward rows."""

import hashlib

import pytest

from tests.oracle_compare import compare, connect
from tieout.llm import exact_dedup, exact_topk, mixing, ngram_join, pieces, queries, sql, substring_dedup
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
LONG = " ".join(f"w{i}" for i in range(30_000))
TEXT = " ".join(f"t{i}" for i in range(60))
ROWS = [
    (1, TEXT, "a"), (2, TEXT, "a"), (2, TEXT, "a"), (3, TEXT + " more", None), (4, None, "b"), (5, "", "b"), (6, "only four words here", "b"),
    (7, "ONLY four\twords here", None), (None, TEXT, "a"), (8, LONG, "a"), (9, LONG + " end", "b"), (10, " ".join(f"z{i}" for i in range(12)), "c"),
]


@pytest.fixture(scope="module")
def rows(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.selectExpr("*", "1 as size", "'x' as sha", "2 as comp", "3 as kept", "4 as doc", "5 as n")


@pytest.mark.parametrize("name", list(sql.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), sql.ORACLE_SQL[name]) is None


def test_exact_duplicates_of_awkward_rows(rows):
    got = exact_dedup.exact_duplicates(rows).collect()
    assert len(got) == len(ROWS)
    copies = [r for r in got if r.text_sha256 == hashlib.sha256(TEXT.encode()).hexdigest()]
    assert {r.keep_id for r in copies} == {2} and {r.group_size for r in copies} == {4} and sum(r.kept for r in copies) == 2
    empty = {r.doc_id: r for r in got if r.doc_id in (4, 5)}
    assert (empty[4].keep_id, empty[5].kept) == (5, True)
    kept = exact_dedup.drop_exact_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 9, 10]
    assert exact_dedup.exact_duplicates(rows.limit(0)).count() == 0


def test_near_duplicates_of_awkward_rows(rows):
    got = ngram_join.near_duplicates(rows).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[2] == (56, 1) and by[3] == (57, 1) and by[9][1] == 8
    assert by[4] == (0, 4) and by[5] == (0, 5) and by[6] == (1, 6) and by[7] == (1, 6) and by[None] == (56, None)
    kept = ngram_join.one_per_group(rows)
    assert kept.columns == rows.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 8, 10]
    assert ngram_join.near_duplicates(rows.limit(0)).count() == 0


def test_repeated_words_of_awkward_rows(rows):
    got = substring_dedup.repeated_words(rows).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[1] == (60, 0, sha(TEXT)) and by[2] == (60, 60, sha("")) and by[3] == (61, 60, sha("more"))
    assert by[9] == (30_001, 30_000, sha("end")) and by[None][1] == 0 and by[4] == (0, 0, sha("")) and by[10][1] == 0
    assert substring_dedup.repeated_words(rows.limit(0)).count() == 0


def test_versions_of_one_id(spark):
    other = " ".join(f"o{i}" for i in range(40))
    df = spark.createDataFrame([(1, TEXT), (5, other), (5, TEXT + " x"), (7, other)], "doc_id long, text string")
    near = {(r.doc_id, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert near == {(1, 1), (5, 1), (7, 1)}
    cut = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.repeated_words(df).collect())
    assert cut == [(1, 60, 0), (5, 40, 0), (5, 61, 60), (7, 40, 40)]


def test_mixing_awkward_rows(rows):
    got = mixing.mixture(rows).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    mixed = mixing.mixed_documents(rows)
    assert mixed.columns == rows.columns
    taken = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("w")).collect()
    want = {}
    for r, s in zip(sorted(got, key=lambda r: (r.doc_id or 0, r["size"])), sorted(ROWS, key=lambda r: (r[0] or 0))):
        want[s[2]] = want.get(s[2], 0) + r.taken
    assert {r.source: r.w for r in taken} == {k: v for k, v in want.items() if v}
    assert mixing.mixture(rows.limit(0)).count() == 0


def test_small_sources_of_short_texts_reach_their_target(spark):
    """Shards of about one short document: the words below a block count, exactly once more where the source is not full."""
    docs = [(i, "w " * 10, "a") for i in range(800)] + [(1_000 + i, "w " * 5, "b") for i in range(500)]
    docs += [(2_000 + i, "w " * 200, "c") for i in range(1_000)]
    got = mixing.mixture(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    by = {s: [r for r in got if lo <= r.doc_id < hi] for s, lo, hi in (("a", 0, 1_000), ("b", 1_000, 2_000), ("c", 2_000, 9_000))}
    assert all(r.taken == 30 for r in by["a"]) and all(r.taken == 15 for r in by["b"])
    assert abs(sum(r.taken for r in by["c"]) - by["c"][0].target) <= 16
    # between its whole blocks and three times its size
    near = [(i, "w " * 10, "a") for i in range(400)] + [(1_000 + i, "w " * 10, "b") for i in range(350)]
    got = mixing.mixture(spark.createDataFrame(near, "doc_id long, text string, source string")).collect()
    for lo in (0, 1_000):
        own = [r for r in got if lo <= r.doc_id < lo + 1_000]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 16 and all(0 <= r.taken <= 30 for r in own)


def test_top_k_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]), (None, [1.0, 1.0]),
        (6, [0.0, 0.0]), (7, [1.0]), (8, []), (50, [3e30, -1.0]), (9, [1.0, 0.5]), (9, [1.0, 0.5]),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = exact_topk.top_k(df, F.col("vec_id") % 50 == 0, k=3).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [
        (1, 50, 2**63 - 1), (2, 1, 256 * 256 + 128 * 128), (3, 9, 256 * 256 + 128 * 128)
    ]
    assert exact_topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_vectors_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "ROW_BLOCK", 4)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(exact_topk, "PER_GROUP", 2)
    data = [(i, [float(i % 7), float(i % 3)]) for i in range(30)] + [(0, [0.0, 0.0]), (10, [3.0, 1.0]), (10, [9.0, 9.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, exact_topk.top_k(df, F.col("vec_id") % 10 == 0, k=3).collect()))
    want = []
    for a, (q, v) in enumerate(data):
        if q % 10 == 0:
            scores = [(-sum(int(256 * x) * int(256 * y) for x, y in zip(v, u)), i) for b, (i, u) in enumerate(data) if a != b]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:3], 1)]
    assert got == sorted(want)


def test_piece_digests_of_awkward_rows(rows):
    got = pieces.digests(rows, queries.vocabulary()).collect()
    assert len(got) == len(ROWS)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5)} == {2}


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as score")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    good = corpus_pipeline.classify(spark, docs, SF)
    assert good.columns == docs.columns
    once = corpus_pipeline.exact(spark, docs, SF)
    want = [r.doc_id for r in docs.groupBy("text").agg(F.max("doc_id").alias("doc_id")).collect()]
    assert ids(once) == sorted(want) and once.columns == docs.columns
    near = ngram_join.near_duplicates(docs)
    assert ids(corpus_pipeline.near(spark, docs, SF)) == ids(near.filter("doc_id = component_id"))
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns
    rows = mixed.withColumn("w", mixing.word_count(F.col("text"))).groupBy("doc_id").agg(F.sum("w").alias("taken"))
    taken = {r.doc_id: r.taken for r in mixing.mixture(docs).collect() if r.taken}
    assert {r.doc_id: r.taken for r in rows.collect()} == taken
    assert corpus_pipeline.encode(spark, docs, SF).count() == docs.count()
