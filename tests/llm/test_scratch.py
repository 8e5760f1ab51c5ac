"""What operators leave on disk, and that work done in parts gives the same rows."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tieout.llm import ngram_join, substring_dedup
from tieout.llm.common import Words, sequences
from tieout.session import SHUFFLE_CLEANUP, cut_lineage, reliable_dir


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def tables(spark):
    top = reliable_dir(spark).removeprefix("file:") + "/tieout"
    return {d for d in os.listdir(top) if d.startswith("cut-")} if os.path.isdir(top) else set()


@pytest.fixture(scope="module")
def docs(spark):
    """Texts from few words, so that 5-word runs meet by chance, with passages and noisy copies of earlier texts."""
    rng = random.Random(4)
    texts = [[f"w{rng.randrange(9)}" for _ in range(rng.randint(5, 90))] for _ in range(60)]
    for i in range(60):
        a, b = rng.choice(texts), rng.choice(texts)
        texts.append(a[:40] + b[10:30] if i % 2 else [*a[:-1], "end"])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()


def test_a_cut_deletes_the_shuffles_behind_it(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    out = cut_lineage(spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 700).alias("k")).count().repartition(3, "count"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert out.count() == 700 and spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_repeated_words_keep_only_the_tables_that_the_result_reads(spark, docs):
    before = tables(spark)
    out = substring_dedup.repeated_words(docs[1])
    read = {f.rsplit("/", 2)[1] for f in out.inputFiles()}
    top = reliable_dir(spark).removeprefix("file:") + "/tieout"
    # a table without rows may have no file by which it is found again
    left = {d for d in tables(spark) - before if any(f.startswith("part-") for f in os.listdir(f"{top}/{d}"))}
    assert left == read and len(read) <= 3
    assert out.count() == len(docs[0])


def test_repeated_words_equal_brute_force_in_any_number_of_parts(docs, monkeypatch):
    rows, df = docs
    first, want = {}, {}
    for i, text in rows:
        w = text.split()
        for at in range(len(w) - 12):
            first.setdefault(tuple(w[at : at + 13]), i)
    for i, text in rows:
        w = text.split()
        want[i] = len({x for at in range(len(w) - 12) if first[tuple(w[at : at + 13])] < i for x in range(at, at + 13)})
    assert sum(map(bool, want.values())) > 30
    for parts in (1, 2, 5):
        monkeypatch.setattr(substring_dedup, "PARTS", parts)
        assert {r.doc_id: r.n_removed for r in substring_dedup.repeated_words(df).collect()} == want


def test_only_windows_of_a_shared_anchor_move(spark):
    """A window that holds a shared anchor, but has a smaller one of its own, is in no shuffle."""
    text = " ".join(f"v{i}" for i in range(80))
    h, _ = Words(lower=False)(spark.createDataFrame([(text,)], "text string").toArrow().column("text").combine_chunks())
    best = substring_dedup.anchor_of_windows(sequences(h, substring_dedup.SEED))
    place = int(np.unique(best)[3])
    packed = substring_dedup.packed(spark.createDataFrame([(7, text)], "doc_id long, text string"))
    got = substring_dedup.extended(packed.withColumn("ats", F.array(F.lit(place), F.lit(5000))))
    assert sorted(r["at"] for r in got.collect()) == np.flatnonzero(best == place).tolist()


def test_near_duplicates_are_the_same_in_any_number_of_parts(docs, monkeypatch):
    def linked(a, b):
        return a and b and 100 * len(a & b) >= 75 * len(a | b)

    sets = {i: {tuple(t.split()[at : at + 5]) for at in range(len(t.split()) - 4)} for i, t in docs[0]}
    want = {i: i for i in sets}
    for _ in range(8):
        want = {i: min(want[j] for j in sets if j == i or linked(sets[i], sets[j])) for i in sets}
    assert sum(want[i] < i for i in want) > 20
    moved = []
    real = ngram_join.meeting
    monkeypatch.setattr(ngram_join, "meeting", lambda single: moved.append(single.count()) or real(single))
    for parts in (1, 3):
        monkeypatch.setattr(ngram_join, "PARTS", parts)
        moved.append(0)
        assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs[1]).collect()} == want
    # 0, all, 0, and three parts of about a third each
    assert sum(moved[3:]) == moved[1] and max(moved[3:]) < 0.5 * moved[1]


def test_what_is_left_of_a_set_follows_from_a_tokens_place(docs):
    """Single tokens are written as numbers only, in the order that tells what is left from there on."""
    counts = ngram_join.class_counts(cut_lineage(ngram_join.first_pass(docs[1])))
    signed = ngram_join.signatures(docs[1], counts)
    assert dict(signed.dtypes)["singles"] == "array<bigint>"
    words, signer = Words(lower=True), ngram_join.Signer(counts)
    texts = docs[1].select("text").toArrow().column("text").combine_chunks()
    want = set()
    for s in ngram_join.shingle_sets(texts, words):
        (sig, left), _ = signer(s)
        want |= {(x, n) for x, n in zip(sig.view(np.int64).tolist(), left.tolist())}
    got = signed.select(F.posexplode("singles").alias("place", "sig"), "n").select("sig", (F.col("n") - F.col("place")).alias("left"))
    assert {tuple(r) for r in got.collect()} == want
