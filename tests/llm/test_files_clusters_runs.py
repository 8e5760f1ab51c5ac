"""Token files, clusters and periodic runs against libraries and brute force, and on awkward rows."""

import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tieout.llm import periodic_runs, queries, rans, token_files, walsh_clusters
from tieout.session import scratch_path

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.01"
BYTES = "byte_bpe_50k.json"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [
    (3, "one two three", "a"), (1, None, "b"), (2, "", None), (2, "again and again", "a"), (2, "again and again", "a"), (None, "no id", "c"),
    (9, LONG, "a"), (8, " \t\n ", "a"), (-4, "a<|endoftext|> b\x1c\x85　漢字😀", "a"), (10, "x y " * 30, "a"),
]


@pytest.fixture(scope="module")
def rows(spark):
    """Nulls, empty, blank and long texts, repeated rows, and columns whose names the operators use."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.selectExpr("*", "'x' as ids", "1 as file", "2 as body", "3 as runs", "4 as n_tokens", "5 as width", "6 as place")


def test_rans_gives_back_every_block():
    rng = np.random.default_rng(5)
    tokens = (rng.pareto(0.8, 300_000) * 20).astype(np.int64).clip(0, 60_000)
    table = rans.Table.of_counts(np.bincount(tokens))
    assert table.freq.sum() == 2**table.bits and ((table.freq > 0) == (np.bincount(tokens) > 0)).all()
    cuts = [1, 2, rans.LANES, rans.LANES + 1, rans.STRIDE * rans.LANES, rans.STRIDE * rans.LANES + 1, rans.BLOCK]
    blocks = [tokens[:n] for n in cuts] + [np.full(5_000, tokens[0])]
    coded = rans.encode(table, blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, rans.decode(table, coded)))
    alone = rans.decode(table, coded[3:4])[0]
    assert np.array_equal(alone, blocks[3])
    coded[6].words[77] ^= 1
    with pytest.raises(ValueError, match="checkpoints"):
        rans.decode(table, coded)


def test_one_token_and_no_token_make_a_table():
    table = rans.Table.of_counts(np.array([0, 0, 7]))
    assert np.array_equal(rans.decode(table, rans.encode(table, [np.full(1_000, 2)]))[0], np.full(1_000, 2))
    assert rans.Table.of_counts(np.zeros(0)).freq.sum() == 0


def test_words_encode_as_whole_texts_do():
    words = token_files.Words(P.path(BYTES), remembered=200)  # forgets and learns again
    assert words.cuts
    rng = random.Random(4)
    chars = "abcde  \n\t\r\x0b\x1c\x85\xa0  　​'sé漢😀.!12٣ªﬁ᠎﻿" + "<|endoftext|>"
    texts = ["", " ", "<|endoftext|>", "it's we'll  x\n\n  y"] + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 50))) for _ in range(3_000)]
    got = []
    for i in range(0, len(texts), 50):
        ids, bounds = words.encode(pa.array([*texts[i : i + 50], None]))
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-2].tolist(), bounds[1:].tolist())]
        assert bounds[-1] == bounds[-2] == len(ids)
    assert got == [words.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_encode_whole_texts():
    words = token_files.Words(P.path("word_bpe_49k.json"))
    assert not words.cuts
    ids, bounds = words.encode(pa.array(["Some  words\nhere", "", None]))
    assert ids.tolist() == words.library.encode("Some  words\nhere", add_special_tokens=False).ids
    assert bounds.tolist() == [0, len(ids), len(ids), len(ids)]


def expected(docs) -> list[tuple]:
    library = tokenizers.Tokenizer.from_file(P.path(BYTES))
    coded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in docs]
    coded = [(i, ids, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in coded]
    out, start = [], 0
    for i, ids, crc in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), r[2])):
        out.append((i, start, len(ids), crc))
        start += len(ids)
    return out


def from_files(spark, docs, **options) -> tuple[list[tuple], str]:
    folder = scratch_path(spark, "test-tokens")
    token_files.write_token_files(docs, folder, P.path(BYTES), **options)
    rows = token_files.read_token_files(spark, folder).select("file", "doc_id", "place", "n_tokens", F.crc32("ids").alias("crc"))
    got = token_files.with_starts(rows).select("doc_id", "start", "n_tokens", "crc").collect()
    return sorted(map(tuple, got), key=lambda r: r[1]), folder


def test_token_files_of_awkward_rows(spark, rows):
    want = expected([(r[0], r[1]) for r in ROWS])
    assert from_files(spark, rows)[0] == want
    got, folder = from_files(spark, rows.repartition(3), file_tokens=50)  # several files, documents over several blocks
    assert got == want and len(glob.glob(f"{folder}/tokens/part-*")) > 2
    assert from_files(spark, rows.limit(0))[0] == []


def test_token_files_of_the_supplied_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_token_rans(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected(docs)


def test_a_damaged_file_is_refused():
    table = rans.Table.of_counts(np.array([3, 2, 1]))
    tokens = np.array([0, 1, 0, 2, 0, 1])
    block = rans.encode(table, [tokens])[0]
    body = token_files.pack_block(block, tokens, [(7, 4), (None, 2)])[4:]
    head = token_files.HEAD.pack(token_files.MAGIC, 11, 0)
    content = b"".join(token_files.framed(b) + b"\n" for b in (head, body))
    read = [(i, at, x.tolist()) for _, i, at, x in token_files.documents_of(memoryview(content), table, 11)]
    assert read == [(7, 0, [0, 1, 0, 2]), (None, 4, [0, 1])]
    with pytest.raises(ValueError, match="table"):
        list(token_files.documents_of(memoryview(content), table, 12))
    wrong = token_files.pack_block(block, np.array([0, 1, 0, 2, 0, 0]), [(7, 6)])[4:]
    with pytest.raises(ValueError, match="checksum"):
        list(token_files.documents_of(memoryview(b"".join(token_files.framed(b) + b"\n" for b in (head, wrong))), table, 11))


def brute_clusters(vectors, k: int, rounds: int):
    rows = [(i, [int(x) * 256 if abs(x) >= 2**53 else int(np.floor(x * 256)) for x in v]) for i, v in vectors]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~"
    c = [v for _, v in sorted(rows, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda: [min(range(len(c)), key=lambda j: (far(v, c[j]), j)) for _, v in rows]
    for _ in range(rounds):
        own = pick()
        for j in range(len(c)):
            mine = [rows[i][1] for i in range(len(rows)) if own[i] == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = pick()
    return sorted(((i, j, min(far(v, c[j]), 2**63 - 1)) for (i, v), j in zip(rows, own)), key=str), c


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    nan, inf = float("nan"), float("inf")
    data = [(i, (rng.normal(size=64) * 0.2 + i % 3).round(2).tolist()) for i in range(60)]
    data += [(5, data[5][1]), (5, data[6][1]), (None, data[7][1]), (71, [0.0] * 64), (72, [0.0] * 64)]  # repeated rows, null id, ties
    bad = [(80, None), (81, [1.0] * 63), (82, [1.0] * 63 + [nan]), (83, [inf] * 64), (84, [None] * 64), (85, []), (86, [1.0] * 65)]
    for k, huge in ((12, []), (4, [(90, [3e38] + [0.5] * 63), (91, [-1e20] * 64)]), (100, [])):
        df = spark.createDataFrame(data + bad + huge, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as t")
        want, centroids = brute_clusters(data + huge, k, 3)
        got, found = walsh_clusters.clusters(df.repartition(3), k=k, rounds=3)
        assert sorted(map(tuple, got.collect()), key=str) == want and found == centroids
        facts = walsh_clusters.clustered(df, k=k, rounds=3).collect()
        assert len(facts) == len(want)
        for r in facts:
            assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
            assert r.cluster_inertia == min(sum(d for _, j, d in want if j == r.cluster), 2**63 - 1)
            assert r.inertia == min(sum(d for _, _, d in want), 2**63 - 1)
    assert walsh_clusters.clustered(df.limit(0)).count() == 0


def test_the_search_drops_only_worse_centroids():
    rng = np.random.default_rng(9)
    v, c = rng.integers(-300, 300, (500, 64)), rng.integers(-300, 300, (30, 64))
    c[20], v[:50] = c[4], c[4] + rng.integers(-1, 2, (50, 64))  # equal centroids: the smaller number
    number, distance = walsh_clusters.nearest(walsh_clusters.transform(v), walsh_clusters.transform(c))
    plain = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert np.array_equal(number, plain.argmin(axis=1)) and np.array_equal(distance, plain.min(axis=1)) and (number[:50] == 4).all()
    assert np.array_equal(walsh_clusters.untransform(walsh_clusters.transform(v)), v)


def brute_runs(word, folds: int, least: int) -> list[tuple[int, int, int]]:
    out: dict[tuple[int, int], int] = {}
    for p in range(1, len(word) // folds + 1):
        i = 0
        while i + p < len(word):
            j = i
            while j + p < len(word) and word[j] == word[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, folds * p):
                out.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in out.items())


def test_runs_equal_brute_force():
    rng = random.Random(6)
    for _ in range(1_500):
        n, k = rng.randint(0, 50), rng.choice([1, 2, 2, 3, 4])
        word = [rng.randrange(k) for _ in range(n)]
        if n > 10 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            word = [word[i] if i < a else word[a + (i - a) % p] for i in range(n)]
        for folds, least in ((4, 6), (2, 2), (3, 5)):
            assert periodic_runs.runs_of(word, folds, least) == brute_runs(word, folds, least)


def test_stretches_lose_no_run(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) + " x y z" * rng.randint(0, 6) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for folds, least in ((4, 6), (2, 4)):
        got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.periodic_runs(df, folds, least).collect()}
        assert got == {i: brute_runs(t.split(), folds, least) for i, t in enumerate(texts)}


def digest_of(doc_id, text) -> tuple:
    """The contract, word by word."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 4, 6)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_runs_of_awkward_rows(spark, rows):
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(rows, rewrite=periodic_runs.planted_tail)).collect()
    want = [digest_of(i, t) for i, t, _ in ROWS if i != 9]
    assert sorted((tuple(r) for r in got if r.doc_id != 9), key=str) == sorted(want, key=str)
    long = next(r for r in got if r.doc_id == 9)
    assert (long.start, long.length, long.period, long.exponent_milli) == (0, 60_000, 977, 61_412)
    assert periodic_runs.periodic_runs(rows.limit(0)).count() == 0
    # ties: the greatest length by period, then the smallest start
    tied = spark.createDataFrame([(1, "a a a a a a b c d c d c d c d c d c d")], "doc_id long, text string")
    first = periodic_runs.run_digests(periodic_runs.periodic_runs(tied)).first()
    assert (first.n_runs, first.start, first.length, first.period) == (2, 0, 6, 1)


def test_runs_of_the_supplied_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(digest_of(i, t) for i, t in docs)
    assert sum(r[1] > 0 for r in got) > 5
