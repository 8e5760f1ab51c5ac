"""Whole queries against plain code: quality, personal data, pages, token counts, near duplicates, pipeline."""

import hashlib
import math
import random
import re
import time

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tieout.llm import mixing, ngram_join, pages, personal_data, quality, queries, sql, token_counts
from tieout.llm.queries import vocabulary

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
TINY, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"Word{i % 700},{i % 13}" for i in range(20_000))


# -- op1 --


def plain_score(model, text: str) -> float:
    """Gated attention, passage by passage."""
    words = (text or "").split()
    bags = [quality.passage_features(text or "")]
    assert len(bags[0]) == max(1, -(-len(words) // 64))
    w, encoded, weights = model.weights, [], []
    for x in bags[0]:
        h = np.tanh(((x - model.centre) / model.scale) @ w["enc"] + w["enc_b"])
        gate = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate_b"])))
        encoded.append(h)
        weights.append(math.exp(float((np.tanh(h @ w["att"] + w["att_b"]) * gate) @ w["focus"])))
    z = sum(a * h for a, h in zip(weights, encoded)) / sum(weights)
    return 1 / (1 + math.exp(-float(z @ w["out"] + w["out_b"][0])))


def test_quality_equals_plain_attention(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.trained(docs, labels)
    rows = [(1, LONG), (2, LONG * 5), (3, None), (4, ""), (5, "one"), (5, "one"), (None, "two words")]
    rows += [(r.doc_id + 10, r.text) for r in docs.limit(40).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as body", "'x' as html", "2 as score")
    got = sorted(((r.doc_id, r.score) for r in quality.scored(df, model).collect()), key=str)
    want = sorted(((i, plain_score(model, t)) for i, t in rows), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-9 for g, w in zip(got, want))
    kept = quality.accepted(df, labels.limit(0), threshold=0.4)  # a clashing column of another type
    assert kept.columns == df.columns and kept.count() == len(rows)


def test_a_passage_means_the_same_in_texts_of_any_length():
    part = " ".join(f"w{i}" for i in range(64))
    short, long = quality.passage_features(part), quality.passage_features(" ".join([part] * 500))
    assert len(long) == 500 and np.allclose(long[250][:-1], short[0][:-1], atol=0.02)
    assert len(quality.training_bag(" ".join([part] * 500))) == quality.PASSAGES


# -- op2 --

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def keeps(kind: str, found: str) -> bool:
    digits = re.sub(r"\D", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_personal_data_as_a_query(spark):
    rng = random.Random(2)
    parts = ["a.b@c.example.org", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", "é", "😀",
             "x@y", "@", "word", "2024-01-01", "10.0.0.1.5", "0000000000000000", "+44 20 7946 0958.", "\n", "token = \"abcd1234abcd1234\""]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " "), (5, rows[5][1]), (None, "1.2.3.4"), (403, ("filler " * 40 + "a@b.cd ") * 2_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "'x' as body")
    got = personal_data.personal_data(df, personal_data.labelled_table(spark)).collect()
    assert len(got) == len(rows)

    def digest(text):
        spans = {k: [m.span() for m in p.finditer(text or "") if keeps(k, m[0])] for k, p in BASE.items()}
        joined = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])
        return (*[len(spans[k]) for k in BASE], hashlib.sha256(joined.encode()).hexdigest()), joined

    want = sorted(((i, *digest(t)[0]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == want
    base = {i: digest(t)[1] for i, t in rows}
    for r in got:  # base spans come first and as they are; what the field adds touches none of them
        assert r.spans.startswith(base[r.doc_id])
        assert len(r.spans.split(",")) - (not r.spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_secret + r.n_local_phone
    assert sum(r.n_secret for r in got) > 0
    assert personal_data.personal_data(df.limit(0), personal_data.labelled_table(spark)).count() == 0


def test_planted_secrets_are_found(spark):
    rng = random.Random(11)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made = [f"password={hexa(16)}", f'api_key = "{hexa(32)}"', f"token: {hexa(24)}", "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOP234567") for _ in range(16))]
    docs = [(i, f"some text before {made[i % 4]} and some text after") for i in range(200)]
    clean = [(1000 + i, f"the meeting of {1900 + i % 120} had {i} guests, version {i % 9}.{i % 7}") for i in range(200)]
    df = spark.createDataFrame(docs + clean, "doc_id long, text string")
    got = {r.doc_id: r.n_secret for r in personal_data.personal_data(df, personal_data.labelled_table(spark)).collect()}
    assert sum(got[i] > 0 for i, _ in docs) >= 190 and sum(got[i] > 0 for i, _ in clean) <= 4


# -- op4 --


def words(n: int, tag: str) -> str:
    return " ".join(f"{tag}{i}" for i in range(n))


def test_a_larger_layout_is_not_exchanged_for_the_winning_path():
    teaser, story = words(130, "t"), words(300, "s")
    beside = pages.parse(f"<body><div class=teaser><p>{teaser}</p></div><div class=story><p>{story}</p></div></body>")
    inside = pages.parse(f"<body><div class=teaser><p>{teaser}</p></div><p>{story}</p></body>")
    for page in (beside, inside):
        assert pages.extract(page, "body>div.teaser") == f"{teaser} {story}"
    # what weighs less than the winner is not added, and where the winner holds nothing the page's own best does
    page = pages.parse(f"<body><div class=teaser><p>{teaser}</p></div><div class=odd><p>{words(100, 'o')}</p></div></body>")
    assert pages.extract(page, "body>div.teaser") == teaser
    assert pages.extract(beside, "body>div.other") == f"{teaser} {story}"  # the body holds most


def test_pages_with_known_articles(spark):
    """Random layouts whose article is known; every host has one layout."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(120):
        h = i % 6
        paras = [words(rng.randint(20, 60), f"a{i}p{j}w") for j in range(rng.randint(2, 6))]
        wrap = ("<article class='post p-{}'>{}</article>", "<div class='content'>{1}</div>", "<main id=m{}>{}</main>", "<div><div class='entry e{}'>{}</div></div>",
                "<section class=story>{1}</section>", "<table><tr><td class=main>{1}</td></tr></table>")[h]
        body = wrap.format(i, "".join(f"<p>{p}</p>" for p in paras))
        menu = "<nav><ul>" + "".join(f"<li><a href=/{k}>Menu {k}</a></li>" for k in range(8)) + "</ul></nav>"
        side = f"<aside><p>{words(30, 'side')}</p></aside><div class=sidebar><p>{words(15, 'bar')}</p></div>"
        foot = "<footer><p>All rights reserved &copy; 2024</p></footer><script>var x = '<p>no</p>';</script>"
        rows.append((i, f"http://h{h}.example/{i}", f"<html><head><title>T</title></head><body><header>Site</header>{menu}{body}{side}{foot}</body></html>"))
        want[i] = " ".join(paras)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in pages.main_texts(df).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


@pytest.mark.parametrize("piece", ["<div><p>x", "<b>", "<div class=ad><span>x", "<p><ul><b><hr>", "</i>", "<table><tr><td>x"])
def test_deep_pages_take_time_in_proportion(piece):
    pages.parse(piece * 1_000)
    start = time.process_time()
    page = pages.parse(piece * (100_000 // max(1, piece.count("<"))))
    pages.votes(page), pages.extract(page, "body>div")
    assert time.process_time() - start < 6


# -- op8 --


def test_token_counts_as_a_query(spark):
    pieces = vocabulary()
    scores = [(t, s if k == "normal" else -1e9) for t, s, k in zip(pieces.text, pieces.score, pieces.kind)]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(scores, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="never", split=False)
    texts = [None, "", " ", "a", "a", "   indented  text", " " * 40 + "x" + " " * 16, "漢字 😀  é", "the  end\n\n  of\tit", LONG[:40_000]]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "no id"), (3, "a")], "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.token_counts(df, pieces).collect()), key=str)
    count = lambda t: len(library.encode("▁" + t, add_special_tokens=False).ids) if t else 0
    want = [(i, count(t)) for i, t in enumerate(texts)] + [(None, count("no id")), (3, count("a"))]
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(df.limit(0), pieces).count() == 0
    counter = token_counts.Counter(pieces)
    assert counter(" " * 15) == 1  # one piece of sixteen marks


# -- op3 --


def brute_components(rows) -> dict:
    sets = {}
    for i, t in rows:
        ws = (t or "").encode().lower().split()
        sets[i] = {tuple(ws[j : j + 5]) for j in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_a_signature_shared_by_a_third_of_all_rows(spark, monkeypatch):
    """Noisy copies around one text: components as by brute force, and far fewer pairs than there are."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for i in range(150):  # each copy changes up to ten places: some pairs are linked, some are not
        copy = list(base)
        for at in rng.sample(range(160), rng.randint(0, 10)):
            copy[at] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    for i in range(150, 450):
        rows.append((i, " ".join(f"w{rng.randrange(5_000)}" for _ in range(60))))
    verified = []
    real = ngram_join.tested
    monkeypatch.setattr(ngram_join, "tested", lambda pairs, docs, marks: verified.append(pairs.count()) or real(pairs, docs, marks))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute_components(rows)
    assert sum(verified) < 150 * 149 / 2 / 2


# -- pipeline --


def test_stages_equal_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300").selectExpr("*", "1 as score", "'x' as body", "2 as key")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = sorted(r.doc_id for r in corpus_pipeline.classify(spark, docs, SF).collect())
    model = quality.trained(docs, labels)
    assert kept == sorted(i for i, t in text.items() if plain_score(model, t) >= quality.THRESHOLD) and 0 < len(kept) < 300
    newest = {t: i for i, t in sorted(text.items())}
    assert sorted(r.doc_id for r in corpus_pipeline.exact(spark, docs, SF).collect()) == sorted(newest.values())
    alone = {i for i, (_, c) in brute_components(list(text.items())).items() if c == i}
    near = corpus_pipeline.near(spark, docs, SF)
    assert {r.doc_id for r in near.collect()} == alone and len(alone) < 300 and near.columns == docs.columns
    mixed = corpus_pipeline.mix(spark, docs, SF).collect()
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "source", "text").toArrow())
    taken = {r[0]: r[-1] for r in con.execute(f"SELECT doc_id, taken FROM ({sql.MIXING})").fetchall()}
    count = dict.fromkeys(text, 0)
    for r in mixed:
        ws, own = r.text.encode().split(), (text[r.doc_id] or "").encode().split()
        count[r.doc_id] += len(ws)
        # a row taken in part: a stretch of the text, or its head and its tail
        part = any(own[j : j + len(ws)] == ws for j in range(len(own) - len(ws) + 1))
        part = part or any(ws[:k] == own[:k] and ws[k:] == own[len(own) - len(ws) + k :] for k in range(len(ws) + 1))
        assert r.text == text[r.doc_id] or part
    assert count == taken
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    coded = corpus_pipeline.encode(spark, docs, SF).collect()
    assert len(coded) == 300
    for r in coded:
        ids = library.encode(text[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_a_run_writes_each_stage_once(spark, monkeypatch):
    calls, stages = [], []
    for name, stage in corpus_pipeline.STAGES:
        def counted(s, docs, folder, name=name, stage=stage):
            calls.append((name, "MapInArrow" in docs._jdf.queryExecution().executedPlan().toString()))
            return stage(s, docs, folder)

        stages.append((name, counted))
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = corpus_pipeline.run(spark, TINY)
    assert out.count() > 0
    # what a stage gets is a written table: nothing of the stages before runs again
    assert calls == [(name, False) for name, _ in corpus_pipeline.STAGES]


def test_sources_that_need_what_is_below_a_block(spark):
    """Operator and SQL on sources of short texts, and on rows without an id, source or text."""
    docs = [(i, "w " * 10, "a") for i in range(400)] + [(1_000 + i, "w " * 5, "b") for i in range(300)]
    docs += [(2_000 + i, "w " * 200, "c") for i in range(200)] + [(None, "w w w", None), (9_000, None, "a"), (9_001, "", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({sql.MIXING})").fetchall(), key=str)
    got = sorted((tuple(r) for r in mixing.mixture(df).select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)
    assert got == want


def test_exact_duplicates_without_ids(spark):
    from tests.oracle_compare import compare
    from tieout.llm import exact_dedup

    df = spark.createDataFrame([(None, "t"), (None, "u"), (3, "u"), (4, None), (None, ""), (4, "v"), (4, "v")], "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert compare(exact_dedup.exact_duplicates(df), con, sql.EXACT_DEDUP) is None


def test_queries_of_this_subpackage_are_all_registered():
    names = {re.match(r"op(\d+)_", name)[1] for name in queries.QUERIES}
    assert names == {str(i) for i in range(1, 14)}
    assert set(sql.ORACLE_SQL) <= set(queries.QUERIES)
