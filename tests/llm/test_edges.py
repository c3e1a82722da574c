"""Odd tables through every operator and stage: nulls, repeats, ties, very long texts, clashing and dotted columns, no rows at all."""

import random

import pytest
from pyspark.sql import functions as F
from voxelloom.llm import bpe, chat, components, embeddings, oph, packing, quality, queries, shingles, simhash, suffixes, toxicity, warc

WORD, BYTE = queries.tokenizer("word_bpe_49k.json"), queries.tokenizer("byte_bpe_50k.json")
random.seed(1)
LONG = " ".join(random.choices(["alpha", "beta", "gamma,", "délta", "x1!"], k=300_000))
TEXT = " ".join(f"w{k % 37}{k % 11}" for k in range(70))
ROWS = [(1, TEXT, "a", 1), (1, TEXT, "a", 1), (2, TEXT + " more", "b", 2), (None, None, None, None), (None, None, None, None), (None, TEXT, "c", 3), (3, "", "d", 4), (4, LONG, "e", 5), (5, " \t\n", "f", 6), (6, "LONGER " + TEXT, None, None)]
SCHEMA = "doc_id long, text string, `a.b` string, key long"
EXTRA = ["node", "row_no", "bucket", "kind", "data", "part", "hash", "fp", "n", "y", "label", "score", "component", "bands", "sketch"]


def table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in EXTRA:
        df = df.withColumn(name, F.lit(1))
    return df.repartition(3)


def marks(spark):
    rows = [(i, i % 2, i % 2) for i in range(7)] + [(None, 1, 1), (3, None, None), (2, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))


@pytest.mark.parametrize("name", ["bpe", "packing", "simhash", "oph", "suffixes", "quality", "toxicity"])
def test_documents_of_every_kind(spark, name):
    df = table(spark)
    run = {
        "bpe": lambda d: bpe.digests(d, BYTE), "packing": lambda d: packing.pieces(d, WORD), "simhash": simhash.near_duplicates, "oph": oph.with_next,
        "suffixes": suffixes.digests, "quality": lambda d: quality.scores(d, marks(spark)), "toxicity": lambda d: toxicity.scores(d, marks(spark)),
    }[name]
    got = run(df).collect()
    ids = sorted(str(r.doc_id) for r in got)
    if name == "packing":
        assert sorted(str(r.doc_id) for r in got if r.start == 0) == sorted(str(r[0]) for r in ROWS)
        assert {r.doc_tokens for r in got if r.doc_id == 3} == {1} and sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    else:
        assert ids == sorted(str(r[0]) for r in ROWS)
        assert len({tuple(r) for r in got if r.doc_id == 1}) == 1 or name == "oph"
    if name == "oph":
        assert len({r.fingerprint for r in got if r.doc_id in (1,)}) == 1 and {r.fingerprint for r in got if r.doc_id in (3, 5)} == {""}
    assert run(df.limit(0)).count() == 0


def test_stages_of_every_kind(spark):
    import corpus_pipeline

    df, seen = table(spark).cache(), {}
    for name, stage in corpus_pipeline.STAGES:
        folder = None
        if name in ("quality", "toxicity"):
            operator = {"quality": quality, "toxicity": toxicity}[name]
            out, none = operator.accepted(df, marks(spark)), operator.accepted(df.limit(0), marks(spark))
        else:
            out, none = stage(spark, df, folder), stage(spark, df.limit(0), folder)
        seen[name] = out.collect()
        assert none.count() == 0
        if name != "packing":
            assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in seen["near copies"]) == ["1", "3", "4"]
    assert len(seen["repeated strings"]) == len(ROWS) and {r.n for r in seen["repeated strings"]} == {1}
    # a null id is the smallest, so its text stays and the others lose what they share with it
    assert [len(r.text) for r in seen["repeated strings"] if r.doc_id is None and r.text] == [len(TEXT)] and {r.text for r in seen["repeated strings"] if r.doc_id == 1} == {""}
    assert {r["a.b"] for r in seen["repeated strings"]} == {r[2] for r in ROWS}


def test_no_labels_at_all(spark):
    df, none = table(spark), marks(spark).limit(0)
    assert {r.score for r in quality.scores(df, none).collect()} == {1.0} and quality.accepted(df, none).count() == len(ROWS)
    assert max(r.score for r in toxicity.scores(df, none).collect()) < 1e-9 and toxicity.accepted(df, none).count() == len(ROWS)


def test_shingles_of_every_kind(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [(r.doc_id, r.text, r.component) for r in shingles.near_duplicates(df).collect()]
    of = {}
    for _, t, c in got:
        of.setdefault("blank" if not (t or "").strip() else t[-20:], set()).add(c)
    assert len(got) == len(ROWS) and all(len(v) == 1 for v in of.values()) and len({c for *_, c in got}) == 3


def test_a_large_band_is_dealt_in_blocks(spark, monkeypatch):
    random.seed(8)
    base = [f"b{k}" for k in range(60)]
    texts = []
    for i in range(120):
        words = list(base)
        for _ in range(random.randrange(0, 4)):
            words[random.randrange(60)] = f"q{i}{random.randrange(1000)}"
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(56)} for _, t in texts]
    near = [(a, b) for a in range(120) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    label = components.local_labels(*map(__import__("numpy").array, zip(*near, strict=True)), 120)
    for block in (2048, 7):
        monkeypatch.setattr(shingles, "BLOCK", block)
        got = {r.doc_id: r.component for r in shingles.near_duplicates(df).collect()}
        assert all((got[a] == got[b]) == (label[a] == label[b]) for a in range(120) for b in range(a))


def test_pages_conversations_and_vectors_of_every_kind(spark):
    pages = spark.createDataFrame([(1, "u", TEXT), (1, "u", TEXT), (2, None, TEXT), (None, "v", None), (3, "w", LONG), (4, "", "")], "page_id long, url string, html string")
    for name in ("sha1", "head", "record", "payload", "file", "block", "a.b"):
        pages = pages.withColumn(name, F.lit("WARC/1.1\r\n"))
    got = sorted((str(r.page_id), r.record_type, r.payload_bytes, r.refers_to) for r in warc.round_trip(pages).collect())
    n, m = len(TEXT.encode()), len(LONG.encode())
    assert got == sorted([("1", "revisit", n, 2), ("1", "revisit", n, 2), ("2", "response", n, None), ("None", "revisit", 0, 4), ("3", "response", m, None), ("4", "response", 0, None)])
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (None, 1, None, "x"), (2, 5, "assistant", LONG)], "conv_id long, turn long, role string, text string")
    for name in ("t", "ts", "head", "body", "start", "mask", "formatted", "a.b"):
        turns = turns.withColumn(name, F.lit(2))
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(turns).collect()}
    assert got == {1: (3, 0), None: (1, 0), 2: (1, len(LONG))} and chat.digests(turns.limit(0)).count() == 0
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, [1.0, 0.02, 0.0]), (9, [0.0, 1.0])], "vec_id long, embedding array<double>")
    for name in ("v", "id", "copies", "list", "n", "a.b"):
        vectors = vectors.withColumn(name, F.lit(3))
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(vectors).collect()}
    assert {g[0] for g in got} == {1, 2, 3, 4, 5, 6, 7, 8, 9, None}
    assert all(g[1:] == (0, g[0], True) for g in got if g[0] in (3, 4, 5, 6, 9)) and {g[2] for g in got if g[0] in (1, 2)} == {1}
    assert {(g[0], g[1], g[2]) for g in got if g[0] in (7, 8)} == {(7, 1, 7), (8, 1, 7)}
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0
