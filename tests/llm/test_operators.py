"""The training-data operators against brute force, on small tables with every odd row."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from voxelloom.llm import bpe, chat, components, embeddings, oph, packing, quality, queries, shingles, simhash, suffixes, toxicity, warc

random.seed(7)
WORDS = ["alpha", "béta", "gamma", "délta", "x", "the", "of", "and", "zeta!", "eta,"]
PASSAGE = " ".join(random.choices(WORDS, k=60))
TEXTS = [None, "", "   ", "one", PASSAGE, PASSAGE, "PREFIX " + PASSAGE + " end", "z" * 300, "it's <|endoftext|> 12\n\n x  y"] + [" ".join(random.choices(WORDS, k=random.randrange(1, 150))) for _ in range(25)]
DOCS = [(i * 3, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)] + [(None, "null id " + PASSAGE, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, key string, bucket long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3).cache()


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in bpe.digests(docs, path).collect()}
    for i, text, *_ in DOCS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
    assert bpe.encode(docs, path).filter("doc_id = 9").first().decoded == "one"
    assert bpe.digests(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("split", ["128m", "300"])
def test_warc(spark, split):
    evil = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc WARC/1.1\r\n\r\nContent-Length: 9999999\r\n\r\n t WARC/1.1\r\n"
    rows = [(1, "u", evil), (2, None, evil), (3, "a\r\nb", None), (4, "v", ""), (5, "w", "é" * 400), (6, "w", "WARC/1.1\r\nContent-Length: 80\r\n\r\n" + evil * 9), (None, "n", "null id")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        head = max(k for k, _, h in rows if k is not None and (h or "") == (html or "")) if i is not None else None
        assert got[i].payload_bytes == len(data) and got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if head == i else ("revisit", head))


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    import xxhash

    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum((2 * sum(h >> k & 1 for h in hs) > len(hs)) << k for k in range(64)) if hs else 0


def roots(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_simhash(spark, docs):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    known = [(i, fingerprint(t)) for i, t, *_ in DOCS if i is not None]
    label = roots(len(known), [(a, b) for a in range(len(known)) for b in range(a) if (known[a][1] ^ known[b][1]).bit_count() <= 3])
    for k, (i, f) in enumerate(known):
        assert got[i].fingerprint == f"{f:016x}" and got[i].component_id == known[label[k]][0]
    assert len(got) == len(DOCS) and simhash.near_duplicates(docs.limit(0)).count() == 0


def test_anchors_cover_every_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)
    fps = np.concatenate((x, y))
    key, row, home = simhash.anchors(fps)
    at = [set() for _ in fps]
    homes = [set() for _ in fps]
    for k, r, h in zip(key.tolist(), row.tolist(), home.tolist(), strict=True):
        at[r].add(k)
        homes[r] |= {k} if h else set()
    assert all(homes[i] & at[i + 400] for i in range(400))


def test_crowded_anchors_lose_no_link(spark):
    rng = np.random.default_rng(4)
    fps = np.concatenate((np.array([0, 5 << 40, 1 << 63], dtype=np.uint64), rng.integers(0, 1 << 6, 40, dtype=np.uint64) << np.uint64(33), rng.integers(0, 1 << 63, 40, dtype=np.uint64)))
    for _ in range(3):
        fps = np.concatenate((fps, fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64))))
    x = sorted(set(fps.view(np.int64).tolist()))
    want = roots(len(x), [(a, b) for a in range(len(x)) for b in range(a) if ((x[a] ^ x[b]) & (1 << 64) - 1).bit_count() <= 3])
    df = spark.createDataFrame([(f,) for f in x], "fp long")
    for crowd in (0, 3, simhash.CROWD):
        got = {r.node: r.component for r in components.connected(simhash.links(df, crowd=crowd)).collect()}
        assert [got.get(f, f) for f in x] == [x[k] for k in want]


def test_components(spark):
    links = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame([*links, (5, None)], "a long, b long")).collect()}
    label = roots(200, links)
    assert all(got.get(i, i) == label[i] for i in range(200))


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 10))
    rows = [(i, (base[i % 60] + rng.normal(size=10) * 0.15).tolist()) for i in range(240)] + [(300 + i, base[0].tolist()) for i in range(30)]
    odd = [(400, None), (401, [0.0] * 10), (402, [float("nan")] * 10), (403, [1.0, None] * 5), (404, []), (None, base[0].tolist()), (405, [float("inf")] * 10)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.9), strict=True) if a != b]
    found = sum(got[i].n_links for i, _ in rows)
    assert 0.9 * len(pairs) <= found <= len(pairs)
    label = roots(len(rows), pairs)
    assert np.mean([got[i].component_id == rows[label[k]][0] for k, (i, _) in enumerate(rows)]) > 0.95
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i, _ in odd) and len(got) == len(rows) + len(odd)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_chat(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "a\\b"), (1, 1, "assistant", "</turn>\n### x"), (1, 2, "assistant", None), (1, 2, "assistant", None), (2, 5, None, "ü"), (2, 6, "as:\nx", said), (3, 1, "assistant", ""), (3, 2, "assistant", said + "\n")]
    df = chat.with_adversary(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    for c in got:
        turns = [(r or "", t or "") for i, _, r, t in rows if i == c]
        lost = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(lost), sha(lost))
    assert len(got) == 4


def test_chat_plan_has_no_python(spark):
    df = chat.digests(spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_fingerprints(spark, docs):
    unique = docs.filter("doc_id is not null")
    got = {r.doc_id: r for r in oph.with_next(unique).collect()}
    rows = [(i, t or "") for i, t, *_ in DOCS if i is not None]

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == sha(new)
        for other, near in ((new, got[i].near_edited), (after, got[i].near_next)):
            a, b = shingles(t), shingles(other)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.15
    assert got[12].fingerprint == got[15].fingerprint
    assert oph.with_next(docs).count() == len(DOCS) and oph.with_next(docs.limit(0)).count() == 0


def test_suffixes(spark, docs):
    rows = DOCS + [(0, "same id, other text " + PASSAGE, "a", "b", 1), (6, "   ", "a", "b", 1)]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digests(spark.createDataFrame(DOCS, SCHEMA).repartition(3)).collect()]
    seen, want = set(), []
    for i, t, *_ in sorted(DOCS, key=lambda r: (-1 if r[0] is None else r[0])):
        t = (t or "").encode()
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - 99):
            if t[k : k + 100] in seen:
                gone[k + 1 : k + 101] = True
            seen.add(t[k : k + 100])
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        want.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), sha(kept)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffixes.digests(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
    some = sorted((r.doc_id or -1, sha(bytes(r.kept))) for r in suffixes.removals(docs, bucket_bytes=500).collect())  # more buckets than partitions
    assert suffixes.bucket_count(docs, 500) > 8 and some == sorted((w[0] or -1, w[4]) for w in want)
    assert suffixes.deduplicated(docs).columns == docs.columns and suffixes.digests(docs.limit(0)).count() == 0


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [2] for i, x, *_ in DOCS}
    whole = sorted(packing.pack(docs, path, window=64).collect(), key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in whole:
        assert r.sequence_id * 64 + r.offset == at and r.doc_tokens == len(want[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id][r.start : r.start + r.length]
        at += r.length
    assert at == sum(map(len, want.values()))
    p = packing.pieces(docs, path).first()
    assert p.ids_crc32 == zlib.crc32(np.array(want[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
    assert packing.pack(docs.limit(0), path).count() == 0


def test_segments_equal_brute_force():
    def maximal(w, lo, hi):
        best = max(((sum(w[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
        if best[0] <= 0:
            return []
        a, b = best[3:]
        return maximal(w, lo, a) + [(a, b, best[0])] + maximal(w, b, hi)

    for seed in range(40):
        w = np.random.default_rng(seed).integers(-8, 9, 14) + 0.001 * np.random.default_rng(seed + 99).random(14)
        got = toxicity.segments(w)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in maximal(w.tolist(), 0, len(w))]


def labelled(spark, n=1200):
    rows, labels = [], []
    for i in range(n):
        words = random.choices(WORDS, k=40)
        bad, junk = i % 5 == 0, i % 7 == 0
        words = words + random.sample(["vileish", "vileous", "vilenik"], 2) if bad else words
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words)))
        labels.append((i, int(not junk), int(bad)))
    return spark.createDataFrame([*rows, (n, None), (None, "")], "doc_id long, text string"), spark.createDataFrame([*labels, (1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), labels


def test_classifiers(spark):
    docs, labels, truth = labelled(spark)
    for scores, column, least in ((quality.scores, 1, 0.97), (toxicity.scores, 2, 0.97)):
        got = {r.doc_id: r for r in scores(docs, labels).collect()}
        held = [t for t in truth if zlib.crc32(str(t[0]).encode()) % 5 == 0]
        assert {i for i, r in got.items() if r.held_out} >= {t[0] for t in held} and len(got) == len(truth) + 2
        assert np.mean([got[t[0]].predicted == t[column] for t in held]) >= least
        assert all(0 <= r.score <= 1 for r in got.values())
        assert scores(docs.limit(0), labels).count() == 0 and scores(docs.limit(5), labels.limit(0)).count() == 5
    assert quality.accepted(docs, labels).columns == docs.columns


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, labels, _ = labelled(spark, 300)
    docs.selectExpr("*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = kept.count(), kept.columns
        kept = stage(spark, kept, str(tmp_path)).cache()
        assert kept.columns == columns and 0 < kept.count() <= before
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()


def edited(words, n, tag):
    """The words with n of them, far from each other, replaced: five shingles of five words differ for each."""
    out = list(words)
    for k in range(n):
        out[10 + 20 * k] = f"{tag}{k}"
    return " ".join(out)


def near_texts():
    rng = random.Random(11)
    texts = []
    for g in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        texts += [" ".join(words), edited(words, 3, f"a{g}x"), edited(words, 4, f"b{g}x"), edited(words, 9, f"c{g}x")]
    chain = texts[2].split()
    return texts + [edited(chain[::-1][:200][::-1], 2, "d"), "Two words", "two  WORDS", "two other", "", None, " "]


def test_near_copies_share_four_fifths_of_five_word_shingles(spark):
    import corpus_pipeline

    rows = [(i, t) for i, t in enumerate(near_texts())]

    def cut(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    s = [cut(t) for _, t in rows]
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1
    label = roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if share(s[a], s[b]) >= 0.8])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component for r in shingles.near_duplicates(df).collect()}
    assert all((got[a] == got[b]) == (label[a] == label[b]) for a in range(len(rows)) for b in range(a))
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()) == sorted(set(label))
    assert shingles.near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows_keep_their_text(spark):
    other = " ".join(f"p{k}" for k in range(80))
    rows = [(5, other), (5, other), (5, other), (7, "x " + PASSAGE), (7, "x " + PASSAGE), (9, PASSAGE + " y"), (None, "n" + other[:150]), (None, "n" + other[:150])]
    got = sorted(((r.doc_id or 0, r.n_bytes, bytes(r.kept)) for r in suffixes.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=str)
    seen, want = set(), {}
    for i, t in sorted(set(rows), key=lambda r: r[0] or 0):
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            gone[k : k + 100] |= data[k : k + 100] in seen
            seen.add(data[k : k + 100])
        want[i] = (i or 0, len(data), bytes(b for b, g in zip(data, gone, strict=True) if not g))
    assert got == sorted((want[i] for i, _ in rows), key=str) and want[7][2] == b"x " + PASSAGE.encode()


def test_chat_reads_back_texts_that_end_in_backslashes(spark):
    said = ["abc\\", "abc\\\\", "\\b", "\\\\</turn>\n", "\\", "\\</turn>", "\\### x\\", "plain"]
    rows = [(c, t, r, x) for c, order in ((1, said), (2, said[::-1])) for t, (r, x) in enumerate(zip(["user", "user", "assistant", "as\\", "as\\\\", "\\:\n", "user", "user"], order, strict=True))]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c in (1, 2):
        turns = [(r, x) for i, _, r, x in rows if i == c]
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert got[c].loss_sha256 == sha("".join(x for r, x in turns if r == "assistant"))


@pytest.mark.parametrize("inner", [4, 8, 64])
def test_embeddings_of_fewer_dimensions_than_columns(spark, inner):
    rng = np.random.default_rng(inner)
    turn = np.linalg.qr(rng.normal(size=(64, inner)))[0].T
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(1500, inner)))
    off = rng.normal(size=x.shape)
    off = unit(off - (off * x).sum(1, keepdims=True) * x)
    cosine = rng.uniform(0.9, 0.92, (1500, 1))
    x = np.concatenate((x, cosine * x + np.sqrt(1 - cosine**2) * off)) @ turn
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect()}
    near = unit(x) @ unit(x).T >= 0.9
    np.fill_diagonal(near, False)
    want, found = near.sum(1), np.array([got[i].n_links for i in range(len(x))])
    assert (found <= want + 1).all() and found.sum() >= 0.995 * want.sum()
    label = components.local_labels(*np.nonzero(near), len(x))
    assert np.mean([got[i].component_id == label[i] for i in range(len(x))]) >= 0.99


def test_lexicon_keeps_every_feature_that_tells(spark):
    common = " ".join(f"{''.join(chr(97 + k // 26**j % 26) for j in range(3))}commonword" for k in range(12_000))
    rows = [(common + (" vizlenik" if y and i < 16 else ""), y, i % 2) for y in (0, 1) for i in range(20)]
    size = np.full((2, 2), 10.0)
    counts = toxicity.lexicon(spark.createDataFrame(rows, "text string, y int, half int").repartition(4), size)
    odds = toxicity.log_odds([(f, c.sum(0)) for f, c in counts], size.sum(0))
    assert set(odds) == set(toxicity.features(b"vizlenik")) and len(counts) == len(odds)


def test_near_copies_keep_one_row_of_each_group(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{k}{i}" for i in range(90)) for k in "xyz")
    rows = [(None, a), (None, a), (4, a + " end"), (4, b), (4, b), (2, b + " end"), (None, c), (None, c), (None, None), (8, "")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()]
    assert sorted(got, key=str) == sorted([(4, a + " end"), (2, b + " end"), (None, c), (8, "")], key=str)
