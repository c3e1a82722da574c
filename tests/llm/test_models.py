"""Fitted and hashed operators against plain Python that shares no code with them."""

import itertools
import math

import numpy as np
import pytest
from voxelloom.llm import common, labels, oph, quality, toxicity


def test_sketches_equal_a_bin_by_bin_computation():
    texts = [b"", b"one", b"a b c d e f g", " ".join(f"w{k}" for k in range(60)).encode(), " ".join(f"v{k * k}" for k in range(900)).encode()]
    bins, bits = 512, 4
    got = oph.sketch(texts, bins, bits)
    hashes, owner = common.word_shingles(texts, 5)
    mix = lambda x: int(common.mix(np.array([x & (1 << 64) - 1], np.uint64))[0])
    for i in range(len(texts)):
        low = {}
        for h in hashes[owner == i].tolist():
            low[h >> 55] = min(low.get(h >> 55, 1 << 64), mix(h) >> 1)
        want = []
        for b in range(bins):
            donor = b
            for attempt in itertools.count():
                if donor in low or not low:
                    break
                donor = mix((b + 1) * 0x9E3779B97F4A7C15 + attempt) >> 55
            want.append(mix(low[donor] ^ mix(b + 2 * bins)) & 15 if low else -1)
        assert got[i].tolist() == want


def test_likeness_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        n, m = int(rng.integers(40, 400)), int(rng.integers(0, 400))
        a = [f"w{k}" for k in rng.permutation(10**6)[: n + m]]
        one, two = " ".join(a[:n] + a[n:]).encode(), " ".join(a[:n] + [f"x{k}" for k in range(m)]).encode()
        sa, sb = ({tuple(t.split()[i : i + 5]) for i in range(n + m - 4)} for t in (one, two))
        s = oph.sketch([one, two])
        errors.append(float(oph.likeness(s[:1], s[1:])[0]) - len(sa & sb) / len(sa | sb))
    assert abs(np.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.12


def isotonic_by_min_max(raw, y):
    """The monotone regression at each level, by its min-max formula."""
    level = sorted(set(raw))
    n, s = [raw.count(v) for v in level], [sum(b for a, b in zip(raw, y, strict=True) if a == v) for v in level]
    mean = lambda i, j: sum(s[i : j + 1]) / sum(n[i : j + 1])
    return level, [max(min(mean(i, j) for j in range(k, len(level))) for i in range(k + 1)) for k in range(len(level))]


def test_calibration_is_isotonic_regression_in_any_order():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 40))
        raw, y = np.round(rng.normal(size=n), 1), rng.integers(0, 2, n).astype(float)
        x, v = quality.isotonic(raw, y)
        by = rng.permutation(n)
        x2, v2 = quality.isotonic(raw[by], y[by])
        assert np.allclose(x, x2) and np.allclose(v, v2)
        level, fitted = isotonic_by_min_max(raw.tolist(), y.tolist())
        pools = [[i for i, _ in g] for _, g in itertools.groupby(enumerate(np.round(fitted, 9)), key=lambda t: t[1])]
        rows = [[k for k in range(n) if raw[k] in [level[i] for i in p]] for p in pools]
        assert np.allclose(x, [raw[r].mean() for r in rows])
        assert np.allclose(v, [(y[r].sum() + 0.5 * y.mean()) / (len(r) + 0.5) for r in rows])


def test_ridge_equals_least_squares_over_all_rows(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["alpha", "beta.", "***", "x", "the", "Of"], rng.integers(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, "a second text of one id")], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, int("***" in t), 0) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, marks)
    sample = labels.labelled_texts(docs, marks, "quality").collect()
    assert len(sample) == len({r.doc_id for r in sample}) and all(r.doc_id < 300 for r in sample)
    x = np.array([quality.statistics((r.text or "").encode()) for r in sample])
    y, fold = np.array([r.y for r in sample], float), np.array([r.fold for r in sample])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.maximum(x.std(0), 1e-6))
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    phi = np.array([[math.sqrt(2 / quality.FEATURES) * math.cos(sum(a * w for a, w in zip(row, model.turn[:, j], strict=True)) + model.shift[j]) for j in range(quality.FEATURES)] + [1.0] for row in z])
    use = fold < 3
    alpha = quality.RIDGE * max(1.0, use.sum()) / 100
    want = np.linalg.lstsq(np.vstack([phi[use], math.sqrt(alpha) * np.eye(phi.shape[1])]), np.append(y[use], np.zeros(phi.shape[1])), rcond=None)[0]
    assert np.allclose(phi @ want, model.raw(x), atol=1e-5)
    steps, values = quality.isotonic(phi[~use] @ want, y[~use])
    assert np.allclose(np.interp(phi @ want, steps, values), model.score(x), atol=1e-3)


def test_kernel_is_gaussian():
    rng = np.random.default_rng(4)
    turn, shift = rng.normal(0, np.sqrt(2 * quality.GAMMA), (quality.STATISTICS, 20_000)), rng.uniform(0, 2 * np.pi, 20_000)
    m = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), turn, shift, np.zeros(1), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(6, quality.STATISTICS)) / 2
    f = m.features(x)[:, :-1]
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(f @ f.T - np.exp(-quality.GAMMA * d)).max() < 0.05


def test_log_odds_by_hand():
    size = np.array([300.0, 100.0])
    counts = [(b"vizl", np.array([1.0, 60.0])), (b"vizlen", np.array([0.0, 30.0])), (b"com", np.array([150.0, 50.0])), (b"rare ", np.array([0.0, 3.0]))]
    got = toxicity.log_odds(counts, size)
    p = 0.25
    root = (60 + 3 * p) / (61 + 3)
    deeper = (30 + 3 * root) / (30 + 3)
    logit = lambda q: math.log(q / (1 - q)) - math.log(p / (1 - p))
    # three toxic documents alone do not beat the chance of 40,000 features; a common word tells nothing
    assert set(got) == {b"vizl", b"vizlen"}
    assert got[b"vizl"] == pytest.approx(logit(root)) and got[b"vizlen"] == pytest.approx(logit(deeper))


def test_law_of_good_passages():
    weights, times = np.array([2.0, 1.0, -0.5]), np.array([3.0, 10.0, 400.0])
    rate = toxicity.decay(weights, times)
    assert (times * np.exp(rate * weights)).sum() == pytest.approx(times.sum(), rel=1e-6) and rate > 0
    assert toxicity.decay(np.array([-1.0, -2.0]), np.array([5.0, 5.0])) is None and toxicity.decay(np.array([3.0]), np.array([4.0])) is None
    # scores of harmless texts exceed s with chance K n exp(-rate s): a simulation, within its error
    rng = np.random.default_rng(6)
    p = times / times.sum()
    best, starts = [], 0
    for _ in range(400):
        found = toxicity.segments(rng.choice(weights, 400, p=p))
        starts += len(found)
        best.append(max((s for _, _, s in found), default=0.0))
    space = starts / (400 * 400)
    for s in (5.0, 7.0):
        expect = 1 - math.exp(-space * 400 * math.exp(-rate * s))
        assert np.mean(np.array(best) >= s) <= expect + 0.05


def test_fit_in_tasks_equals_one_pass(spark):
    rng = np.random.default_rng(11)
    words = [f"{a}{b}{c}ord" for a in "bcdfg" for b in "aeiou" for c in "lmnpr"]
    texts, marks = [], []
    for i in range(400):
        t = rng.choice(words, rng.integers(20, 80)).tolist()
        bad = int(i % 4 == 0)
        if bad:
            at = int(rng.integers(0, len(t)))
            t[at:at] = rng.choice(["zugrum", "zugrak", "plofix"], 8).tolist()
        texts.append((i, " ".join(t)))
        marks.append((i, 1, bad))
    docs, table = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    one, two = toxicity.fit(docs.repartition(1), table), toxicity.fit(docs.repartition(7), table)
    assert one.odds == two.odds and (one.other, one.rate, one.space) == pytest.approx((two.other, two.rate, two.space)) and one.slope == pytest.approx(two.slope)
    assert {b"zug", b"plo"} <= set(one.odds) and not any(f.startswith(b"ba") for f in one.odds)
    got = {r.doc_id: r for r in toxicity.scores(docs, table).collect()}
    assert np.mean([got[i].predicted == bad for i, _, bad in marks]) > 0.97
    spans = {r.doc_id: r.spans for r in toxicity.passages(docs, table).collect()}
    for i, t in texts[:40:4]:
        bad = {k for k, w in enumerate(t.split()) if w[:3] in ("zug", "plo")}
        assert {k for s in spans[i] for k in range(s.start, s.end)} >= bad
