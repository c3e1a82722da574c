"""Toxic passages as maximum-scoring segments of token log-odds, with extreme-value calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, held_out, id_of, kept_rows, released, remove, text_of, tuned, written
from .labels import PER_CLASS, labelled_texts, without_copies

#: Lengths in bytes of the word beginnings that carry log-odds besides the whole word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Toxic documents that a feature needs.
LEAST = 3
#: Weight of the Dirichlet prior, in documents; features that a document is taken to add, whose logarithm the
#: log-likelihood ratio of a feature must reach against chance; and the log-odds that it needs, and has at most.
PRIOR, PER_DOCUMENT, LOW, HIGH = 3.0, 100, 1.0, 8.0
FLAG = 0.5
#: Words whose weight a worker keeps; beyond it the store starts anew, which changes no result.
KEPT = 200_000
#: Features that a task counts before it passes them on.
HELD = 150_000
_CUT = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words of letters, in UTF-8."""
    return text.decode("utf-8", "replace").lower().encode().translate(_CUT).split()


def features(word: bytes) -> list[bytes]:
    """Beginnings of a word from short to long, then the word itself, which a blank closes."""
    return [word[:k] for k in BEGINNINGS if k <= len(word)] + [word + b" "]


@dataclass
class Model:
    odds: dict[bytes, float] = field(default_factory=dict)  # log-odds of a feature, its shorter ones being its prior
    other: float = -0.01  # log-odds of every token without a feature
    rate: float = 1.0  # lambda of the extreme-value law
    space: float = 1.0  # K of it
    slope: tuple[float, float, float] = (0.0, 0.0, 0.0)  # logistic: constant, evidence, log of significant passages' sum
    kept: dict[bytes, float] = field(default_factory=dict)

    def weights(self, words: list[bytes]) -> np.ndarray:
        for w in set(words).difference(self.kept):
            self.kept[w] = next((self.odds[f] for f in reversed(features(w)) if f in self.odds), self.other)
        out = np.fromiter(map(self.kept.__getitem__, words), dtype=np.float64, count=len(words))
        if len(self.kept) > KEPT:
            self.kept.clear()
        return out

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        """(minus the log of the chance that a harmless text of n tokens holds so good a passage, sum of the significant ones)."""
        if not segments:
            return 0.0, 0.0
        expect = lambda s: self.space * max(n, 1) * np.exp(-self.rate * s)
        best = max(s for _, _, s in segments)
        chance = -np.expm1(-expect(best))
        return float(-np.log(max(chance, 1e-300))), float(sum(s for _, _, s in segments if expect(s) < 0.05))

    def score(self, text: bytes) -> tuple[float, list[tuple[int, int, float]]]:
        w = self.weights(tokens(text))
        found = segments(w)
        log_p, total = self.evidence(found, len(w))
        z = self.slope[0] + self.slope[1] * np.log1p(log_p) + self.slope[2] * np.log1p(total)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), found


def segments(w: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time: only tokens above zero are visited.

    A list holds the segments found so far with the sums before and at their end. A new one is joined with the
    nearest earlier segment that starts lower, if that one does not end higher.
    """
    at = np.flatnonzero(w > 0)
    if not len(at):
        return []
    sums = np.concatenate(([0.0], np.cumsum(w)))
    held: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at end, nearest earlier one with a lower start
    for k in at.tolist():
        start, end, low, high = k, k + 1, sums[k], sums[k + 1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((start, end, low, high, j))
                break
            start, low = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, float(high - low)) for a, b, low, high, _ in held]


def beats_chance(c: Column, t: Column, size: np.ndarray) -> Column:
    """Whether log_odds may take a feature of c harmless and t toxic documents by itself: a little laxer than that, never stricter."""
    p, evidence = float(size[1] / size.sum()), float(np.log(PER_DOCUMENT * size.sum()))
    n = (c + t).cast("double")
    part = lambda k, share: F.when(k > 0, k * F.log(k / (n * share))).otherwise(0.0)
    return (t > 0) & (part(c, 1 - p) + part(t, p) >= evidence - 1e-6) & (t >= n * p - 1e-6)


def lexicon(docs: DataFrame, size: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """Features with [harmless, toxic] documents of [either half] in which they occur: counted in tasks, then summed by feature.

    All that log_odds can take are there: features that beat chance in all documents or in a half, and those that continue one.
    They are bounded as the sample is. size holds the [harmless, toxic] documents of [either half].
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        seen = [Counter() for _ in range(4)]

        def counted() -> Iterator[pa.RecordBatch]:
            names = list(set().union(*seen))
            for at in range(0, len(names), 20_000):
                part = names[at : at + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), *[pa.array([c[f] for f in part], pa.int64()) for c in seen]], ["f", "c0", "t0", "c1", "t1"])
            for c in seen:
                c.clear()

        for b in batches:
            for text, y, half in zip(as_bytes(b), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seen[2 * half + y].update({f for w in set(tokens(text)) for f in features(w)})
            if sum(map(len, seen)) > HELD:
                yield from counted()
        yield from counted()

    rows = docs.select("text", "y", "half").mapInArrow(count, "f binary, c0 long, t0 long, c1 long, t1 long").groupBy("f").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
    rows, path = written(rows.filter(F.col("t0") + F.col("t1") >= LEAST), "features")
    passes = beats_chance(F.col("c0") + F.col("c1"), F.col("t0") + F.col("t1"), size.sum(0))
    for h in (0, 1):
        if size[h].all():
            passes |= beats_chance(F.col(f"c{h}"), F.col(f"t{h}"), size[h])
    roots = rows.filter(passes).select(F.col("f").alias("root"))
    starts = F.array_append(F.transform(F.filter(F.array(*map(F.lit, BEGINNINGS)), lambda k: k < F.length("f")), lambda k: F.substring(F.col("f"), F.lit(1), k)), F.col("f"))
    kept = rows.select("f", F.explode(starts).alias("root")).join(roots, "root", "left_semi").select("f").distinct()
    found = rows.join(kept, "f", "left_semi").collect()
    remove(docs.sparkSession, path)
    return [(bytes(r["f"]), np.array([[r["c0"], r["t0"]], [r["c1"], r["t1"]]])) for r in found]


def log_odds(counts: list[tuple[bytes, np.ndarray]], size: np.ndarray) -> dict[bytes, float]:
    """Log-odds of the features that tell toxic documents: a feature's prior is its longest shorter one's share.

    counts and size hold [harmless, toxic] documents. A feature must beat the chance of so many features, or continue one that
    does; its share is shrunk to its prior by a Dirichlet weight of PRIOR documents.
    """
    p, evidence = size[1] / size.sum(), np.log(PER_DOCUMENT * size.sum())
    share: dict[bytes, float] = {}
    out: dict[bytes, float] = {}
    for f, (c, t) in sorted(counts, key=lambda x: (len(x[0]), x[0])):
        parent = next((q for q in (f[:k] for k in reversed(BEGINNINGS) if k < len(f)) if q in share), None)
        n = c + t
        chance = t * np.log(t / (n * p)) + (c * np.log(c / (n * (1 - p))) if c else 0) if t else 0
        if n == 0 or parent is None and (chance < evidence or t < n * p):
            continue
        prior = share[parent] if parent is not None else p
        now = (t + PRIOR * prior) / (n + PRIOR)
        odds = float(np.clip(np.log(now / max(1 - now, 1e-9)) - np.log(p / (1 - p)), -HIGH, HIGH))
        if parent is None and odds < LOW:
            continue
        share[f], out[f] = now, odds
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model of the bounded labelled sample: each half is measured by the other half's log-odds, for law and calibration.

    Without documents of both classes the score is the share of the label, or 0 without any.
    """
    tuned(docs.sparkSession)
    spark = docs.sparkSession
    rows, path = written(labelled_texts(docs, labels, "toxic", per_class).select("doc_id", "text", "y", (F.col("fold") % 2).alias("half")), "labelled")
    rows = without_copies(rows)
    size = np.zeros((2, 2))
    for r in rows.groupBy("y", "half").count().collect():
        size[r["half"], r["y"]] = r["count"]
    model = Model()
    if not size.sum(0).all():
        model.slope = (30.0 if size[:, 1].any() else -30.0, 0.0, 0.0)
        remove(spark, path)
        return model
    counts = lexicon(rows, size)
    model.odds = log_odds([(f, c.sum(0)) for f, c in counts], size.sum(0))
    other = [Model(odds=log_odds([(f, c[1 - h]) for f, c in counts], size[1 - h]) if size[1 - h].all() else model.odds, other=0.0) for h in (0, 1)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document: its tokens, and the places and weights of those that have a feature."""
        for b in batches:
            out = []
            for text, y, half in zip(as_bytes(b), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                w = other[half].weights(tokens(text))
                at = np.flatnonzero(w)
                out.append((y, len(w), at.astype("<i8").tobytes(), w[at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["y", "n", "at", "w"])

    told, told_path = written(rows.select("text", "y", "half").mapInArrow(measure, "y int, n long, at binary, w binary"), "told")

    def dense(n: int, at: bytes, w: bytes) -> np.ndarray:
        out = np.full(n, model.other)
        out[np.frombuffer(at, "<i8")] = np.frombuffer(w)
        return out

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each weight of each label's tokens with how often it is there; null stands for all tokens."""
        seen: Counter = Counter()
        for b in batches:
            for y, n, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seen[y, None] += n
                for v, k in zip(*(x.tolist() for x in np.unique(np.frombuffer(w), return_counts=True)), strict=True):
                    seen[y, v] += k
        columns = zip(*((y, v, k) for (y, v), k in seen.items()), strict=True) if seen else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.float64(), pa.int64()), strict=True)], ["y", "w", "k"])

    # as many rows as there are weights, which are at most twice the features
    sums = {(r["y"], r["w"]): r["k"] for r in told.select("y", "n", "w").mapInArrow(summed, "y int, w double, k long").groupBy("y", "w").agg(F.sum("k").alias("k")).collect()}
    token_n = [max(1, sums.get((y, None), 0)) for y in (0, 1)]
    hits = [sum(k for (label, w), k in sums.items() if label == y and w is not None and w > 0) for y in (0, 1)]
    # a token without a feature is likelier in a harmless text by just what the others take up
    model.other = min(-1e-3, float(np.log((1 - min(0.5, hits[1] / token_n[1])) / (1 - min(0.5, hits[0] / token_n[0])))))

    # the law of good passages in harmless texts: lambda solves sum p exp(lambda w) = 1, K is how many start at a token
    values, times = (np.array(x, float) for x in zip(*sorted((w, k) for (y, w), k in sums.items() if y == 0 and w is not None), strict=True)) if any(y == 0 and w is not None for y, w in sums) else (np.zeros(0), np.zeros(0))
    model.rate = decay(np.append(values, model.other), np.append(times, token_n[0] - times.sum())) or model.rate

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(segments(dense(*x))) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)], pa.int64())], ["k"])

    starts = told.filter("y = 0").select("n", "at", "w").mapInArrow(counted, "k long").agg(F.sum("k")).first()[0] or 0
    model.space = max(1.0, float(starts)) / token_n[0]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, *rest = (c.to_pylist() for c in b.columns)
            found = [model.evidence(segments(dense(*x)), x[0]) for x in zip(*rest, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64())], ["y", "log_p", "total"])

    # three numbers for each document of the sample, in an order of their own
    seen = sorted(map(tuple, told.mapInArrow(weighed, "y int, log_p double, total double").collect()))
    model.slope = logistic(np.log1p(np.array([r[1:] for r in seen])), np.array([r[0] for r in seen]))
    for p in (path, told_path):
        remove(spark, p)
    return model


def decay(weights: np.ndarray, times: np.ndarray) -> float | None:
    """lambda of the extreme-value law: the positive root of sum(times * exp(lambda * weights)) = sum(times); None without one."""
    excess = lambda lam: (times * np.exp(lam * weights)).sum() - times.sum()
    low, high = 1e-3, 20.0
    if not len(weights) or weights.max() <= 0 or excess(low) >= 0:
        return None
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, float, float]:
    """Newton's method for a regularised logistic model with weights that may not be negative."""
    use = list(range(x.shape[1]))
    while True:
        a = np.hstack([np.ones((len(x), 1)), x[:, use]])
        w = np.zeros(a.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            g = a.T @ (y - p) - ridge * np.append(0, w[1:])
            h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        bad = [i for i, v in zip(use, w[1:], strict=True) if v < 0]
        if not bad:
            out = np.zeros(1 + x.shape[1])
            out[0] = w[0]
            out[[1 + i for i in use]] = w[1:]
            return tuple(map(float, out))
        use = [i for i in use if i not in bad]


def passages(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, score, spans: every significant toxic passage as first token, token behind it, score) of each document.

    Texts without words have no spans. Null ids, repeated rows, empty tables and other columns are as in scores.
    """
    tuned(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, per_class))  # features are bounded as the sample is

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            out = [m.score(t) for t in as_bytes(b)]
            spans = [[{"start": s, "end": e, "score": v} for s, e, v in f if m.space * max(1, e) * np.exp(-m.rate * v) < 0.05] for _, f in out]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in out], pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    return df.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, score double, spans array<struct<start:long,end:long,score:double>>")


def scores(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document; score is the calibrated chance that it is toxic.

    Null, empty and blank texts have no passage and get the score of a harmless text. Null ids are scored and never held out.
    Rows that repeat give equal scores. An empty table gives no rows. Other columns are ignored.
    """
    return passages(df, labels, per_class).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= FLAG, 1).otherwise(0).alias("predicted"))


def accepted(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of df that are not predicted toxic, with all their columns, scored as scores does.

    Null, empty and blank texts hold no passage and stay, unless every label is toxic; rows that repeat stay or go together. An
    empty table gives no rows. Other columns may have any name.
    """
    tuned(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, per_class))
    return kept_rows(df, lambda texts: np.array([model.value.score(t)[0] < FLAG for t in texts], dtype=bool))
