"""A quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, held_out, id_of, kept_rows, remove, text_of, tuned, written
from .labels import PER_CLASS, labelled_texts

FEATURES, GAMMA, RIDGE, SEED = 256, 0.12, 1e-3, 42
#: A document is accepted from this score on.
ACCEPT = 0.3
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _MARKS = b"0123456789", b"*#$%&!@^~|<>{}[]=_+\\/"
_ALL = bytes(range(256))
STATISTICS = 18


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a whole text; all zero for one without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    size = len(text)
    count = lambda which: size - len(text.translate(None, which))
    upper, lower, digits, marks = map(count, (_UPPER, _LOWER, _DIGITS, _MARKS))
    often = Counter(words)
    most = max(often.values())
    lines = [x for x in text.split(b"\n") if x]
    chars = len(text.translate(None, _ALL[0x80:0xC0]))
    ends = text.count(b".") + text.count(b"?")
    return [
        np.log1p(size), np.log1p(n), chars / n, upper / size, lower / size, digits / size, marks / size,
        text.count(b"!") / n, text.count(b"|") / n, (text.count(b",") + ends) / n, ends / n, (size - chars) / size,
        len(often) / n, most / n, sum(map(eq, words, words[1:])) / n, len(set(lines)) / max(1, len(lines)),
        np.log1p(len(lines)), np.log1p(n / max(1, ends)),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    steps: np.ndarray  # raw scores at which the calibrated ones are known
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / len(self.shift)) * np.cos(z @ self.turn + self.shift), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.values)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """The score of each whole text, to nine places: sums over a batch may differ in the last bits with its size."""
        return np.round(np.clip(self.score(np.array([statistics(t) for t in texts])), 0, 1), 9) if texts else np.zeros(0)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: the mean raw score and the label share of each pool, shares smoothed by half a row.

    Equal raw scores are one pool from the start, so the order of rows means nothing. Scores between the pools are
    interpolated, so the calibrated order never reverses the raw one.
    """
    level, at = np.unique(raw, return_inverse=True)
    pools: list[list[float]] = []  # rows, raw sum, label sum
    for r, n, v in zip(level.tolist(), np.bincount(at).tolist(), np.bincount(at, y).tolist(), strict=True):
        pools.append([float(n), n * r, v])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    x = np.array([p[1] / p[0] for p in pools])
    v = np.maximum.accumulate([(p[2] + 0.5 * np.mean(y)) / (p[0] + 0.5) for p in pools])
    return x, v


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Normal equations summed by partition over the bounded labelled sample; three folds fit, the fourth calibrates.

    Without rows of both classes the score is the share of the label, or 1 without any.
    """
    tuned(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([statistics(t) for t in as_bytes(b)], pa.list_(pa.float64())), *b.columns[1:]], ["x", "y", "fold"])

    sample = labelled_texts(docs, labels, "quality", per_class).select("text", "y", "fold")
    rows, path = written(sample.mapInArrow(describe, "x array<double>, y int, fold int"), "labelled")
    moments = rows.select(*[F.array(*[f(F.col("x")[i]) for i in range(STATISTICS)]).alias(n) for n, f in (("m", F.avg), ("s", F.stddev_pop))], F.avg("y").alias("share")).first()
    rng = np.random.default_rng(SEED)
    turn, shift = rng.normal(0, np.sqrt(2 * GAMMA), (STATISTICS, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
    share = 1.0 if moments["share"] is None else moments["share"]
    if share in (0.0, 1.0):
        remove(rows.sparkSession, path)
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), turn, shift, np.zeros(FEATURES + 1), np.array([0.0]), np.array([share]))
    model = Model(np.array(moments["m"]), np.maximum(np.array(moments["s"]), 1e-6), turn, shift, np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.0]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            phi = model.features(_matrix(batch.column(0)))
            a += phi.T @ phi
            b += phi.T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], ["a", "b"])

    parts = rows.filter("fold < 3").select("x", "y").coalesce(8).mapInArrow(sums, "a binary, b binary").collect()  # eight at most
    a = sum(np.frombuffer(p["a"]).reshape(FEATURES + 1, -1) for p in parts)
    b = sum(np.frombuffer(p["b"]) for p in parts)
    model.weight = np.linalg.solve(a + RIDGE * max(1.0, a[-1, -1]) / 100 * np.eye(FEATURES + 1), b)
    last = rows.filter("fold = 3").select("x", "y").toArrow()  # bounded as the sample is
    if last.num_rows:
        x, y = _matrix(last.column("x").combine_chunks()), last.column("y").to_numpy()
        model.steps, model.values = isotonic(model.raw(x), y)
    else:
        model.steps, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    remove(rows.sparkSession, path)
    return model


def scores(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document; score is the calibrated chance of label 1.

    Null, empty and blank texts get the score of all-zero statistics. Null ids are scored and never held out. Rows that
    repeat give equal scores. An empty table gives no rows. Other columns are ignored.
    """
    tuned(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, per_class))  # FEATURES x STATISTICS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.value.of(as_bytes(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= ACCEPT).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = df.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def accepted(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of df that the classifier accepts, with all their columns, scored as scores does.

    Null, empty and blank texts are judged by all-zero statistics; rows that repeat stay or go together. Without usable
    labels every row stays. An empty table gives no rows. Other columns may have any name.
    """
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, per_class))
    return kept_rows(df, lambda texts: model.value.of(texts) >= ACCEPT)
