"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, by_size, held_out, id_of, text_of
from .oph import sketch

#: Labelled documents of each class that a classifier learns from at most: those with the smallest hashes of doc_id.
PER_CLASS = 12_000


def labelled_sample(labels: DataFrame, label: str, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, y, fold) of at most 2 * per_class labelled documents outside the held-out fold.

    A null label or doc_id is no label; of repeated rows the larger label counts. fold, 0 to 3, follows from a
    hash of doc_id alone. As the size is bounded by per_class, the sample may be broadcast.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    key = [F.xxhash64(F.lit(label), "doc_id"), F.col("doc_id")]
    each = [rows.filter(F.col("y") == y).orderBy(*key).limit(per_class) for y in (0, 1)]
    return each[0].unionAll(each[1]).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)).cast("int"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, text, y, fold) of the labelled sample's documents, in eight parts by doc_id, so that a fit does not depend on how docs is split.

    Of rows that repeat a doc_id the text with the smallest hash is the one learned from, which keeps the sample's size
    bounded by per_class. Null texts are empty. Without labelled documents there are no rows. Other columns are ignored.
    """
    rows = docs.select(id_of().alias("doc_id"), text_of().alias("text")).join(F.broadcast(labelled_sample(labels, label, per_class)), "doc_id")
    one = rows.groupBy("doc_id", "y", "fold").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("r"))
    return one.select("doc_id", F.col("r.text").alias("text"), "y", "fold").repartition(8, "doc_id").sortWithinPartitions("doc_id")


#: Bins of the sketches that tell copies inside a sample, and how many bins in a row must agree.
COPY_BINS, COPY_BAND = 32, 4


def without_copies(sample: DataFrame) -> DataFrame:
    """The rows of a bounded sample (doc_id, text, ...) without near copies of one another: of each group the smallest doc_id stays.

    Copies would count one text's chance words as often as themselves. The driver gets 64 bytes for each of the sample's rows.
    Texts without words are no copies of one another. An empty sample stays empty. doc_id is taken to be unique and not null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b)
            parts = [sketch(texts[i:j], COPY_BINS, 12) for i, j in by_size(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for p in parts for r in p], pa.binary())], ["doc_id", "sketch"])

    seen: dict[tuple[int, bytes], bool] = {}
    kept = []
    for r in sorted(sample.select("doc_id", "text").mapInArrow(run, "doc_id long, sketch binary").collect()):
        values = np.frombuffer(r["sketch"], np.int16)
        bands = [(k, values[k : k + COPY_BAND].tobytes()) for k in range(0, COPY_BINS, COPY_BAND)]
        if values[0] < 0 or not any(band in seen for band in bands):
            kept.append((r["doc_id"],))
        seen.update(dict.fromkeys(bands, True))
    ids = sample.sparkSession.createDataFrame(kept or [(None,)], "doc_id long")
    return sample.join(F.broadcast(ids), "doc_id", "left_semi")
