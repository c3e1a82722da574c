"""Helpers shared by the operators: whole-text batches, the shared folder, fixed-seed hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch: texts may be long, so batches are kept small.
ARROW_ROWS = 400
#: Bytes of text that are worked on at once inside a task.
GROUP_BYTES = 1 << 20


def tuned(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of very long texts fits a Python worker; workers find this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In one process (local mode) a temporary one serves where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """df as a table in the shared folder, read back; cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Fixed value: the C library's number for the size from which blocks are mapped one by one.
_MMAP_THRESHOLD = -3
#: What operators keep in a Python worker between tasks, by operator.
CACHES: dict[str, dict] = {}


def released(keep: str = "") -> None:
    """Drops what other operators than keep have left in this Python worker, and gives the memory back to the system.

    From then on blocks of a megabyte or more, Arrow's too, are the system's own again as soon as they are freed: else a worker holds on
    to the largest batch that it has seen.
    """
    for name, cache in CACHES.items():
        if name != keep:
            cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):  # not the C library that has it
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(_MMAP_THRESHOLD, 1 << 20)
        libc.malloc_trim(0)


def text_of(column: str = "text") -> Column:
    """A text column as a string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    return F.col(column).cast("long")


def held_out(column: str = "doc_id") -> Column:
    """True for the fold whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    texts = batch.column(batch.schema.get_field_index(column))
    texts = texts.cast(pa.string()) if not pa.types.is_binary(texts.type) else texts
    return texts.cast(pa.binary()).fill_null(b"").to_pylist()


def placed(df: DataFrame, *known: str) -> DataFrame:
    """df with every column but the known ones under a name of its place, so that names that clash or hold dots mean nothing."""
    return df.toDF(*[c if c in known else f"c{i}" for i, c in enumerate(df.columns)])


def kept_rows(df: DataFrame, keep: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of df whose whole text keep marks, in one pass without a shuffle and with every column, whatever its name; null texts are empty."""
    tuned(df.sparkSession)
    rows = placed(df, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(keep(as_bytes(b))))

    return rows.mapInArrow(run, rows.schema).toDF(*df.columns)


def by_size(texts: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of texts with about limit bytes together, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, over unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**i for i < n, modulo 2**64."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


class Rolling:
    """Prefix sums of a polynomial hash over bytes: the hash of any range in constant time, in whole arrays."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * powers(len(data)), out=self.sums[1:])
        self.back = powers(len(data) + 1, inverse=True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of every range of width bytes."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one array with line feeds between; the start, end and text number of each word."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    word = np.zeros(len(data) + 2, dtype=bool)
    word[1:-1] = ~_SPACE[data]
    turn = np.flatnonzero(word[1:] != word[:-1])
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    return data, turn[::2], turn[1::2], np.searchsorted(ends, turn[::2], side="right")


def word_shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of width words; a text of fewer words gives its whole run, one without words none."""
    data, start, end, owner = word_spans(texts)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = Rolling(data).of(start, end)
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    left = (first + count)[owner] - np.arange(len(owner))  # words from here to the text's end
    full, short = left >= width, (count[owner] < width) & (left == count[owner])
    at = np.flatnonzero(full | short)
    size, out = np.where(full[at], width, left[at]), np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        more = k < size
        out[more] = mix(out[more] * np.uint64(_BASE) + words[at[more] + k])
    return out, owner[at]

