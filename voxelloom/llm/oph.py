"""Document fingerprints: one-permutation MinHash, densified, as packed low-order bits."""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, by_size, id_of, mix, text_of, tuned, word_shingles

BINS, BITS, WIDTH = 512, 4, 5
#: Bytes of text for each range of ids, and the smallest long, which stands for a null id.
RANGE_BYTES, LOWEST = 64 << 20, -(1 << 63)


#: Full bins below which a text's donors are looked up, draws after which the rest are, and draws made at once for the look-up.
FEW, TRIES, CHUNK = 48, 64, 1024


def draw(bins: int, bin_: np.ndarray, attempt: np.ndarray | int) -> np.ndarray:
    """The donor that an empty bin asks at an attempt: a hash of the two, alike for all texts."""
    return (mix((bin_.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(attempt, np.uint64)) >> np.uint64(65 - bins.bit_length())).astype(np.int64)


@lru_cache
def first_draws(bins: int) -> np.ndarray:
    """[i, j]: the attempt at which the empty bin i first asks the bin j."""
    out, at = np.full(bins * bins, np.iinfo(np.int32).max, np.int32), 0
    each = np.arange(bins)[:, None]
    while (out == np.iinfo(np.int32).max).any():
        tries = np.arange(at, at + CHUNK)
        np.minimum.at(out, (each * bins + draw(bins, each, tries[None])).ravel(), np.broadcast_to(tries, (bins, CHUNK)).ravel().astype(np.int32))
        at += CHUNK
    return out.reshape(bins, bins)


def sketch(texts: list[bytes], bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> np.ndarray:
    """A row of bins values below 2**bits for each text; -1 throughout for a text without words. bins is a power of two.

    Every shingle is hashed once: high bits choose its bin, and the bin keeps the smallest of the rest. An empty bin takes the
    value of the first full bin that it draws, every attempt being a draw of its own; where few bins are full, a
    table tells at once which of them that is.
    """
    low, n_full = minima(*word_shingles(texts, width), len(texts), bins)
    return low_bits(low, n_full, bits)


def minima(hashes: np.ndarray, owner: np.ndarray, count: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(the smallest hash of each bin, empty bins filled; how many were full) for texts 0 to count - 1 from their shingles' hashes."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full(count * bins, empty)
    shift = np.uint64(64 - bins.bit_length() + 1)
    np.minimum.at(low, owner * bins + (hashes >> shift).astype(np.int64), mix(hashes) >> np.uint64(1))
    low = low.reshape(count, bins)
    full = low != empty
    n_full = full.sum(1)
    out = low.copy()
    rows, cols = np.nonzero(~full[many := np.flatnonzero(n_full >= FEW)])
    rows = many[rows]
    for attempt in range(TRIES):
        if not len(rows):
            break
        donor = draw(bins, cols, attempt)
        ok = full[rows, donor]
        out[rows[ok], cols[ok]] = low[rows[ok], donor[ok]]
        rows, cols = rows[~ok], cols[~ok]
    left = np.union1d(rows, np.flatnonzero((n_full > 0) & (n_full < FEW)))
    first = first_draws(bins) if len(left) else None
    for i in left.tolist():
        have, need = np.flatnonzero(full[i]), np.flatnonzero(~full[i])
        out[i, need] = low[i, have[first[np.ix_(need, have)].argmin(1)]]
    return out, n_full


def low_bits(low: np.ndarray, n_full: np.ndarray, bits: int) -> np.ndarray:
    """The minima's low-order bits; the bin is mixed in, so that copies of one value in many bins do not agree by chance together."""
    bins = low.shape[1]
    salt = mix(np.arange(bins, dtype=np.uint64) + np.uint64(2 * bins))
    out = (mix(low ^ salt) & np.uint64((1 << bits) - 1)).astype(np.int16)
    out[n_full == 0] = -1
    return out


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated shingle overlap of two sketches, row by row: low-order bits agree by chance too, which is taken off."""
    chance = 0.5**bits
    same = np.clip(((a == b).mean(1) - chance) / (1 - chance), 0, 1)
    return np.where((a[:, 0] < 0) | (b[:, 0] < 0), ((a[:, 0] < 0) & (b[:, 0] < 0)).astype(float), same)


def packed(rows: np.ndarray, bits: int = BITS) -> list[str]:
    """Each sketch as hexadecimal digits of its packed bits; the empty string for a text without words."""
    spread = (rows[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1
    data = np.packbits(spread.astype(np.uint8).reshape(len(rows), -1), axis=1)
    return ["" if r[0] < 0 else d.tobytes().hex() for r, d in zip(rows, data, strict=True)]


def fingerprints(df: DataFrame, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint) of each document's five-word shingles, in one pass without a shuffle.

    A text of fewer words is one shingle; null, empty and blank texts have the empty fingerprint. Rows that repeat,
    null ids and other columns change nothing.
    """
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b)
            out = [p for i, j in by_size(texts) for p in packed(sketch(texts[i:j], bins, bits, width), bits)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return df.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def head_bytes(text: bytes, chars: int) -> int:
    """Where the first chars code points of a text in UTF-8 end."""
    if text.isascii() or chars == 0:
        return min(chars, len(text))
    starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return int(starts[chars]) if chars < len(starts) else len(text)


def length(text: bytes) -> int:
    return len(text) if text.isascii() else int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def edited(text: bytes, after: bytes) -> bytes:
    """text with its last half of code points replaced by as many of the next text's first, or all it has."""
    n = length(text)
    return text[: head_bytes(text, n - n // 2)] + after[: head_bytes(after, n // 2)]


def with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its text edited with the next document's, by ascending doc_id.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Documents are dealt by
    ranges of doc_id, as many as their bytes ask for; the first of each range goes to the range before as well, so a task sees the
    next document of each of its own. The driver gets a doc_id and a hash for each range. Null ids come first, equal ids
    are ordered by a hash of their texts, which also splits an id with very many rows into ranges; after the last document
    comes the first (a sole one follows itself). Null texts are empty. An empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    tuned(spark)
    rows = df.select(id_of().alias("doc_id"), text_of().alias("text"), F.coalesce(id_of(), F.lit(LOWEST)).alias("at"), F.xxhash64(text_of()).alias("h"))
    cuts = _cuts(rows, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [bisect.bisect_right(cuts, x) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *b.columns], ["part", "at", "h"])

    lowest = rows.select("at", "h").mapInArrow(placed, "part int, at long, h long").groupBy("part").agg(F.min(F.struct("at", "h")).alias("first"))
    firsts = {r["part"]: tuple(r["first"]) for r in lowest.collect()}
    if not firsts:
        return df.select(id_of().alias("doc_id"), F.lit(0).cast("long").alias("n_chars"), *[F.lit("").alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], F.lit(0.0).alias("near_edited"), F.lit(0.0).alias("near_next"))
    full = sorted(firsts)
    before = {p: full[k - 1] for k, p in enumerate(full)}
    first_of = {firsts[p]: p for p in full}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            out: list[tuple] = []
            for i, t, a, h in zip(b.column(0).to_pylist(), as_bytes(b), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                small = squeeze.compress(t)
                out.append((bisect.bisect_right(cuts, (a, h)), 0, a, h, i, small))
                if (a, h) in first_of:
                    out.append((before[first_of[a, h]], 1, a, h, i, small))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 6, (pa.int32(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "tail", "at", "h", "doc_id", "text"])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def finished(ids: list, texts: list[bytes], after: list[bytes]) -> Iterator[pa.RecordBatch]:
        for i, j in by_size(texts):
            new = [edited(t, n) for t, n in zip(texts[i:j], after[i:j], strict=True)]
            own = sketch([*texts[i:j], after[j - 1]])  # the next of each is the one behind it
            changed, follow, own = sketch(new), own[1:], own[:-1]
            columns = [ids[i:j], [length(t) for t in texts[i:j]], [hashlib.sha256(t).hexdigest() for t in new], packed(own), packed(changed), likeness(own, changed), likeness(own, follow)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        part, ids, texts, ended = None, [], [], False
        for b in batches:
            for p, tail, key, small in zip(*(b.column(c).to_pylist() for c in (0, 1, 4, 5)), strict=True):
                if p != part:
                    part, ids, texts, ended = p, [], [], False
                if ended:
                    continue  # more rows with the first id of the next range: only the first follows
                text = open_.decompress(small)
                if tail:
                    ended = True
                    yield from finished(ids, texts, [*texts[1:], text])
                else:
                    ids.append(key)
                    texts.append(text)
                    if len(ids) > 200:
                        yield from finished(ids[:-1], texts[:-1], texts[1:])
                        ids, texts = ids[-1:], texts[-1:]

    dealt = rows.mapInArrow(deal, "part int, tail byte, at long, h long, doc_id long, text binary")
    return dealt.repartitionById(max(full) + 1, "part").sortWithinPartitions("part", "tail", "at", "h").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _cuts(rows: DataFrame, parts: int) -> list[tuple[int, int]]:
    """(at, h) that cut the table into about equal ranges: parts of them, more where the texts ask for it; an id that fills several is cut by h."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(parts, -(-size // RANGE_BYTES))
    got = rows.select(F.percentile_approx("at", [k / parts for k in range(1, parts)], 4 * parts).alias("q")).first()["q"] or []
    return [(v, LOWEST + (k << 64) // n) for v, n in sorted(Counter(got).items()) for k in range(n)]
