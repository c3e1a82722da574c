"""SimHash fingerprints, and their near copies by a covering code of anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, by_size, id_of, released, text_of, tuned, written
from .components import connected, local_labels

#: Pairs of fingerprints that a task compares at once.
PAIRS = 1 << 21
#: Homes of an anchor beyond which its fingerprints are told apart by the bytes of their other half, too.
CROWD = 4_096


def fingerprint_batch(texts: list[bytes], width: int = 3, seed: int = 42) -> np.ndarray:
    """The 64-bit fingerprint of each text: a bit is 1 if set in over half of its shingles' XXH64."""
    from xxhash import xxh64_intdigest as xxh

    hashes: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        words = t.lower().split()  # of bytes: A-Z, and white space of ASCII, alone
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        k = min(width, len(words))
        got = [xxh(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
        hashes += got
        sizes[i] = len(got)
    out = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = from_hashes(np.array(hashes, dtype=np.uint64), np.concatenate(([0], np.cumsum(sizes[some])[:-1])))
    return out


def fingerprints(df: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp: the fingerprint as a signed long) of each document. Null, empty and blank texts have fingerprint zero."""
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for b in batches:
            texts = as_bytes(b)
            parts = [fingerprint_batch(texts[i:j], width, seed) for i, j in by_size(texts)] or [np.zeros(0, np.uint64)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts).view(np.int64))], ["doc_id", "fp"])

    return df.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, fp long")


def from_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The fingerprint of each group of hashes; first holds where the groups begin, none of them empty."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > np.diff(np.append(first, len(hashes)))[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


_MASKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]
_FLIP = np.array([0] + [1 << (p - 1) for p in range(1, 32)], dtype=np.uint64)


def syndrome(words: np.ndarray) -> np.ndarray:
    """0 for a word of the Hamming code of length 31, else the position (from 1) whose flip makes it one."""
    out = np.zeros(len(words), dtype=np.int64)
    for k, m in enumerate(_MASKS):
        out |= (np.bitwise_count(words & m).astype(np.int64) & 1) << k
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, home) for fingerprints that link at 3 or fewer differing bits.

    Two such fingerprints differ by at most one bit in one of their two halves. A half is 31 bits and one
    more. The anchors are the words of the Hamming code of length 31, of covering radius 1, each with either
    value of the further bit. A fingerprint's home is the anchor within the radius of its half; it is also sent
    to every anchor within radius plus one, where the home of any half at one bit's distance must be.
    """
    keys, rows, homes = [], [], []
    n = np.arange(len(fps))
    for half in (0, 1):
        w = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        low, top = w & np.uint64(0x7FFFFFFF), w & np.uint64(0x80000000)
        s = syndrome(low)
        home = low ^ _FLIP[s] | top
        tag = np.uint64(half << 32)
        out = [(home, n, True), (home ^ np.uint64(0x80000000), n, False)]
        for i in range(1, 32):
            j = s ^ i
            use = (j > i) & (s > 0)  # each pair of flips once; the single flip is the home
            out.append((low[use] ^ _FLIP[i] ^ _FLIP[j[use]] | top[use], n[use], False))
        for key, row, is_home in out:
            keys.append(key | tag)
            rows.append(row)
            homes.append(np.full(len(row), is_home))
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.concatenate(homes)


def home_keys(fps: np.ndarray) -> np.ndarray:
    """The keys of both homes of each fingerprint."""
    out = []
    for half in (0, 1):
        w = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        low, top = w & np.uint64(0x7FFFFFFF), w & np.uint64(0x80000000)
        out.append(low ^ _FLIP[syndrome(low)] | top | np.uint64(half << 32))
    return np.concatenate(out).view(np.int64)


def cells(placed: DataFrame, crowded: DataFrame) -> DataFrame:
    """(cell, fp, home) of placed rows (anchor, fp, home): an anchor is one cell, but a crowded one is split, so that many tasks share it.

    Two fingerprints of an anchor that link differ in at most three bits of their other half, so that one of its four bytes is
    the same: a crowded anchor's rows go to the cells of those bytes, and no link is lost. crowded (anchor) is joined as
    Spark finds its size.
    """
    other = F.when(F.col("anchor") < 1 << 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)))
    byte = lambda k: F.shiftright(other, 8 * k).bitwiseAND(F.lit(255)) + (k + 1) * 256
    rows = placed.join(crowded.select("anchor", F.lit(True).alias("split")), "anchor", "left")
    subs = F.when(F.col("split"), F.array(*[byte(k) for k in range(4)])).otherwise(F.array(F.lit(0).cast("long")))
    return rows.select("anchor", "fp", "home", F.explode(subs).alias("sub")).select((F.col("anchor") * 2048 + F.col("sub")).alias("cell"), "fp", "home")


def compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join what an anchor's fingerprints link, at most one for each: rows sorted by key.

    Homes are compared with all rows of their anchor in blocks of bounded size; what a block links is
    reduced to one link for each row before the next.
    """
    links_a: list[np.ndarray] = []
    links_b: list[np.ndarray] = []
    at = np.flatnonzero(home)
    lo, hi = np.searchsorted(key, key[at], "left"), np.searchsorted(key, key[at], "right")
    busy = hi - lo > 1
    at, lo, size = at[busy], lo[busy], (hi - lo)[busy]
    done = 0
    total = np.cumsum(size)
    while done < len(at):
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS)))
        s = size[done:upto]
        for from_, to in [(0, 1)] if s.sum() <= 2 * PAIRS else [(a, a + PAIRS) for a in range(0, int(s[0]), PAIRS)]:
            if to == 1:
                left = np.repeat(at[done:upto], s)
                right = np.arange(len(left)) - np.repeat(np.cumsum(s) - s, s) + np.repeat(lo[done:upto], s)
            else:  # one home with very many rows
                right = np.arange(lo[done] + from_, min(lo[done] + to, lo[done] + s[0]))
                left = np.full(len(right), at[done])
            near = np.bitwise_count(fp[left] ^ fp[right]) <= threshold
            near &= fp[left] != fp[right]
            if near.any():
                a, b = left[near], right[near]
                nodes, inverse = np.unique(np.concatenate((fp[a], fp[b])), return_inverse=True)
                label = local_labels(inverse[: len(a)], inverse[len(a) :], len(nodes))
                moved = label != np.arange(len(nodes))
                links_a.append(nodes[moved])
                links_b.append(nodes[label[moved]])
        done = upto
    none = np.zeros(0, dtype=fp.dtype)
    return (np.concatenate(links_a), np.concatenate(links_b)) if links_a else (none, none)


def links(distinct: DataFrame, threshold: int = 3, crowd: int = CROWD) -> DataFrame:
    """(a, b) fingerprints whose links join all that are within threshold bits: a forest for each block, never all pairs.

    Anchors that are home to more than crowd fingerprints are split over cells.
    """
    if threshold != 3:
        raise ValueError("the anchors are laid for 3 differing bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            key, row, home = anchors(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row]), pa.array(home)], ["anchor", "fp", "home"])

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(home_keys(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))], ["anchor"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, home = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        waiting: list[tuple] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, size
            key, fp, home = (np.concatenate([w[i] for w in waiting]) for i in range(3))
            cut = len(key) if last else int(np.searchsorted(key, key[-1], "left"))  # the last anchor may go on
            if cut:
                a, b = compare(key[:cut], fp[:cut], home[:cut], threshold)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
            waiting, size = [(key[cut:], fp[cut:], home[cut:])], len(key) - cut

        for b in batches:
            waiting.append((b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(zero_copy_only=False)))
            size += b.num_rows
            if size >= 200_000:
                yield from flush(False)
        if waiting:
            yield from flush(True)

    placed = distinct.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")
    count = distinct.select("fp").mapInArrow(homes, "anchor long").groupBy("anchor").count()
    crowded, _ = written(count.filter(F.col("count") > crowd).select("anchor"), "crowded")
    return cells(placed, crowded).repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, threshold: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each document: components of fingerprints within threshold bits.

    Equal fingerprints become one row before anything is compared, so exact copies cost no pairs.
    component_id is the smallest doc_id reachable, the document's own if it links with nothing. Texts that are null,
    empty or blank have fingerprint zero and link as any other. A row whose doc_id is null gets its component's
    id, null if that has none. Rows that repeat a doc_id are linked only as their fingerprints are. An empty table gives
    no rows. Other columns are ignored.
    """
    docs, _ = written(fingerprints(df), "fingerprints")
    distinct, _ = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = connected(links(distinct, threshold))
    comp = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    ids = comp.groupBy("root").agg(F.min("least").alias("component_id"))
    named, _ = written(comp.join(ids, "root").select("fp", "component_id"), "components")
    out = docs.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
