"""Repeated byte windows: a depth-limited most-significant-digit radix order of all suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import Rolling, as_bytes, by_size, id_of, mix, placed, released, text_of, tuned, written

#: A repeat has this many bytes; the first digit is a string of GRAM bytes inside it.
LENGTH, GRAM = 100, 32
#: Bytes of text for each bucket: what a task holds of a bucket is a few times that, however large the input.
BUCKET_BYTES = 128 << 20
#: Digits that a task gathers before it deals them out, and windows that a bucket orders at once.
GATHER, ORDER = 300_000, 1 << 21
#: Runs of a first digit beyond which they are dealt out by half of the window's other bytes, too.
CROWD = 20_000
#: Bits of the first digit's hash that are sent besides its bucket. It only groups: bytes alone decide what is equal.
DIGIT_BITS = np.uint64(40)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(data[:4], "little")
    out = []
    for kind, n in (x.split(",") for x in data[4:at].decode().split(";")):
        out.append(np.frombuffer(data, np.dtype(kind), int(n), at))
        at += out[-1].nbytes
    return out


def narrow(x: np.ndarray, bits: np.uint64) -> np.ndarray:
    """The low bytes of 64-bit integers, as a flat array of bytes."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : int(bits) // 8].ravel()


def widen(x: np.ndarray, bits: np.uint64) -> np.ndarray:
    out = np.zeros((len(x) * 8 // int(bits), 8), np.uint8)
    out[:, : int(bits) // 8] = x.reshape(len(out), -1)
    return out.view("<u8").ravel()


def digits(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, start, windows, offset, digit, context, place) of each run of windows that share their first digit's place.

    The digit of a window is its GRAM-byte string with the smallest hash, the leftmost of equals; equal windows have it at
    equal places. Windows that start one after the other and have the same digit in place are one run: they start at start,
    the digit lies offset bytes behind that, and context is the hash of all their bytes, which begin at place of all texts joined.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    hashes = Rolling(data)
    value = hashes.windows(gram)
    grams = np.append(value, np.uint64(0))[: len(value)]
    place = np.arange(len(value), dtype=np.int32)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        less = value[span:] < value[:-span]
        place = np.where(less, place[span:], place[:-span])
        value = np.minimum(value[span:], value[:-span])
        span *= 2
    if span < width:
        more = width - span
        less = value[more:] < value[:-more]
        place = np.where(less, place[more:], place[:-more])
    start = np.arange(len(place))
    text = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    inside = np.flatnonzero(start + length <= ends[text])
    place = place[inside].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(inside) else none
    windows = np.diff(np.append(new, len(inside)))
    first, place = inside[new], place[new]
    owner = text[first]
    return owner, first - (ends - sizes)[owner], windows, place - first, grams[place], hashes.of(first, first + windows + length - 1), first


def firsts(keys: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are the first of their key by order, the rest, the first row of each of the rest).

    Rows equal to the first in all of order are that one repeated, and in neither.
    """
    by = np.lexsort((*reversed(order), keys))
    lead = np.concatenate(([True], keys[by][1:] != keys[by][:-1])) if len(by) else np.zeros(0, bool)
    first, rest = by[lead][np.cumsum(lead)[~lead] - 1], by[~lead]
    other = np.any([o[rest] != o[first] for o in order], axis=0)
    return by[lead], rest[other], first[other]


def radix(groups: np.ndarray, at: np.ndarray, data: np.ndarray, length: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, classes) of the strings data[at : at + length] that equal another of their group; a group's strings have one length.

    Passes go from the first eight bytes to the last; a string whose class has no other leaves at once.
    """
    size = np.broadcast_to(length, len(at))
    rows, classes = np.arange(len(at)), np.unique(groups, return_inverse=True)[1]
    eight = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    base = 0  # classes of other passes stay apart
    for depth in range(0, int(size.max(initial=0)) + 8, 8):
        many = np.bincount(classes)[classes] > 1
        rows, classes = rows[many], classes[many]
        left = size[rows] - depth
        ended = left <= 0
        out.append((rows[ended], classes[ended].astype(np.int64) + base))
        base += int(classes.max(initial=0)) + 1
        rows, classes, left = rows[~ended], classes[~ended], left[~ended]
        if not len(rows):
            break
        digit = eight[at[rows] + depth].copy().view(">u8").ravel().astype(np.uint64)
        digit >>= (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        by = np.lexsort((digit, classes))
        c, d = classes[by], digit[by]
        rows, classes = rows[by], np.cumsum(np.concatenate(([True], (c[1:] != c[:-1]) | (d[1:] != d[:-1])))) - 1
    return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])


def keyed(df: DataFrame, others: bool = False) -> DataFrame:
    """(key, doc_id, text, and the other columns as c0, c1, ... if wanted): key orders the documents as doc_id does and is one for each different row.

    It is doc_id itself, null as the smallest number, unless an id repeats; then rows are ranked by id and a hash of the text.
    """
    rows = placed(df, "doc_id", "text")
    extra = [c for c in rows.columns if c not in ("doc_id", "text")] if others else []
    rows = rows.select(id_of().alias("doc_id"), text_of().alias("text"), *extra).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    if not rows.groupBy("key").count().filter("count > 1").limit(1).count():
        return rows.select("key", "doc_id", "text", *extra)
    rows = rows.withColumn("tie", F.xxhash64("text"))
    each, _ = written(rows.select("key", "tie").distinct().repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "tie").withColumn("part", F.spark_partition_id()), "keys")
    sizes = {r["part"]: r["count"] for r in each.groupBy("part").count().collect()}
    bases = np.cumsum([0, *[sizes.get(p, 0) for p in range(max(sizes) + 1)]])
    ranks = each.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("key", "tie")) + F.get(F.lit(bases.tolist()), F.col("part"))).select("key", "tie", F.col("rank").cast("long").alias("rank"))
    return rows.join(ranks, ["key", "tie"]).select(F.col("rank").alias("key"), "doc_id", "text", *extra)


def texts_by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, kind 0, data): the texts, packed and compressed for the bucket of their key; the other columns go along as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            texts = [t for b in held for t in as_bytes(b)]
            table = pa.Table.from_batches(held)
            held.clear()
            k, ids = table.column(0).to_numpy(), table.column(1)
            known, ids = ids.is_valid().to_numpy(), ids.fill_null(0).to_numpy()
            to = (mix(k.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(to).tolist():
                mine = np.flatnonzero(to == b)
                data, sink = [texts[i] for i in mine], pa.BufferOutputStream()
                if table.num_columns > 3:
                    part = table.select(range(3, table.num_columns)).take(mine)
                    with pa.ipc.new_stream(sink, part.schema) as stream:
                        stream.write_table(part)
                packed = pack(k[mine], ids[mine], known[mine], np.array([*map(len, data)], np.int32), np.frombuffer(b"".join(data), np.uint8), np.frombuffer(sink.getvalue(), np.uint8))
                yield batch([(b, 0, packed)])

        size = 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size > 16 << 20:
                yield from dealt()
                size = 0
        if held:
            yield from dealt()

    return rows.mapInArrow(run, SCHEMA)


def by_key(keys: np.ndarray, buckets: int, kind: int, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Rows of columns packed for the bucket of their key."""
    to = (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((columns[0], keys, to))
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    return [(int(to[part[0]]), kind, pack(keys[part], *[c[part] for c in columns])) for part in np.split(order, cuts)] if len(order) else []


def merged(keys: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same window starts in fewer ranges: those of a key that follow each other or overlap become one."""
    if not len(keys):
        return keys, start, windows
    by = np.lexsort((start, keys))
    k, s, e = keys[by], start[by].astype(np.int64), (start + windows)[by].astype(np.int64)
    # shift each key's ranges beyond those of the key before, so that one running maximum serves all
    number = np.cumsum(np.concatenate(([0], k[1:] != k[:-1])))
    room = int(e.max()) + 2
    reach = np.maximum.accumulate(e + number * room)
    new = np.concatenate(([True], (s + number * room)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k)) - 1
    return k[first], s[first], reach[last] - number[last] * room - s[first]


def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, d = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int8()), pa.array(d, pa.binary())], ["bucket", "kind", "data"])


SCHEMA = "bucket int, kind byte, data binary"


def first_digit(rows: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """The first pass: (bucket, kind, data) for key buckets, kind 1 spans that repeat, 2 runs that need their bytes.

    A task sends only the first run of each context it has; the others, whose bytes it compares with that one's, are spans that
    repeat already, so a string's copies cost its bucket one row a task. In the bucket, the runs that share their digit with
    another go on to the next passes, marked if they are more than CROWD.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        texts: list[bytes] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            key, start, windows, offset, digit, context, at = (np.concatenate(c) for c in zip(*held, strict=True))
            data = b"".join(texts)
            held.clear()
            texts.clear()
            same = mix(digit ^ mix(context + (offset * 256 + windows).astype(np.uint64)))
            one, again, lead = firsts(same, key, start)
            size = windows[again] + length - 1
            is_same = np.fromiter((n == m and data[i : i + n] == data[j : j + n] for i, j, n, m in zip(at[again].tolist(), at[lead].tolist(), size.tolist(), (windows[lead] + length - 1).tolist(), strict=True)), bool, len(again))
            one, again = np.append(one, again[~is_same]), again[is_same]
            k, s, w = merged(key[again], start[again], windows[again])
            out = [(-1 - b, 1, d) for b, _, d in by_key(k, buckets, 1, s.astype(np.int32), w.astype(np.int32))]
            to = (digit[one] >> DIGIT_BITS) % np.uint64(buckets)
            order = np.lexsort((start[one], key[one], to))
            one, to = one[order], to[order]
            for part in np.split(np.arange(len(one)), np.flatnonzero(np.diff(to)) + 1):
                i = one[part]
                if len(i):
                    k = key[i]
                    out.append((int(to[part[0]]), 0, pack(k[:1], np.diff(k), start[i].astype(np.int32), windows[i].astype(np.uint8), offset[i].astype(np.uint8), narrow(digit[i], DIGIT_BITS))))
            for at_ in range(0, len(out), 64):
                yield batch(out[at_ : at_ + 64])

        released()
        n = size = 0
        for b in batches:
            keys, all_ = b.column(0).to_numpy(), as_bytes(b)
            for i, j in by_size(all_):
                owner, *rest, place = digits(all_[i:j], length, gram)
                held.append((keys[i:j][owner], *rest, place + size))
                texts += all_[i:j]
                size += sum(map(len, all_[i:j]))
                n += len(owner)
                if n >= GATHER:
                    yield from dealt()
                    n = size = 0
        if held:
            yield from dealt()

    def resolve(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        if bucket < 0:  # spans that a task has found by itself
            return pa.table({"bucket": pa.array([-1 - bucket] * len(t), pa.int32()), "kind": t.column("kind"), "data": t.column("data")})
        parts = [unpack(d) for d in t.column("data").to_pylist()]
        key = np.concatenate([np.cumsum(np.concatenate((p[0], p[1]))) for p in parts])
        start, windows, offset = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        digit = widen(np.concatenate([p[5] for p in parts]), DIGIT_BITS)
        by = np.lexsort((start, key, digit))
        d, k, s = digit[by], key[by], start[by]
        other = np.concatenate(([True], (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1])))  # not a row repeated whole
        by, d = by[other], d[other]
        number = np.cumsum(np.concatenate(([True], d[1:] != d[:-1]))) - 1
        count = np.bincount(number)[number]
        more, crowded = by[count > 1], (count[count > 1] > CROWD).astype(np.uint8)
        out = by_key(key[more], buckets, 2, start[more], windows[more], offset[more], digit[more], np.full(len(more), bucket, np.int32), crowded)
        return pa.Table.from_batches([batch(out)])

    return rows.select("key", "text").mapInArrow(deal, SCHEMA).groupBy("bucket").applyInArrow(resolve, SCHEMA)


def halves(start: np.ndarray, windows: np.ndarray, offset: np.ndarray, length: int, gram: int) -> list[tuple[np.ndarray, ...]]:
    """(run, start, windows, offset, where the string begins) of both parts of runs whose digit is crowded.

    Every window holds half of the bytes that it may have besides its digit right behind the digit, or right before it: it
    meets its equals by the digit and that half together.
    """
    half = (length - gram) // 2
    skip = np.clip(offset - (length - gram - half), 0, windows)  # windows too early for the half behind the digit
    behind, ahead = np.flatnonzero(skip < windows), np.flatnonzero(skip)
    digit = start + offset
    return [(behind, (start + skip)[behind], (windows - skip)[behind], (offset - skip)[behind], digit[behind]), (ahead, start[ahead], skip[ahead], offset[ahead], digit[ahead] - half)]


def further_digits(texts: DataFrame, runs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """The other passes: the runs' bytes go to the bucket of their digit and are ordered there; spans that repeat come back."""
    from xxhash import xxh64_intdigest

    def fetch(t: pa.Table) -> pa.Table:
        held, wanted = {k: x for k, _, x in texts_of(t)}, [unpack(d) for d, k in zip(t.column("data").to_pylist(), t.column("kind").to_pylist(), strict=True) if k == 2]
        if not wanted:
            return pa.Table.from_batches([batch([])])
        key, start, windows, offset, digit, to, crowded = (np.concatenate(c) for c in zip(*wanted, strict=True))
        start, windows, offset = start.astype(np.int64), windows.astype(np.int64), offset.astype(np.int64)
        if crowded.any():
            plain, hot = np.flatnonzero(crowded == 0), np.flatnonzero(crowded)
            parts = [(key[plain], start[plain], windows[plain], offset[plain], digit[plain], to[plain])]
            reach = gram + (length - gram) // 2
            for side, (run, s, w, o, place) in enumerate(halves(start[hot], windows[hot], offset[hot], length, gram)):
                k = key[hot[run]]
                d = np.array([xxh64_intdigest(held[i][a : a + reach], side) for i, a in zip(k.tolist(), place.tolist(), strict=True)], np.uint64)
                parts.append((k, s, w, o, d, (d % np.uint64(buckets)).astype(np.int32)))
            key, start, windows, offset, digit, to = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((start, key, to))
        out = []
        for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            data = [held[k][s : s + w + length - 1] for k, s, w in zip(key[part].tolist(), start[part].tolist(), windows[part].tolist(), strict=True)]
            out.append((int(to[part[0]]), 2, pack(key[part], start[part].astype(np.int32), windows[part].astype(np.uint8), offset[part].astype(np.uint8), digit[part], np.frombuffer(b"".join(data), np.uint8))))
        return pa.Table.from_batches([batch(out)])

    def order(t: pa.Table) -> pa.Table:
        released()
        parts = [unpack(d) for d in t.column("data").to_pylist()]
        key, start, windows, offset, digit, data = (np.concatenate(c) for c in zip(*parts, strict=True))
        windows, offset, start = windows.astype(np.int64), offset.astype(np.int64), start.astype(np.int64)
        at = np.concatenate(([0], np.cumsum(windows + length - 1)[:-1]))
        # whole runs first: all windows of one that equals an earlier run repeat
        number = np.unique(digit, return_inverse=True)[1]
        rows, classes = radix(number * (1 << 16) + offset * 256 + windows, at, data, windows + length - 1)
        lead, again, _ = firsts(classes, key[rows], start[rows])
        spans = [merged(key[rows[again]], start[rows[again]], windows[rows[again]])]
        first = np.ones(len(key), bool)
        first[rows] = False
        first[rows[lead]] = True  # of each class the first by key and start stays
        by = np.flatnonzero(first)
        by = by[np.argsort(digit[by], kind="stable")]
        alone = np.bincount(number[by], minlength=int(number.max(initial=0)) + 1)[number[by]] == 1
        by = by[~alone]
        total = np.cumsum(windows[by])
        edges = np.append(np.flatnonzero(np.diff(digit[by])) + 1, len(by)) if len(by) else np.zeros(0, np.int64)
        done = 0
        while done < len(by):
            fit = edges[(edges > done) & (total[edges - 1] - (total[done - 1] if done else 0) <= ORDER)]
            end = int(fit[-1]) if len(fit) else int(edges[edges > done][0])
            mine = by[done:end]
            run = np.repeat(mine, windows[mine])
            step = np.arange(len(run)) - np.repeat(np.cumsum(windows[mine]) - windows[mine], windows[mine])
            depth = offset[run] - step  # of the digit inside the window: windows that differ in it are not equal
            for one in [None] if len(fit) else range(int(depth.min()), int(depth.max()) + 1):  # a digit with very many runs: by depth
                pick = slice(None) if one is None else np.flatnonzero(depth == one)
                r, s = run[pick], step[pick]
                rows, classes = radix(number[r] * 256 + depth[pick] + 128, at[r] + s, data, length)
                _, again, _ = firsts(classes, key[r[rows]], start[r[rows]] + s[rows])
                again = rows[again]
                spans.append(merged(key[r[again]], start[r[again]] + s[again], np.ones(len(again), np.int64)))
            done = end
        k, s, w = merged(*(np.concatenate(c) for c in zip(*spans, strict=True)))
        return pa.Table.from_batches([batch(by_key(k, buckets, 1, s.astype(np.int32), w.astype(np.int32)))])

    return texts.unionByName(runs).groupBy("bucket").applyInArrow(fetch, SCHEMA).groupBy("bucket").applyInArrow(order, SCHEMA)


def texts_of(t: pa.Table, others: list[pa.Table] | None = None) -> list[tuple[int, int | None, bytes]]:
    """(key, doc_id, text) of the documents packed in a bucket's rows; tables of their other columns are appended to others."""
    out = []
    for d, k in zip(t.column("data").to_pylist(), t.column("kind").to_pylist(), strict=True):
        if k == 0:
            keys, ids, known, n, data, more = unpack(d)
            data = data.tobytes()
            out += [(key, i if is_known else None, data[e - x : e]) for key, i, is_known, e, x in zip(keys.tolist(), ids.tolist(), known.tolist(), np.cumsum(n).tolist(), n.tolist(), strict=True)]
            if others is not None and len(more):
                others.append(pa.ipc.open_stream(more.tobytes()).read_all())
    return out


def bucket_count(rows: DataFrame, bucket_bytes: int) -> int:
    """Buckets for all texts of rows: as many as shuffle partitions, more where the texts ask for it."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))


def removals(df: DataFrame, length: int = LENGTH, gram: int = GRAM, others: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, kept: the bytes that stay, spans: removed ranges) of each document.

    With others, its other columns follow as c0, c1, ..., and kept is a text: bytes left of a cut character are dropped.

    A byte goes if a string of length bytes that covers it also starts earlier: in a document of smaller doc_id, or earlier
    in the same. Strings are judged on the input, may overlap, and never cross documents. Null texts are empty; texts
    shorter than length lose nothing. Rows equal in doc_id and text are one document and get the same result; of different texts under one id
    the order is that of a hash, and a null id is the smallest. An empty table gives no rows.
    """
    tuned(df.sparkSession)
    buckets = bucket_count(df.select(text_of().alias("text")), bucket_bytes)
    rows = keyed(df, others)
    texts = texts_by_bucket(rows, buckets)
    plain = texts_by_bucket(rows.select("key", "doc_id", "text"), buckets)
    first, _ = written(first_digit(rows, buckets, length, gram), "first-digit", "none")
    spans, runs = first.filter("kind = 1"), first.filter("kind = 2")
    if runs.limit(1).count():
        more, _ = written(further_digits(plain, runs, buckets, length, gram), "further-digits", "none")
        spans = spans.unionByName(more)
    rest = rows.schema.fields[3:]
    schema = StructType([StructField("doc_id", LongType()), StructField("n_bytes", LongType()), StructField("kept", StringType() if others else BinaryType()), StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))), *rest])

    def cut(t: pa.Table) -> pa.Table:
        released()
        found = [unpack(d) for d, k in zip(t.column("data").to_pylist(), t.column("kind").to_pylist(), strict=True) if k == 1]
        gone: dict[int, list[tuple[int, int]]] = {}
        if found:
            k, s, w = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
            k, s, w = merged(k, s, w + length - 1)  # from window starts to covered bytes
            for key, a, n in zip(k.tolist(), s.tolist(), w.tolist(), strict=True):
                gone.setdefault(key, []).append((a, a + n))
        ids, sizes, kept, spans, tables = [], [], [], [], []
        for key, i, text in texts_of(t, tables):
            at, parts = 0, []
            for a, e in gone.get(key, ()):
                parts.append(text[at:a])
                at = e
            ids.append(i)
            sizes.append(len(text))
            kept.append(b"".join([*parts, text[at:]]))
            spans.append([{"start": a, "end": e} for a, e in gone.get(key, ())])
        if others:
            kept = [t.decode("utf-8", "ignore") for t in kept]
        kinds = [pa.int64(), pa.int64(), pa.string() if others else pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        out = pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip((ids, sizes, kept, spans), kinds, strict=True)], ["doc_id", "n_bytes", "kept", "spans"])
        if rest:
            more = pa.concat_tables(tables)  # spans come to texts alone, so there is one at least
            for f in rest:
                out = out.append_column(f.name, more.column(f.name))
        return out

    return texts.unionByName(spans).groupBy("bucket").applyInArrow(cut, schema)


def deduplicated(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without their repeated bytes, in the columns of df; bytes left of a cut character are dropped.

    Every other column comes back as it was, whatever its name and type. Null texts become empty; the rest is as in removals.
    """
    out = removals(df, length, others=True).withColumnRenamed("kept", "text")
    return out.select(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(df.columns)]).toDF(*df.columns)


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document; odd rows as in removals."""
    return removals(df).select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
