"""Near copies of embeddings: inverted lists with product-quantised residuals, and an exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tuned, written
from .components import connected, local_labels

#: Vectors that the index is fitted on (the smallest hashes); every vector is indexed.
SAMPLE = 16_384
#: Vectors of a list that one task holds; longer lists are dealt over several.
LIST_ROWS = 4_096
#: Share of trial pairs, whose cosine is just the threshold, that probing must bring together, from either side; trial pairs of each
#: kind, and the fewest real pairs of the sample that count as a kind. A pair that is nearer is found more surely. With as many
#: probes as there are lists the search is exact: probes=lists, or lists=1.
COVERED, TRIALS, FEWEST = 0.9995, 4_096, 50
#: Pairs whose cosine a task computes at once.
PAIRS = 1 << 17


@dataclass
class Index:
    coarse: np.ndarray  # lists x dim
    books: np.ndarray  # parts x codes x (dim / parts)
    width: int  # of a part

    def residual_codes(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of each vector's residual, and the distance from the vector to what its codes stand for."""
        r = x - self.coarse[at]
        codes, back = np.zeros((len(x), len(self.books)), np.uint8), np.zeros_like(r)
        for m, book in enumerate(self.books):
            part = r[:, m * self.width : (m + 1) * self.width]
            codes[:, m] = squared(part, book).argmin(1)
            back[:, m * self.width : (m + 1) * self.width] = book[codes[:, m]]
        return codes, np.sqrt(((r - back) ** 2).sum(1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = squared(x, c).argmin(1)
        size = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[size > 0] = total[size > 0] / size[size > 0][:, None]
    return c


def fit(sample: np.ndarray, lists: int, parts: int = 8, codes: int = 256, seed: int = 42) -> Index:
    """An index fitted on unit vectors; the dimension is padded with zeros to a multiple of parts."""
    coarse = k_means(sample, min(lists, len(sample)), 8, seed)
    r = sample - coarse[squared(sample, coarse).argmin(1)]
    width = sample.shape[1] // parts
    books = np.zeros((parts, min(codes, len(sample)), width))
    for m in range(parts):
        books[m] = k_means(r[:, m * width : (m + 1) * width], books.shape[1], 6, seed + m)
    return Index(coarse, books, width)


def units(raw: np.ndarray, parts: int = 8) -> np.ndarray:
    """Unit vectors in double precision, padded to a multiple of parts."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def gaps(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(home list of each vector, how far it lies from the border between its cell and each list's; 0 for its own)."""
    d = squared(x, index.coarse)
    home = d.argmin(1)
    own = index.coarse[home]
    between = np.sqrt(squared(own, index.coarse))
    gap = np.maximum(d - d[np.arange(len(x)), home][:, None], 0) / np.maximum(2 * between, 1e-12)
    gap[np.arange(len(x)), home] = -1.0
    return home, gap


def cells(x: np.ndarray, index: Index, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(home list of each vector, its limit, rows, lists): the lists whose border lies within the limit, probes of them besides its own.

    The limit lies half way to the next list, so that whoever asks again gets the same answer.
    """
    home, gap = gaps(x, index)
    if probes >= len(index.coarse) - 1:
        limit = np.full(len(x), np.inf)
    else:
        low = np.partition(gap, [probes, probes + 1], axis=1)
        limit = (low[:, probes] + low[:, probes + 1]) / 2
    rows, lists = np.nonzero(gap <= limit[:, None] + 1e-9)
    return home, limit, rows, lists


def trial_pairs(sample: np.ndarray, least: float, dim: int, seed: int = 42) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of vectors as near as links may just be: in any direction, in the directions in which the sample spreads, and its own pairs."""
    rng = np.random.default_rng(seed)
    x = sample[rng.integers(0, len(sample), TRIALS)]
    kinds = []
    for off in (np.pad(rng.normal(size=(TRIALS, dim)), ((0, 0), (0, sample.shape[1] - dim))), sample[rng.integers(0, len(sample), TRIALS)] - sample[rng.integers(0, len(sample), TRIALS)]):
        off = off - (off * x).sum(1, keepdims=True) * x
        size = np.sqrt((off * off).sum(1))
        some = size > 1e-9
        kinds.append((x[some], least * x[some] + np.sqrt(1 - least * least) * off[some] / size[some][:, None]))
    found = []
    for i in range(0, len(sample), 512):
        a, b = np.nonzero(sample[i : i + 512] @ sample.T >= least)
        found.append(np.stack([a + i, b])[:, a + i < b])
    a, b = np.concatenate(found, axis=1)
    if len(a) >= FEWEST:
        pick = rng.integers(0, len(a), TRIALS)
        kinds.append((sample[a[pick]], sample[b[pick]]))
    return [k for k in kinds if len(k[0])]


def probes_for(sample: np.ndarray, index: Index, least: float, dim: int) -> int:
    """Lists to probe besides a vector's own, so that COVERED of each kind of trial pairs meet from one side or the other."""
    need = 1
    if len(index.coarse) < 3 or least <= 0:
        return len(index.coarse)
    for x, y in trial_pairs(sample, least, dim):
        ranks = []
        for i in range(0, len(x), 256):
            (hx, gx), (hy, gy) = gaps(x[i : i + 256], index), gaps(y[i : i + 256], index)
            at = np.arange(len(hx))
            ranks.append(np.minimum((gx < gx[at, hy][:, None]).sum(1), (gy < gy[at, hx][:, None]).sum(1)))
        need = max(need, int(np.ceil(np.quantile(np.concatenate(ranks), COVERED))))
    return need


def near_duplicates(df: DataFrame, least: float = 0.9, lists: int | None = None, probes: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector: links are pairs with a cosine of least or more.

    Equal vectors become one row with a count before anything is compared. Each vector has one home list and visits
    the lists whose borders lie nearest, as many as trial pairs ask for (see COVERED); a link found from one side counts for both its ends. In a list, table
    look-ups give each pair's approximate distance; only pairs that this distance and the home vector's own
    quantisation error can't rule out are reranked by the exact cosine. Long lists are dealt over several
    tasks. A task returns counts and links enough to join its vectors, never all pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do those whose vec_id is
    null. Vectors of different lengths never link; each length has an index of its own. Rows that repeat a vec_id count as one node; equal
    vectors link with each other. An empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    tuned(spark)
    v = F.col("embedding").cast("array<double>")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    good = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False)) & F.coalesce(F.exists("v", lambda e: e != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(good, F.col("v")))
    lengths = [r["n"] for r in rows.filter("v is not null").select(F.size("v").alias("n")).distinct().orderBy("n").collect()]  # of which a table has few
    parts = [of_length(rows.filter(F.size("v") == n), n, least, lists, probes) for n in lengths]
    out = rows.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for part in parts:
        out = out.unionByName(part)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def of_length(rows: DataFrame, length: int, least: float, lists: int | None, probes: int | None) -> DataFrame:
    """(vec_id, n_links, component_id) of rows (vec_id, v) whose vectors are good and of one length."""
    spark = rows.sparkSession
    distinct, _ = written(rows.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    fitted = units(np.array(sample.column("v").to_pylist()))
    index = fit(fitted, lists or int(min(16_384, max(1, 2 * n**0.5))))
    radius = float(np.sqrt(2 - 2 * least))
    near = probes if probes is not None else probes_for(fitted, index, least, length)
    shared = spark.sparkContext.broadcast(index)  # lists x dim and parts x codes numbers: bounded whatever the input

    def packed(b: pa.RecordBatch) -> np.ndarray:
        flat = b.column(0)
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(squared(units(packed(b)), shared.value.coarse).argmin(1).astype(np.int32))], ["list"])

    counts = distinct.select("v").mapInArrow(homes, "list int").groupBy("list").count().collect()  # a row a list
    deals = {r["list"]: -(-r["count"] // LIST_ROWS) for r in counts}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = np.array([deals.get(c, 0) for c in range(len(shared.value.coarse))])
        for b in batches:
            if not b.num_rows:
                continue
            raw, ids, copies = packed(b), b.column(1).to_numpy(), b.column(2).to_numpy()
            home, limit, row, cell = cells(units(raw), shared.value, near)
            times = deal[cell]  # lists that are nobody's home have no task
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            own = (ids % deal[home]).astype(np.int64)
            row, cell, part = (np.concatenate(p) for p in ((np.arange(len(raw)), row), (home, cell), (own, part)))
            role = (np.arange(len(row)) >= len(raw)).astype(np.int8)  # 0: lives here, 1: visits
            vectors = [raw[i].tobytes() for i in range(len(raw))]
            for at in range(0, len(row), 4096):
                s = slice(at, at + 4096)
                yield pa.RecordBatch.from_arrays([pa.array(cell[s].astype(np.int32)), pa.array(part[s].astype(np.int32)), pa.array(role[s]), pa.array(ids[row[s]]), pa.array(copies[row[s]]), pa.array([vectors[i] for i in row[s]], pa.binary()), pa.array(home[row[s]].astype(np.int32)), pa.array(limit[row[s]])], ["list", "part", "role", "id", "copies", "v", "home", "limit"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, at, held, home = shared.value, None, [], None
        for b in batches:
            where = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            lo = 0
            while lo < len(where):
                hi = lo + 1
                while hi < len(where) and where[hi] == where[lo]:
                    hi += 1
                cell, part, role = where[lo]
                piece = b.slice(lo, hi - lo)
                if (cell, part) != at:
                    at, held, home = (cell, part), [], None
                x = (units(matrix(piece.column(5))), piece.column(3).to_numpy(), piece.column(4).to_numpy(), piece.column(6).to_numpy(), piece.column(7).to_numpy())
                if role == 0:
                    held.append(x)
                elif held:
                    if home is None:
                        hx, hid, hn, _, reach = (np.concatenate(c) for c in zip(*held, strict=True))
                        home = hx, hid, hn, reach, *index.residual_codes(hx, np.full(len(hx), cell))
                    yield links(index, cell, home, x)
                lo = hi

    def visits(index: Index, hx: np.ndarray, reach: np.ndarray, cell: int, h: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Whether the vectors hx[h], which live in cell and have these limits, visit the lists to: the rule of cells."""
        out = np.zeros(len(h), bool)
        own = index.coarse[cell]
        for k in range(0, len(h), PAIRS // 4):
            x, c = hx[h[k : k + PAIRS // 4]], index.coarse[to[k : k + PAIRS // 4]]
            gap = (((x - c) ** 2).sum(1) - ((x - own) ** 2).sum(1)) / np.maximum(2 * np.sqrt(((c - own) ** 2).sum(1)), 1e-12)
            out[k : k + PAIRS // 4] = (np.maximum(gap, 0) <= reach[h[k : k + PAIRS // 4]] + 1e-9) | (to[k : k + PAIRS // 4] == cell)
        return out

    def links(index: Index, cell: int, home: tuple, visit: tuple) -> pa.RecordBatch:
        (hx, hid, hn, reach, codes, error), (x, ids, copies, lives, _) = home, visit
        kinds, a, b = [], [], []
        step = max(1, PAIRS // len(hx))
        q = x - index.coarse[cell]
        total, back = np.zeros(len(x), np.int64), np.zeros(len(hx), np.int64)
        for s in range(0, len(x), step):
            part = q[s : s + step]
            near = np.zeros((len(part), len(hx)))
            for m, book in enumerate(index.books):
                near += squared(part[:, m * index.width : (m + 1) * index.width], book)[:, codes[:, m]]
            v, h = np.nonzero(np.sqrt(near) <= radius + error[None] + 1e-6)
            v += s
            keep = ids[v] != hid[h]
            v, h = v[keep], h[keep]
            exact = np.concatenate([np.einsum("ij,ij->i", x[v[k : k + PAIRS // 4]], hx[h[k : k + PAIRS // 4]]) for k in range(0, len(v), PAIRS // 4)] or [np.zeros(0)])
            v, h = v[exact >= least], h[exact >= least]
            np.add.at(total, v, hn[h])
            alone = ~visits(index, hx, reach, cell, h, lives[v])  # the other side does not find the pair, so it is counted here for both
            np.add.at(back, h[alone], copies[v[alone]])
            if len(v):
                nodes, inverse = np.unique(np.concatenate((ids[v], hid[h])), return_inverse=True)
                label = local_labels(inverse[: len(v)], inverse[len(v) :], len(nodes))
                moved = label != np.arange(len(nodes))
                kinds.append(np.ones(int(moved.sum()), np.int8))
                a.append(nodes[moved])
                b.append(nodes[label[moved]])
        for who, count in ((ids, total), (hid, back)):
            some = count > 0
            kinds.append(np.zeros(int(some.sum()), np.int8))
            a.append(who[some])
            b.append(count[some])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds)), pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["kind", "a", "b"])

    placed = distinct.select("v", "id", "copies").mapInArrow(spread, "list int, part int, role byte, id long, copies long, v binary, home int, limit double")
    found, _ = written(placed.repartition("list", "part").sortWithinPartitions("list", "part", "role").mapInArrow(compare, "kind byte, a long, b long"), "found")
    degree = found.filter("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("others"))
    comp = connected(found.filter("kind = 1").select("a", "b"))
    per = distinct.join(degree, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    per = per.select("v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("root"))
    return rows.join(per, "v").select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("root").alias("component_id"))
