"""Near copies by their shared word shingles: SimHash anchors and bands of minima propose pairs, the shingles themselves decide.

Texts that share 0.8 of their five-word shingles differ in some ten of 64 bits, and no covering code of fitting size brings pairs
together at that distance: the anchors find the nearer copies, bands of the one-permutation sketch the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from . import oph, simhash
from .common import as_bytes, by_size, mix, placed, released, text_of, tuned, word_shingles, written
from .components import connected

#: A pair is proposed if all ROWS minima of one of BANDS bands are equal: at similarity 0.8 that fails for all bands with chance
#: (1 - 0.8 ** 4) ** 28, 4 in ten million pairs, and less above. The sketch has BINS minima in all, kept to four bits.
BANDS, ROWS, BINS = 28, 4, 512
#: Pairs whose sketches agree in less than least minus SLACK are not compared by their shingles: four standard deviations (0.0184)
#: of a sketch's estimate at similarity 0.8, so that 3 in 100,000 pairs of just that similarity are passed over, and fewer above.
SLACK = 0.0736
#: Orders in which a band's texts are compared with the next one each, before all pairs that are still apart.
ORDERS = 3
#: Texts of a band that one task holds on either side, and bytes of sketches that it compares at once.
BLOCK, AT_ONCE = 2_048, 1 << 25


def sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each different shingle of each text, sorted by text; A-Z count as a-z."""
    hashes, owner = word_shingles([t.lower() for t in texts], width)
    by = np.lexsort((hashes, owner))
    hashes, owner = hashes[by], owner[by]
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))) if len(by) else np.zeros(0, bool)
    return hashes[new], owner[new]


def sketch(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(node: one for equal sets of shingles, 0 for none; texts that have shingles; their keys, one a band; sketches; SimHash fingerprints)."""
    node = np.zeros(len(texts), np.uint64)
    hashes, owner = sets(texts, width)
    if not len(owner):
        return node, np.zeros(0, np.int64), np.zeros((0, BANDS), np.uint64), np.zeros((0, BINS), np.uint8), np.zeros(0, np.uint64)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    some = owner[first]
    node[some] = mix(np.add.reduceat(mix(hashes), first))
    low, full = oph.minima(hashes, np.repeat(np.arange(len(some)), np.diff(np.append(first, len(owner)))), len(some), BINS)
    keys = np.zeros((len(some), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        band = k // ROWS
        keys[:, band] = mix(keys[:, band] + low[:, k] + np.uint64(band + 1))
    return node, some, keys, oph.low_bits(low, full, oph.BITS).astype(np.uint8), simhash.from_hashes(mix(hashes), first)


def alike(a: list[bytes], b: list[bytes], width: int, least: float) -> np.ndarray:
    """Whether a[i] and b[i] share least or more of the shingles that either has."""
    (ha, oa), (hb, ob) = sets(a, width), sets(b, width)
    h, o = np.concatenate((ha, hb)), np.concatenate((oa, ob))
    by = np.lexsort((h, o))
    h, o = h[by], o[by]
    both = np.bincount(o[1:][(h[1:] == h[:-1]) & (o[1:] == o[:-1])], minlength=len(a))
    return both / np.maximum(np.bincount(o, minlength=len(a)) - both, 1) >= least


def verified(pairs: DataFrame, docs: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for b in batches:
            left, right = as_bytes(b, "left"), as_bytes(b, "right")
            for i, j in by_size([x + y for x, y in zip(left, right, strict=True)]):
                yield b.select(["a", "b"]).slice(i, j - i).filter(pa.array(alike(left[i:j], right[i:j], width, least)))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts, _ = written(docs.select("node", "text").join(ends, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "proposed-texts")
    rows = pairs.join(texts.select(F.col("node").alias("a"), text_of().alias("left")), "a").join(texts.select(F.col("node").alias("b"), text_of().alias("right")), "b")
    return written(rows.select("a", "b", "left", "right").mapInArrow(run, "a long, b long"), "alike")[0]


def neighbours(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each band's texts with the next one in a few orders by hash: as many as there are members for each order."""
    out = None
    for k in range(ORDERS):
        turn = F.xxhash64("node", F.lit(k))
        # an order is as good within a part of a large band
        part = F.pmod(turn, F.ceil(F.col("n") / BLOCK))
        after = F.lead("node").over(Window.partitionBy("key", "part").orderBy("turn", "node"))
        pairs = members.withColumns({"turn": turn, "part": part}).select(F.col("node").alias("x"), after.alias("y")).filter("y is not null")
        out = pairs if out is None else out.unionAll(pairs)
    return out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def agreeing(members: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of a band's texts in different parts (members has key, node, part) whose sketches agree enough.

    Bands are compared in blocks inside tasks, so that only pairs that pass become rows, each in the first band that both share.
    A band of more than BLOCK texts is dealt over a task for each pair of its blocks.
    """
    whole = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(whole, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "key", "node", "part", F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), (F.col("own") == F.col("other")).alias("alone"))
    rows = rows.join(sketches, "node").select("cell", "key", "node", "part", "side", "alone", "sketch", "bands")
    bits = oph.BITS
    enough = BINS * ((least - SLACK) * (1 - 0.5**bits) + 0.5**bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        held: list[pa.RecordBatch] = []

        def compared() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            node, part, side = (t.column(c).to_numpy() for c in ("node", "part", "side"))
            s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(node), BINS)
            bands, key = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), BANDS), t.column("key")[0].as_py()
            alone = t.column("alone")[0].as_py()
            left, right = (np.arange(len(node)),) * 2 if alone else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            step = max(1, AT_ONCE // (BINS * max(1, len(right))))
            for at in range(0, len(left), step):
                x = left[at : at + step]
                apart = part[x][:, None] != part[right][None]
                i, j = np.nonzero(apart & (x[:, None] < right[None]) if alone else apart)  # each pair of a block once
                for lo in range(0, len(i), AT_ONCE // BINS):
                    a, b = x[i[lo : lo + AT_ONCE // BINS]], right[j[lo : lo + AT_ONCE // BINS]]
                    near = (s[a] == s[b]).sum(1) >= enough
                    a, b = a[near], b[near]
                    near = bands[a, (bands[a] == bands[b]).argmax(1)] == key
                    a, b = node[a[near]], node[b[near]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for b in batches:
            cell = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo < hi:
                    if held and held[0].column(0)[0].as_py() != cell[lo]:
                        yield from compared()
                        held.clear()
                    held.append(b.slice(lo, hi - lo))
        if held:
            yield from compared()

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of df and component: one number for all texts that links join, a link being least or more of shared shingles.

    Texts with equal sets of shingles are one node before anything is compared; texts without words are one, too. Fingerprints
    within three bits, and each band's texts with a few others of it, are compared first, which joins large groups of near copies
    at a cost that grows with their texts; then all pairs of a band that this has left apart, first by their sketches.

    Null texts are empty; rows that repeat are one node; an empty table gives no rows; other columns are kept, whatever their names.
    """
    tuned(df.sparkSession)
    plain = placed(df, "text")
    kinds = StructType([*plain.schema.fields, StructField("node", LongType()), StructField("bands", ArrayType(LongType())), StructField("sketch", BinaryType()), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for b in batches:
            texts = as_bytes(b)
            for i, j in by_size(texts):
                node, some, keys, sketches, fps = sketch(texts[i:j], width)
                size, data, fp = np.zeros(j - i + 1, np.int32), [None] * (j - i), [None] * (j - i)
                size[some + 1] = BANDS
                for k, row, f in zip(some.tolist(), sketches, fps.view(np.int64).tolist(), strict=True):
                    data[k], fp[k] = row.tobytes(), f
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(node.view(np.int64)), bands, pa.array(data, pa.binary()), pa.array(fp, pa.int64())], [*b.schema.names, "node", "bands", "sketch", "fp"])

    docs, _ = written(plain.mapInArrow(run, kinds), "shingled")
    nodes, _ = written(docs.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("fp").alias("fp")), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    members, _ = written(keys.join(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key"), "members")
    prints = nodes.filter("fp is not null").groupBy("fp").agg(F.min("node").alias("least"))
    prints, _ = written(prints, "prints")
    far = simhash.links(prints.select("fp"))
    named = prints.select(F.col("fp").alias("a"), F.col("least").alias("x")).join(far, "a").join(prints.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b").select("x", "y")
    same = nodes.join(prints, "fp").filter("node <> least").select(F.col("node").alias("x"), F.col("least").alias("y"))
    first = named.unionAll(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs, _ = written(first.unionAll(neighbours(members)).distinct(), "pairs")
    links = verified(pairs, docs, width, least)
    parts, _ = written(members.select("key", "node").join(connected(links), "node", "left").select("key", "node", F.coalesce("component", "node").alias("part")), "parts")
    rest, _ = written(agreeing(parts, nodes.select("node", "sketch", "bands"), least).join(pairs, ["a", "b"], "left_anti"), "rest")
    links = links.unionByName(verified(rest, docs, width, least))
    out = docs.drop("bands", "sketch", "fp").join(connected(links), "node", "left")
    return out.select(*plain.columns, F.coalesce("component", "node").alias("component")).toDF(*df.columns, "component")
