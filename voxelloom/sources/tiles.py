"""Readers: slices, tile layouts, tile results, quality tables."""

from __future__ import annotations

import logging
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..storage import exists, importable, listed

LOG = logging.getLogger("voxelloom")


def slices(spark: SparkSession, root: str, pattern: str = "*.tiff*") -> DataFrame:
    """(tile_name, stem, z, path, content) of every slice below root; z counts a tile's slices by path, unreadable ones too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    named = files.select("path", "content", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("tile_name"), F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"))
    places = named.select("path", "tile_name").withColumn("z", F.row_number().over(Window.partitionBy("tile_name").orderBy("path")))
    return named.join(places.select("path", "z"), "path")


#: Files of the second channel: either ending in any case; names that begin with a dot are passed over by Spark.
SECOND = "*.{[tT][iI][fF],[tT][iI][fF][fF]}"


def second_channel(spark: SparkSession, root: str, pattern: str = SECOND) -> DataFrame | None:
    """(tile_name, stem, content) of the second channel's slices, which pair_channels joins by tile and stem; None without the folder.

    pattern "*" takes files of any ending.
    """
    if not root or not exists(spark, root):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("tile_name"), F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"), "content")


def leaf_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(name, path) of every folder at or below root that holds no folder, by name: tiles, of which there are few, with or without slices."""
    out, open_ = [], [root.rstrip("/")]
    while open_:
        at = open_.pop()
        below = [p for p, is_folder, _, _ in listed(spark, at) if is_folder]
        open_ += below
        if not below and exists(spark, at):
            out.append((at.rsplit("/", 1)[1], at))
    return sorted(out)


def check_paths(spark: SparkSession, first: str | None, second: str | None) -> None:
    """An error if the first channel isn't there; a warning if the second isn't: then there is one channel alone."""
    if not first or not exists(spark, first):
        raise FileNotFoundError(f"no first channel at {first}")
    if not second or not exists(spark, second):
        LOG.warning("no second channel at %s: one channel alone", second)


def tiles(spark: SparkSession, root: str, pattern: str = "*.tiff*") -> DataFrame:
    """(tile_name, slices) of the folders that hold slices."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    return files.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("tile_name")).agg(F.count(F.lit(1)).alias("slices"))


def pair_channels(first: DataFrame, second: DataFrame) -> DataFrame:
    """The second channel's content beside the first's, null where it is missing: by tile and stem."""
    return first.join(second.select("tile_name", "stem", F.col("content").alias("content_2")), ["tile_name", "stem"], "left")


def unpack_runs(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """Codes of nine to twelve bits, the highest bit first; 256 clears the table and 257 ends."""
    table, out, width, last = [], [], 9, b""
    held = bits = 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


#: A TIFF's numbers of compression.
UNPACK = {1: bytes, 5: unpack_lzw, 8: zlib.decompress, 32773: unpack_runs, 32946: zlib.decompress}


def decode_tiff(data: bytes) -> np.ndarray | None:
    """The first plane of an 8- or 16-bit TIFF in strips, plain or packed by runs, LZW or deflate; None if it is anything else."""
    try:
        order = {b"II": "<", b"MM": ">"}[data[:2]]
        if struct.unpack(order + "H", data[2:4])[0] != 42:
            return None
        at = struct.unpack(order + "I", data[4:8])[0]
        tags: dict[int, list[int]] = {}
        for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
            tag, kind, n = struct.unpack(order + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
            size, code = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}.get(kind, (0, ""))
            if not size:
                continue
            where = at + 10 + 12 * i if n * size <= 4 else struct.unpack(order + "I", data[at + 10 + 12 * i : at + 14 + 12 * i])[0]
            tags[tag] = list(struct.unpack(order + code * n, data[where : where + n * size]))
        width, height, bits = tags[256][0], tags[257][0], tags.get(258, [1])[0]
        samples = tags.get(277, [1])[0]
        unpack = UNPACK.get(tags.get(259, [1])[0])
        if unpack is None or bits not in (8, 16):
            return None
        raw = b"".join(unpack(data[o : o + n]) for o, n in zip(tags[273], tags[279], strict=True))
        image = np.frombuffer(raw, f"{order}u{bits // 8}")[: width * height * samples]
        image = image.reshape(height, width, samples)[:, :, 0].astype(f"<u{bits // 8}")
        return np.cumsum(image, axis=1, dtype=image.dtype) if tags.get(317, [1])[0] == 2 else image
    except (KeyError, IndexError, ValueError, struct.error, zlib.error):
        return None


def encode_tiff(image: np.ndarray) -> bytes:
    """An image of one plane as an uncompressed TIFF of one strip."""
    raw = np.ascontiguousarray(image).astype(f"<u{image.dtype.itemsize}").tobytes()
    tags = [(256, image.shape[1]), (257, image.shape[0]), (258, 8 * image.dtype.itemsize), (259, 1), (262, 1), (273, 8), (277, 1), (278, image.shape[0]), (279, len(raw))]
    return b"II*\0" + struct.pack("<I", 8 + len(raw)) + raw + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"


def decoded(df: DataFrame, content: str = "content") -> DataFrame:
    """df's tile_name, stem and z with height, width, bits and data; an unreadable slice has nulls, and keeps its z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            images = [decode_tiff(c) if c is not None else None for c in b.column(3).to_pylist()]
            fields = [[None if i is None else f(i) for i in images] for f in (lambda i: i.shape[0], lambda i: i.shape[1], lambda i: 8 * i.dtype.itemsize, lambda i: i.tobytes())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(f, k) for f, k in zip(fields, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)]], ["tile_name", "stem", "z", "height", "width", "bits", "data"])

    importable(df.sparkSession)
    return df.select("tile_name", "stem", F.col("z").cast("int").alias("z"), content).mapInArrow(run, "tile_name string, stem string, z int, height int, width int, bits int, data binary")


def layout_path(spark: SparkSession, folder: str) -> str:
    """The merging layout if it is there, else the import layout."""
    for name in ("xml_merging.xml", "xml_import.xml"):
        if exists(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"no tile layout in {folder}")


def layout(spark: SparkSession, path: str) -> DataFrame:
    """A row for each stack of a layout file; tile_no counts them by row and column."""
    attrs = "_ROW bigint, _COL bigint, _ABS_H bigint, _ABS_V bigint, _ABS_D bigint, _DIR_NAME string"
    rows = spark.read.format("xml").option("rowTag", "Stack").schema(attrs).load(path)
    return rows.select(F.col("_ROW").alias("row"), F.col("_COL").alias("col"), F.col("_ABS_H").alias("abs_x"), F.col("_ABS_V").alias("abs_y"), F.col("_ABS_D").alias("abs_z"), F.element_at(F.split("_DIR_NAME", r"[/\\]"), -1).alias("tile_name")).withColumn("tile_no", (F.row_number().over(Window.partitionBy().orderBy("row", "col")) - 1).cast("bigint"))  # a row a tile


def layout_size(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "dimensions").schema("_stack_rows bigint, _stack_columns bigint, _stack_slices bigint").load(path).select(F.col("_stack_rows").alias("rows"), F.col("_stack_columns").alias("cols"), F.col("_stack_slices").alias("slices"))


def tile_results(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Header-less result files with | as quote; tolerant drops rows that don't parse. z is cut to a whole number."""
    df = spark.read.schema(schemas.TILE_RESULT).option("quote", "|").csv(path)
    if tolerant:
        df = df.dropna(subset=["x1", "y1", "x2", "y2", "class_name", "score", "z"])
    return df.withColumn("z", F.col("z").cast("bigint"))


def single_tile(spark: SparkSession, folder: str) -> DataFrame:
    """The first result file of a folder by name, rows that don't parse left out: a tile by itself needs no layout. No rows without a file."""
    found = [p for p, is_folder, _, _ in listed(spark, folder) if not is_folder and p.endswith("_result.csv")]
    return tile_results(spark, found[0], tolerant=True) if found else spark.createDataFrame([], schemas.TILE_RESULT).withColumn("z", F.col("z").cast("bigint"))


def cached_detections(spark: SparkSession, path: str) -> DataFrame:
    """(z, boxes: x1, y1, x2, y2, score, class_name in a row's order of place) of earlier results, for quality alone; bad rows are left out."""
    box = F.struct("x1", "y1", "x2", "y2", "score", "class_name")
    return tile_results(spark, path, tolerant=True).filter("z is not null").groupBy("z").agg(F.array_sort(F.collect_list(box)).alias("boxes"))


def global_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Linked boxes as report.write_boxes leaves them."""
    return spark.read.schema(schemas.GLOBAL_BOX).option("header", True).csv(path)


def tile_qc(spark: SparkSession, path: str) -> DataFrame:
    """Quality tables of tiles; the tile is the file's stem, and unreadable files are passed over."""
    df = spark.read.option("header", True).option("ignoreCorruptFiles", True).schema(schemas.TILE_QC).csv(f"{path}/*_qc_metrics.csv")
    return df.withColumn("tile_no", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_qc_metrics\.csv$", 1))
