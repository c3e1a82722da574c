"""WARC archives: written as text records, read back by verifying the chain of record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, tuned, written

MAGIC = "WARC/1.1\r\n"
#: Ends every record; the text sink writes it after each row.
GAP = "\r\n\r\n"
#: Revisits that are joined as a broadcast (some 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
RECORDS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of a binary column in base32, by built-in expressions: five hexadecimal digits are four characters."""
    alphabet, hexed = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.sha1(data)
    out = []
    for k in range(8):
        v = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(alphabet, F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, sha1, head) of the pages whose payload, of at least least bytes, a larger page_id has too."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("n")).filter(F.col("n") >= least)
    heads = hashed.groupBy("sha1").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    return hashed.join(heads, "sha1").filter("head is not null and (page_id is null or page_id < head)").select("page_id", "sha1", "head").distinct()


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, record): the record of each page, without the gap that follows it.

    Of pages with equal payloads the one with the largest page_id is the response and the others revisit it; rows tied on
    that id are all responses. A null html is an empty payload, a null url leaves out the target, a null page_id is the smallest.
    """
    found, _ = written(revisits(pages, least), "revisits")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    same = found.select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "head")
    rows = rows.join(same, rows["page_id"].eqNullSafe(F.col("r_id")) & (rows["sha1"] == F.col("r_sha1")), "left")
    is_revisit, eol = F.col("head").isNotNull(), "\r\n"
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{eol}Content-Type: text/html; charset=utf-8{eol}Content-Length: "), size, F.lit(eol + eol))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    block = F.concat(F.col("http"), F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace("url", r"[\r\n]", " ")
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(f"{eol}WARC-Record-ID: "), name(F.col("page_id")), F.lit(f"{eol}WARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit(f"{eol}WARC-Target-URI: "), url), F.lit("")),
        F.lit(f"{eol}WARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload").cast("binary")),
        F.when(is_revisit, F.concat(F.lit(f"{eol}WARC-Refers-To: "), name(F.col("head")), F.lit(f"{eol}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit(f"{eol}Content-Type: application/http; msgtype=response{eol}Content-Length: "), F.octet_length("block").cast("string"), F.lit(eol + eol), F.col("block"),
    )
    return rows.withColumn("http", http).withColumn("block", block).select("page_id", record.alias("record"))


def write_warc(pages: DataFrame, path: str, least: int = 0, per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of the pages at path, any file system that Spark writes; files are committed whole."""
    records(pages, least).select("record").write.option("lineSep", GAP).option("maxRecordsPerFile", per_file).text(path)


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d{1,18})[ \t]*\r?$")


def _header(line: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + name + rb":[ \t]*(.*?)[ \t]*\r?$", line)
    return m[1].decode("utf-8", "replace") if m else None


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what lies between the magic strings of the archives, in splits that tasks share out."""
    return spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


FIELDS = "page_id string, record_type string, refers_to string, target_uri string, payload_bytes long, payload_digest string, declared_digest string"
KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.binary()]
NAMES = ["file", "block", "rel", "total", "found", "page_id", "record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest", "declared_digest", "payload"]


def parse(body: bytes, payloads: bool) -> list:
    """The fields of a record that is whole."""
    head, _, block = body.partition(b"\r\n\r\n")
    size = int(_LENGTH.search(head)[1])
    block = block[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, length = _header(head, b"warc-type"), _LENGTH.search(http)
    declared = (_header(head, b"warc-payload-digest") or "").removeprefix("sha1:")
    name = lambda x: re.sub(r"^<urn:page:(.*)>$", r"\1", x) if x is not None else None
    if kind == "revisit":
        n, digest = int(length[1]) if length else 0, declared
    else:
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return [name(_header(head, b"warc-record-id")), kind, name(_header(head, b"warc-refers-to")), _header(head, b"warc-target-uri"), n, digest, declared, payload if payloads else None]


def candidates(text: DataFrame, payloads: bool) -> DataFrame:
    """A row per magic string that a header with a length follows: its place, its record's whole length, and its fields if found whole.

    rel is counted from where a block's first line starts. A row with total null closes each block and
    holds its length as rel. A candidate whose record runs beyond its block has found 0.
    """
    magic = MAGIC.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rel, out = None, 0, []
        held: list[bytes] = []  # lines since the oldest record that is not whole yet
        first = 0  # rel of held[0]
        waiting: list[tuple[int, int]] = []

        def close() -> None:
            nonlocal held, waiting
            out.extend([*at, r, total, 0, *[None] * 8] for r, total in waiting)
            out.append([*at, rel, None, 0, *[None] * 8])
            held, waiting = [], []

        def table() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in NAMES]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], NAMES)

        for b in batches:
            for file, block, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, block) != at:
                    if at:
                        close()
                    at, rel = (file, block), 0
                end = line.find(b"\r\n\r\n")
                m = _LENGTH.search(line, 0, end + 2) if end >= 0 else None
                if waiting or m:
                    if not held:
                        first = rel
                    held.append(line)
                if m:
                    waiting.append((rel, len(magic) + end + 4 + int(m[1]) + 4))
                rel += len(line) + len(magic)
                if waiting:
                    open_, joined = [], None
                    for r, total in waiting:
                        if r + total <= rel:  # all of it has come
                            joined = joined if joined is not None else magic.join(held)
                            body = joined[r - first : r - first + total - len(magic)]
                            out.append([*at, r, total, 1, *(parse(body, payloads) if body.endswith(b"\r\n\r\n") else [None] * 8)])
                        else:
                            open_.append((r, total))
                    waiting = open_
                    if not waiting:
                        held = []
                if len(out) >= 256:
                    yield table()
                    out.clear()
        if at:
            close()
        yield table()

    return text.mapInArrow(run, f"file string, block long, rel long, total long, found long, {FIELDS}, payload binary")


def reachable(marks: DataFrame) -> DataFrame:
    """The candidates that a chain of successors reaches from their file's start, by pointer jumping over each file's offsets.

    A group holds 32 bytes for each candidate of one file, and never a payload.
    """

    def chain(t: pa.Table) -> pa.Table:
        file = t.column("file")[0].as_py()
        block, rel = t.column("block").to_numpy(), t.column("rel").to_numpy()
        total = t.column("total").fill_null(-1).to_numpy()
        found = t.column("found").to_numpy()
        ends = total < 0
        order = np.argsort(block[ends])
        starts, sizes = block[ends][order], rel[ends][order]
        bases = np.concatenate(([0], np.cumsum(sizes)))
        length = bases[-1] - len(MAGIC)  # no magic follows the last line
        block, rel, total, found = block[~ends], rel[~ends], total[~ends], found[~ends]
        base = bases[np.searchsorted(starts, block)]
        offset = base + rel - len(MAGIC)  # a line begins behind its magic
        by = np.argsort(offset)
        block, rel, total, found, offset = block[by], rel[by], total[by], found[by], offset[by]
        n = len(offset)
        after = np.searchsorted(offset, offset + total)
        sure = (after < n) & (offset[np.minimum(after, max(n - 1, 0))] == offset + total) if n else np.zeros(0, bool)
        jump = np.append(np.where(sure, after, n), n)
        kept = np.zeros(n + 1, dtype=bool)
        kept[:n] = offset == 0
        for _ in range(max(1, n).bit_length() + 1):
            kept[jump[kept]] = True
            jump = jump[jump]
        kept = kept[:n] & (sure | (offset + total == length))
        return pa.table({"file": [file] * int(kept.sum()), "block": block[kept], "rel": rel[kept], "whole": found[kept] == 1, "offset": offset[kept], "total": total[kept]}, schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("whole", pa.bool_()), ("offset", pa.int64()), ("total", pa.int64())]))

    return marks.select("file", "block", "rel", "total", "found").groupBy("file").applyInArrow(chain, "file string, block long, rel long, whole boolean, offset long, total long")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives at path: page_id, record_type, refers_to, target_uri, payload_bytes, payload_digest, declared_digest, payload.

    Tasks emit each magic string with its record's successor offset; only candidates reachable from the file's start are
    records, so magic strings inside payloads give none, and nothing behind a broken boundary is returned. A record that runs over
    the end of a split is put together from the lines of both. An empty folder of archives gives no rows.
    """
    tuned(spark)
    text = lines(spark, path)
    marks = candidates(text, payloads)
    kept, _ = written(reachable(candidates(text, False)), "boundaries")
    place = ["file", "block", "rel"]
    whole = marks.filter("total is not null and found = 1").join(kept.filter("whole").select(*place), place).drop(*place, "total", "found")
    if kept.filter("not whole").limit(1).count() == 0:
        return whole
    return whole.unionByName(spanning(text, kept, payloads))


def spanning(text: DataFrame, kept: DataFrame, payloads: bool) -> DataFrame:
    """The records that run over the end of a split, from the lines of theirs and the following splits."""
    magic = MAGIC.encode()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rel = None, 0
        for b in batches:
            places = []
            for file, block, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at, rel = ((file, block), 0) if (file, block) != at else (at, rel)
                places.append(rel)
                rel += len(line) + len(magic)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places, pa.int64())], ["file", "block", "value", "rel"])

    placed = text.mapInArrow(place, "file string, block long, value binary, rel long")
    sizes = placed.groupBy("file", "block").agg(F.max(F.col("rel") + F.length("value") + len(magic)).alias("size"))
    other = sizes.select("file", F.col("block").alias("earlier"), F.col("size").alias("of"))
    bases = sizes.join(other, "file").filter("earlier < block").groupBy("file", "block").agg(F.sum("of").alias("base"))
    wanted = kept.filter("not whole").select("file", F.col("offset").alias("start"), "total")
    at = placed.join(wanted.select("file").distinct(), "file", "left_semi").join(bases, ["file", "block"], "left")
    at = at.withColumn("offset", F.coalesce("base", F.lit(0)) + F.col("rel") - len(magic))
    parts = at.join(wanted, "file").filter("offset >= start and offset < start + total").select("file", "start", "total", "offset", "value")

    def build(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("offset").to_pylist(), t.column("value").to_pylist(), strict=True))
        body = magic.join(v for _, v in rows)[: t.column("total")[0].as_py() - len(magic)]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(parse(body, payloads), KINDS[5:], strict=True)], NAMES[5:])

    return parts.groupBy("file", "start").applyInArrow(build, f"{FIELDS}, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written to archives in the shared folder and read back."""
    path = new_path(pages.sparkSession, "archives")
    write_warc(pages, path)
    back = read_warc(pages.sparkSession, path, payloads=False)
    number = lambda c: F.expr(f"try_cast({c} as long)")
    return back.select(number("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
