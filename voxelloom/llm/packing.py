"""Packing into fixed windows: concatenate all documents' ids and cut, with two passes of prefix sums."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import CACHES, as_bytes, by_size, id_of, released, text_of, tuned, written

#: Words whose ids a worker keeps in each of two generations, none of more than LONG bytes; it changes no result.
KEPT, LONG = 150_000, 64
WINDOW = 4096
#: Words of ASCII marks, digits and letters and of the Latin-1 letters: composed already, and lower-cased byte by byte.
_PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
_MARKS = frozenset(b for b in range(33, 127) if not chr(b).isalnum())
#: Fixed value: the vocabulary's own cut of a word, for such words. A marks' run may begin with an apostrophe that no ending follows.
_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf\x9f])+|[0-9]|[!-/:-@\[-`{-~]+")
#: Closes each document.
END = 2

_open: dict = CACHES.setdefault("packing", {})


class Words(dict):
    """Ids by a tokenizers file that drops white space: each run without ASCII white space is encoded once, as it is first met.

    Plain words are cut and lower-cased here and their pieces merged by rank; all others go through the tokenizers library
    whole. Ids are kept in two bytes each if the vocabulary lets them, else in four (kind).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.old: dict[bytes, bytes] = {}
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            self.merge, self.packed = self.ranked(json.load(f)["model"])

    def ranked(self, model: dict) -> tuple:
        """(a function from a piece, closed by the byte 255, to ranks; each rank's id, packed).

        A word's last byte and its closing mark are one symbol of the vocabulary. UTF-8 has no byte 255, so here it is that mark, and
        the merges that fix it to a byte come first; the vocabulary's own merges follow in their order.
        """
        import tiktoken

        vocab, close, byte = model["vocab"], model["end_of_word_suffix"], byte_characters()
        shown = {b: c for c, b in byte.items()}
        raw = lambda token: bytes(byte[c] for c in token.removesuffix(close)) + (b"\xff" if token.endswith(close) else b"")
        ids = [vocab.get(shown[b], 0) for b in range(256)] + [vocab.get(shown[b] + close, 0) for b in range(255)]
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(255)}
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[raw(a) + raw(b)] = len(ids)
            ids.append(vocab[a + b])
        if len(ranks) != len(ids):
            raise ValueError("two merges of the vocabulary make the same token")
        core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        return core.encode_single_piece, [np.array([i], self.kind).tobytes() for i in ids]

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        out = self.old.get(word)
        if out is not None:
            self[word] = out
            return out
        if len(word) > LONG:
            return self.ids(word.decode())
        if word.isalpha():  # of ASCII alone, as bytes are
            pieces = [word.lower()]
        elif word[-1] in _MARKS and word[:-1].isalpha():
            pieces = [word[:-1].lower(), word[-1:]]
        elif _PLAIN.fullmatch(word) and b"<|" not in word:
            pieces = _PIECES.findall(word.translate(_LOWER))
        else:
            out = self[word] = self.ids(word.decode())
            return out
        packed, merge = self.packed, self.merge
        out = self[word] = b"".join([packed[r] for piece in pieces for r in merge(piece + b"\xff")])
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids, packed as kind says."""
        out = []
        for t in texts:
            # The vocabulary is lower case; strings of special tokens alone tell A-Z from a-z.
            out.append(b"".join(map(self.__getitem__, (t if b"<|" in t else t.lower()).split())))
            if len(self) > KEPT:  # words met again come back from the old generation
                self.old = dict(self)
                self.clear()
        return out


def vocabulary(path: str) -> Words:
    if path not in _open:
        _open[path] = Words(path)
    return _open[path]


def tokenised(df: DataFrame, path: str, end: int = END) -> tuple[DataFrame, str]:
    """A table in the shared folder: part, before (ids ahead of the document in its part), n, ids (packed).

    Its ids are made once. Both later passes read this table, so that a task run again cannot move a
    boundary: part and before are stored, not derived from how a scan happens to be split.
    """
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        released("packing")  # what earlier operators' tasks left in this worker
        words, part, total = vocabulary(path), TaskContext.get().partitionId(), 0
        for b in batches:
            last, width = np.array([end], dtype=words.kind).tobytes(), words.kind.itemsize
            texts = as_bytes(b)
            ids = [i + last for lo, hi in by_size(texts) for i in words.encode(texts[lo:hi])]
            n = np.array([len(i) // width for i in ids], dtype=np.int64)
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), b.column(0), pa.array(before), pa.array(n), pa.array(ids, pa.binary())], ["part", "doc_id", "before", "n", "ids"])

    rows = df.select(id_of().alias("doc_id"), text_of().alias("text"))
    return written(rows.mapInArrow(run, "part int, doc_id long, before long, n long, ids binary"), "tokens")


def pack(df: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of the one long sequence of all documents' ids, cut every window ids.

    Returns doc_id, start, length, ids (packed little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset and padded_length per piece. First pass: each part's total, of which the driver gets one number a
    part, gives the part's global offset. Second pass: a document's global offset gives its windows, and a
    document that crosses a boundary gives one piece on either side. Only the last sequence is shorter;
    it is padded to window unless its length is a power of two.

    Null and empty texts give the closing id alone. Repeated rows and null ids are documents of their own.
    An empty table gives no pieces. Other columns are ignored.
    """
    tokens, _ = tokenised(df, path, end)
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total")).orderBy("part").collect()
    bases, total = {}, 0
    for r in totals:
        bases[r["part"]] = total
        total += r["total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for part, key, before, n, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first, view = bases[part] + before, np.frombuffer(ids, f"<u{len(ids) // n}")
                for s in range(first // window, (first + n - 1) // window + 1):
                    lo, hi = max(first, s * window), min(first + n, (s + 1) * window)
                    size = min(window, total - s * window)
                    for column, value in zip(out, (key, lo - first, hi - lo, view[lo - first : hi - first].astype("<u4").tobytes(), n, s, lo - s * window, size if size & (size - 1) == 0 else window), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"])

    return tokens.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_length long")


def pieces(df: DataFrame, path: str) -> DataFrame:
    """The packed pieces with a checksum in place of their ids; nulls, repeats and empty tables as in pack."""
    return pack(df, path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def checksum(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
