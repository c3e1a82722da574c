"""Byte-level BPE encoding and decoding with a pair occurrence index."""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import CACHES, as_bytes, by_size, id_of, text_of, tuned

#: Fixed value: the public pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a worker keeps; beyond it the store starts anew, which changes no result.
KEPT = 600_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            shown[chr(256 + n)] = b
            n += 1
    return shown


class Bpe:
    """A vocabulary file's encoder and decoder.

    A batch's new words are encoded together: an index maps each pair of neighbouring ids to all its
    positions, active ranks are applied in ascending order, and the lists of the neighbours that a merge
    changes are updated. That is right only if a merge never has a lower rank than those that make its
    parts, which the constructor checks.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, shown = model["model"]["vocab"], byte_characters()
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(shown[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.first = [vocab[c] for c, _ in sorted(shown.items(), key=lambda x: x[1])]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pair_ids, new = (vocab[a], vocab[b]), vocab[a + b]
            if new in made or max(made.get(pair_ids[0], -1), made.get(pair_ids[1], -1)) > rank:
                raise ValueError("the merges are not in an order that ascending ranks can follow")
            made[new] = rank
            self.ranks[pair_ids] = (rank, new)
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.kept: dict[str, bytes] = {}

    def merged(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        ids: list[int] = []
        after: list[int] = []
        before: list[int] = []
        where: defaultdict[tuple[int, int], list[int]] = defaultdict(list)
        starts = []
        for w in words:
            at, n = len(ids), len(w)
            starts.append(at)
            ids += [self.first[b] for b in w]
            after += [*range(at + 1, at + n), -1] if n else []
            before += [-1, *range(at, at + n - 1)] if n else []
            for i in range(at, at + n - 1):
                where[ids[i], ids[i + 1]].append(i)
        ranks = self.ranks
        active = [(ranks[p][0], p) for p in where if p in ranks]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            left, right = pair
            new = ranks[pair][1]
            changed = set()
            for i in sorted(where.pop(pair, ())):
                j = after[i]
                if ids[i] != left or j < 0 or ids[j] != right:
                    continue  # an earlier merge took one of the two
                ids[i], ids[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    p = new, ids[k]
                    if p in ranks:
                        where[p].append(i)
                        changed.add(p)
                h = before[i]
                if h >= 0:
                    p = ids[h], new
                    if p in ranks:
                        where[p].append(h)
                        changed.add(p)
            for p in changed:
                heapq.heappush(active, (ranks[p][0], p))
        ends = [*starts[1:], len(ids)][: len(words)]
        return [[x for x in ids[a:b] if x >= 0] for a, b in zip(starts, ends, strict=True)]

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are not kept yet."""
        new = list(words.difference(self.kept))
        for w, ids in zip(new, self.merged([w.encode() for w in new]), strict=True):
            self.kept[w] = array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; strings of special tokens become those tokens."""
        cut = []
        for t in texts:
            pieces, at = [], 0
            for m in self.specials.finditer(t) if self.specials else ():
                pieces += [(self.pattern.findall(t[at : m.start()]), self.special[m[0]])]
                at = m.end()
            cut.append([*pieces, (self.pattern.findall(t[at:] if at else t), None)])
        self.learn({c for pieces in cut for words, _ in pieces for c in words})
        out = []
        for pieces in cut:
            coded = b"".join(b"".join(map(self.kept.__getitem__, words)) + (b"" if sp is None else np.uint32(sp).tobytes()) for words, sp in pieces)
            out.append(np.frombuffer(coded, dtype="<u4"))
        if len(self.kept) > KEPT:
            self.kept.clear()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def written_ids(self, ids: np.ndarray) -> str:
        return ",".join(map(self.decimal.__getitem__, ids.tolist()))


_open: dict[str, Bpe] = CACHES.setdefault("bpe", {})


def vocabulary(path: str) -> Bpe:
    """The vocabulary at path, read once in each Python worker."""
    if path not in _open:
        _open[path] = Bpe(path)
    return _open[path]


def encode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded) of each row: the whole text's ids, and the text that they decode to.

    One pass over the rows without a shuffle; the same vocabulary file must be readable on every worker.
    Null and empty texts give no ids; repeated rows, null keys and other columns change nothing.
    """
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            texts = as_bytes(b, b.schema.names[1])
            ids = [i for lo, hi in by_size(texts) for i in bpe.encode([t.decode() for t in texts[lo:hi]])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([i.tolist() for i in ids], pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())], ["key", "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key], text_of(text)).mapInArrow(run, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, through the same encoder and decoder.

    Nothing but the digests leaves the worker. Defined for nulls, repeats and empty tables as encode is.
    """
    tuned(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            counts, coded, decoded = [], [], []
            texts = as_bytes(b)
            for lo, hi in by_size(texts):
                for ids in bpe.encode([t.decode() for t in texts[lo:hi]]):
                    counts.append(len(ids))
                    coded.append(hashlib.sha256(bpe.written_ids(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
