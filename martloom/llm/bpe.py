"""Byte-level BPE encoding and decoding.

Each text is cut into pieces by the tokenizer's pattern. A piece starts as one symbol per byte in a
doubly linked list; a heap holds the merge rank of every neighbouring pair, and the pair of least
rank, leftmost first, is merged until none is left. A heap entry whose symbols have changed since it
was pushed is stale and skipped. Decoding concatenates the vocabulary strings of the ids.

Edge cases: a null text encodes as the empty text (no ids, decoded as ""). Special tokens in a text
become their own id, as the file's ``added_tokens`` say. Texts of any length are encoded whole: long
ones are cut between pieces, a slab at a time. Repeated rows give repeated results; an empty table
gives an empty one. All columns of the input are kept; a result column replaces one of its name.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The piece pattern of byte-level tokenizer files with use_regex (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Encoded pieces in each of the two generations that a Python worker remembers, and the longest
# piece that it does remember.
CACHE_PIECES = 150_000
CACHE_CHARS = 48
# Longer texts go through the encoder this many pieces at a time.
SLAB_CHARS = 1_000_000
SLAB_PIECES = 100_000


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Pieces(dict):
    """Encoded pieces, as packed int32 ids; computed on first sight.

    Two generations: when the young one is full it becomes the old one, and what is still in use
    is carried over on its next use.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = array("i", self.codec.merge(piece.encode())).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encoder and decoder of one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        pre = spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        if spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} uses a feature that this codec does not have")
        symbols = byte_symbols()
        self.of_byte = [vocab[symbols[b]] for b in range(256)]
        self.rank_of: dict[int, int] = {}
        self.pairs: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.append((vocab[a], vocab[b], vocab[a + b]))
            self.rank_of.setdefault(vocab[a] << 32 | vocab[b], rank)
        byte_of = {ord(c): b for b, c in symbols.items()}
        self.strings = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[ord(c)] for c in token)
        self.special = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"{path}: special token {token['content']} with options")
            self.special[token["content"]] = token["id"]
            self.strings[token["id"]] = token["content"].encode()
        self.pieces = regex.compile(PIECES)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.cache = _Pieces(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        if n == 1:
            return ids
        rank_of, pairs = self.rank_of, self.pairs
        # A heap entry is one integer: the rank, which names the pair, above the position.
        shift = n.bit_length()
        mask = (1 << shift) - 1
        heap = []
        for i in range(n - 1):
            rank = rank_of.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append(rank << shift | i)
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & mask
            left, right, whole = pairs[entry >> shift]
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols has been merged meanwhile
            ids[i], ids[j] = whole, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of.get(whole << 32 | ids[k])
                if rank is not None:
                    heappush(heap, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = rank_of.get(ids[h] << 32 | whole)
                if rank is not None:
                    heappush(heap, rank << shift | h)
        return [i for i in ids if i >= 0]

    def _plain(self, text: str) -> Iterator[bytes]:
        encoded = self.cache.__getitem__
        if len(text) <= SLAB_CHARS:
            yield b"".join(map(encoded, self.pieces.findall(text)))
            return
        found = (m.group() for m in self.pieces.finditer(text))
        while slab := list(islice(found, SLAB_PIECES)):
            yield b"".join(map(encoded, slab))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as int32."""
        parts = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
        packed = []
        for k, part in enumerate(parts):
            if k % 2:
                packed.append(np.int32(self.special[part]).tobytes())
            elif part:
                packed.extend(self._plain(part))
        return np.frombuffer(b"".join(packed), dtype=np.int32)

    def decode(self, ids) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def _with(df: DataFrame, **fields: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in fields]
    return T.StructType([*kept, *(T.StructField(k, v) for k, v in fields.items())])


def _replaced(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def encode(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "token_ids",
    decoded: str | None = None,
    remember: bool = True,
) -> DataFrame:
    """``df`` with the ids of each ``text``; narrow, no shuffle.

    With ``decoded``, a column of that name holds the text that the ids decode to, in the same pass and
    worker. Workers ``remember`` encoded pieces from one task to the next, or free their memory for
    other stages.
    """
    fields = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})

    def run(batches):
        c = codec(path)
        for batch in batches:
            texts = batch.column(text)
            for start in range(0, len(texts), 256):  # bounds the ids held at once
                part = batch.slice(start, 256)
                rows = [c.encode(t.as_py() or "") for t in texts.slice(start, 256)]
                columns = {ids: _lists(rows)}
                if decoded:
                    columns[decoded] = pa.array([c.decode(r.tolist()) for r in rows], pa.string())
                yield _replaced(part, columns)
        if not remember:
            c.cache.forget()

    return df.mapInArrow(run, _with(df, **fields))


def decode(df: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids (null ids: null text); narrow, no shuffle."""

    def run(batches):
        c = codec(path)
        for batch in batches:
            lists = batch.column(ids)
            for start in range(0, len(lists), 256):
                part = batch.slice(start, 256)
                texts = [
                    None if not x.is_valid else c.decode(x.values.to_numpy().tolist())
                    for x in lists.slice(start, 256)
                ]
                yield _replaced(part, {decoded: pa.array(texts, pa.string())})

    return df.mapInArrow(run, _with(df, **{decoded: T.StringType()}))
