"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

A text in UTF-8, after one space, is cut into tokens by both tokenizers. Token-byte incidence matrices
A and B (a row per token, a column per byte) are kept in compressed rows, and Gustavson's product by
rows of A and B transposed holds, for each pair of tokens that overlap, the bytes they share. Offsets
where tokens of both end cut the bytes into groups; the product of the matrices (token id of a
document by group) and (group by token id) holds, for each pair of ids in a document, how many pairs
of their occurrences share a group. Documents are multiplied a block at a time, as a block-diagonal
matrix.

How many documents hold an id pair is summed over the corpus, first in each task. To look these
counts up again, pairs are dealt into buckets by their value and the documents' entries follow; a
bucket with many entries, such as one with a very frequent pair, is dealt to several tasks, each of
which gets a copy of its counts. So no task holds an unbounded part of either.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.bpe import PIECES, codec
from martloom.session import written

# Characters that are multiplied at a time; a longer text makes a block of its own.
BLOCK_CHARS = 400_000
BLOCK_DOCS = 256
# Terms of a product that are held at a time.
FLOPS = 2_000_000
# The second tokenizer takes a text in slabs of about this many characters.
SLAB_CHARS = 100_000
# Entries that a task counts before it passes the counts on.
COUNTED = 2_000_000
# Pairs of a bucket, and entries that meet one copy of it.
PAIRS = 500_000
ENTRIES = 4_000_000
# Entries that travel in one row.
SLICE = 200_000

# One space between characters that are none: both tokenizers begin a token there, whatever stands
# before (pieces of the second hold the space sign at their start only, which is checked).
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE_SIGN = "▁"
# The library's pattern matcher keeps a state for each character of a run of white space.
_LONG_SPACE = re.compile(r"\s{2000}")


@dataclass
class Csr:
    """A sparse matrix in compressed rows."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @staticmethod
    def of(rows: np.ndarray, indices: np.ndarray, shape: tuple[int, int], data: np.ndarray | None = None) -> Csr:
        """From coordinates; those of one place are added."""
        data = np.ones(len(rows), dtype=np.int64) if data is None else data
        key = rows.astype(np.int64) * shape[1] + indices
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, data = key[order], data[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        summed = np.add.reduceat(data, first) if len(key) else data
        row, column = np.divmod(key[first], shape[1])
        indptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=shape[0]))])
        return Csr(indptr, column, summed, shape[1])

    @staticmethod
    def spans(ends: np.ndarray) -> Csr:
        """Row k has ones from the end of row k - 1 to its own."""
        n = int(ends[-1]) if len(ends) else 0
        return Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, dtype=np.int64), n)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, self.row_numbers()[order], self.data[order], len(self.indptr) - 1)

    def product(self, other: Csr) -> Csr:
        """Gustavson's product: a row is the sum of the rows of ``other`` that its entries name.

        Rows are taken together up to ``FLOPS`` terms.
        """
        widths = np.diff(other.indptr)[self.indices]
        terms = np.concatenate([[0], np.cumsum(widths)])[self.indptr]
        rows, n_rows, at, parts = self.row_numbers(), len(self.indptr) - 1, 0, []
        while at < n_rows:
            to = max(at + 1, int(np.searchsorted(terms, terms[at] + FLOPS, side="right")) - 1)
            entries = slice(self.indptr[at], self.indptr[to])
            width = widths[entries]
            starts = other.indptr[self.indices[entries]] - (np.cumsum(width) - width)
            place = np.arange(width.sum()) + np.repeat(starts, width)
            values = np.repeat(self.data[entries], width) * other.data[place]
            row = np.repeat(rows[entries] - at, width)
            parts.append(Csr.of(row, other.indices[place], (to - at, other.columns), values))
            at = to
        counts = np.concatenate([np.empty(0, dtype=np.int64), *(np.diff(p.indptr) for p in parts)])
        empty = np.empty(0, dtype=np.int64)
        return Csr(
            np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
            np.concatenate([empty, *(p.indices for p in parts)]),
            np.concatenate([empty, *(p.data for p in parts)]),
            other.columns,
        )


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the lengths of these."""

    def __init__(self, first: str, second: str):
        self.codec = codec(first)
        tokens = {t: i for i, t in enumerate(self.codec.strings) if i not in self.codec.special.values()}
        # The library takes ids as ranks, which holds where each merge makes the next id.
        ranked = all(whole == 256 + rank for rank, (*_, whole) in enumerate(self.codec.pairs))
        self.first = tiktoken.Encoding("first", pat_str=PIECES, mergeable_ranks=tokens, special_tokens={}) if ranked else None
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.a_bytes = self.codec.strings
        self.b_bytes = [self._bytes(i) for i in range(self.second.get_piece_size())]
        self.a_length = np.array([len(t) for t in self.a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        # Ids as text, followed by what separates them from the next token of their group and of another.
        self.a_text, self.b_text = (
            np.array([f"{i}{end}" for end in ends for i in range(n)], dtype=object)
            for ends, n in ((",|", len(self.a_bytes)), (",;", len(self.b_bytes)))
        )

    def _bytes(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if _SPACE_SIGN in piece.lstrip(_SPACE_SIGN):
            raise ValueError(f"piece {piece!r} holds a space inside, so texts cannot be cut at spaces")
        return piece.replace(_SPACE_SIGN, " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none where either does not give the text's bytes back."""
        none = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int32)
        if not text:
            return none
        spaced = " " + text
        if self.first is not None and not _LONG_SPACE.search(spaced):
            a = self.first.encode_ordinary(spaced)
        else:
            a = np.frombuffer(b"".join(self.codec._plain(spaced)), dtype=np.int32).tolist()
        b, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + SLAB_CHARS) if len(text) - at > SLAB_CHARS else None
            to = cut.start() if cut else len(text)
            b += self.second.encode(text[at:to])
            at = to + 1  # the tokenizer itself puts a space before each slab
        whole = spaced.encode()
        a = np.array(a, dtype=np.int32)
        # Tokens of a byte-level tokenizer are the bytes of its pieces, and these are all of the text.
        if self.a_length[a].sum() != len(whole) or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return none
        return a, np.array(b, dtype=np.int32)


@lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> Tokenizers:
    """One pair per worker process and files."""
    return Tokenizers(first, second)


class Block:
    """Some documents, encoded and multiplied together."""

    def __init__(self, texts: list[str | None], pair: Tokenizers):
        self.pair = pair
        ids = [pair.encode(t) for t in texts]
        self.n = len(texts)
        self.a, self.b = (np.concatenate([x[k] for x in ids]).astype(np.int64) for k in (0, 1))
        self.a_doc, self.b_doc = (np.repeat(np.arange(self.n), [len(x[k]) for x in ids]) for k in (0, 1))
        self.a_end, self.b_end = np.cumsum(pair.a_length[self.a]), np.cumsum(pair.b_length[self.b])
        # Every document ends a token of both, so no group reaches over two of them.
        self.ends = np.intersect1d(self.a_end, self.b_end, assume_unique=True)
        self.a_group, self.b_group = (np.searchsorted(self.ends, e) for e in (self.a_end, self.b_end))

    def overlaps(self) -> Csr:
        """Bytes shared by each pair of tokens that share any."""
        return Csr.spans(self.a_end).product(Csr.spans(self.b_end).transposed())

    def id_links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, both ids and the number of linked occurrences, of each linked pair of ids."""
        first, second, groups = len(self.pair.a_length), len(self.pair.b_length), len(self.ends)
        own, row = np.unique(self.a_doc * first + self.a, return_inverse=True)
        by_group = Csr.of(row, self.a_group, (len(own), groups))
        links = by_group.product(Csr.of(self.b_group, self.b, (groups, second)))
        of = own[links.row_numbers()]
        return of // first, of % first, links.indices, links.data

    def group_digests(self) -> list[str]:
        """The hash of each document's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        groups = np.arange(len(self.ends) + 1)
        a_at, b_at = np.searchsorted(self.a_group, groups), np.searchsorted(self.b_group, groups)
        # Each group's tokens of the first kind, then those of the second.
        text = np.empty(len(self.a) + len(self.b), dtype=object)
        last = lambda group: np.diff(group, append=-1) != 0
        a_place = np.arange(len(self.a)) + b_at[self.a_group]
        text[a_place] = self.pair.a_text[self.a + last(self.a_group) * len(self.pair.a_length)]
        b_place = np.arange(len(self.b)) + a_at[self.b_group + 1]
        text[b_place] = self.pair.b_text[self.b + last(self.b_group) * len(self.pair.b_length)]
        sizes = self.per_document(self.a_doc) + self.per_document(self.b_doc)
        edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        joined = ("".join(text[x:y].tolist())[:-1] for x, y in zip(edges, edges[1:]))
        return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in joined]

    def group_documents(self) -> np.ndarray:
        return self.a_doc[np.searchsorted(self.a_end, self.ends)]

    def per_document(self, documents: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(documents, weights, self.n).astype(np.int64)


def _blocks(batch: pa.RecordBatch, text: str, pair: Tokenizers) -> Iterator[tuple[int, Block]]:
    """The start of each block in a batch, and the block."""
    column, at, held, chars = batch.column(text), 0, [], 0
    for value in column:
        t = value.as_py()
        if held and (chars + len(t or "") > BLOCK_CHARS or len(held) >= BLOCK_DOCS):
            yield at, Block(held, pair)
            at, held, chars = at + len(held), [], 0
        held.append(t)
        chars += len(t or "")
    if held:
        yield at, Block(held, pair)


def _narrow(x: np.ndarray, largest: int) -> np.ndarray:
    """As unsigned numbers of as many bytes as the largest possible value needs."""
    return x.astype(np.uint16 if largest < 1 << 16 else np.uint32)


def _wide(packed: bytes, n: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[len(packed) // n] if n else np.uint8
    return np.frombuffer(packed, dtype=kind).astype(np.int64)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def alignments(df: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, doc_id``, counts, ``groups_sha256`` and the packed id pairs of every row, stored.

    ``n_pairs`` id pairs with ``a``, ``b`` and ``w``, the occurrences that are linked, each packed as
    unsigned numbers of as many bytes as ``len / n_pairs``. ``row`` numbers the rows.
    """
    texts = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    names = ["row", "doc_id", *_COUNTS, "groups_sha256", "n_pairs", "a", "b", "w"]

    def run(batches):
        pair = tokenizers(first, second)
        for batch in batches:
            for at, block in _blocks(batch, "text", pair):
                doc, a, b, w = block.id_links()
                n_pairs = block.per_document(doc)
                ends = np.cumsum(n_pairs)
                overlaps = np.diff(block.overlaps().indptr)
                counts = [
                    block.per_document(block.a_doc),
                    block.per_document(block.b_doc),
                    block.per_document(block.group_documents()),
                    block.per_document(doc, w),
                    block.per_document(block.a_doc, overlaps),
                ]
                packed = [_narrow(a, len(pair.a_length)), _narrow(b, len(pair.b_length))]
                columns = [
                    [x[e - n : e].tobytes() for n, e in zip(n_pairs.tolist(), ends.tolist())] for x in packed
                ]
                weights = [w[e - n : e] for n, e in zip(n_pairs.tolist(), ends.tolist())]
                columns.append([
                    (x.astype(np.uint8) if x.max(initial=0) < 256 else x.astype(np.int64)).tobytes() for x in weights
                ])
                part = batch.slice(at, block.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), *map(pa.array, counts)]
                    + [pa.array(block.group_digests(), pa.string()), pa.array(n_pairs)]
                    + [pa.array(c, pa.binary()) for c in columns],
                    names,
                )

    counts = ", ".join(f"{c} BIGINT" for c in _COUNTS)
    ddl = f"row BIGINT, doc_id BIGINT, {counts}, groups_sha256 STRING, n_pairs BIGINT, a BINARY, b BINARY, w BINARY"
    # Row numbers are only settled once they are stored.
    return written(texts.mapInArrow(run, ddl), "alignments")


def overlap_links(df: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a, b, a_id, b_id, n_bytes``: each pair of tokens, by place and id, that share bytes.
    Repeated rows give repeated links; edge cases as in ``align``."""
    texts = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        pair = tokenizers(first, second)
        for batch in batches:
            for at, block in _blocks(batch, "text", pair):
                links = block.overlaps()
                a, b = links.row_numbers(), links.indices
                a_first, b_first = (
                    np.searchsorted(d, np.arange(block.n)) for d in (block.a_doc, block.b_doc)
                )
                doc = block.a_doc[a]
                ids = batch.column("doc_id").slice(at, block.n).take(pa.array(doc))
                columns = [a - a_first[doc], b - b_first[doc], block.a[a], block.b[b], links.data]
                yield pa.RecordBatch.from_arrays(
                    [ids, *map(pa.array, columns)], ["doc_id", "a", "b", "a_id", "b_id", "n_bytes"]
                )

    return texts.mapInArrow(run, "doc_id BIGINT, a BIGINT, b BIGINT, a_id BIGINT, b_id BIGINT, n_bytes BIGINT")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair`` (a id * ``width`` + b id), ``n``, the documents that hold it linked, and ``best``: no
    pair of the same a id has more."""

    def run(batches):
        held, size = [], 0

        def counted():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for n, a, b in zip(*(batch.column(c) for c in ("n_pairs", "a", "b"))):
                if n := n.as_py():
                    held.append(_wide(a.as_py(), n) * width + _wide(b.as_py(), n))
                    size += n
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    parts = aligned.select("n_pairs", "a", "b").mapInArrow(run, "pair BIGINT, n BIGINT")
    counts = written(parts.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    a = F.floor(F.col("pair") / width).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    # A row for each id of the first tokenizer at most.
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_PACKED = "kind INT, rows BINARY, sizes BINARY, a BINARY, b BINARY, w BINARY"


def _packed_counts(counts: DataFrame, buckets: int) -> DataFrame:
    """Sorted pairs, counts and marks of each bucket, as one row."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pair")
        columns = [table.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best")]
        packed = [pa.array([x.tobytes()], pa.binary()) for x in columns]
        none = pa.array([None], pa.binary())
        return pa.table(
            [table.column("bucket").slice(0, 1).combine_chunks(), pa.array([0], pa.int32()), none, none, *packed],
            ["bucket", "kind", "rows", "sizes", "a", "b", "w"],
        )

    dealt = counts.withColumn("bucket", F.pmod("pair", F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, f"bucket BIGINT, {_PACKED}")


def _slices(aligned: DataFrame, width: int, buckets: int) -> DataFrame:
    """The entries of some documents that fall into one bucket, as one row."""

    def run(batches):
        def sliced(held):
            rows, a, b, w = (np.concatenate(x) for x in zip(*held))
            bucket = (a * width + b) % buckets
            for k in np.unique(bucket):
                at = np.flatnonzero(bucket == k) if buckets > 1 else slice(None)
                first = np.flatnonzero(np.diff(rows[at], prepend=-1))
                sizes = np.diff([*first, len(rows[at])])
                packed = [rows[at][first], sizes.astype(np.uint32), a[at].astype(np.uint32), b[at].astype(np.uint32)]
                packed.append(w[at] if w.max() > 255 else w[at].astype(np.uint8))
                yield (int(k), int(rows[0]), 1, *(x.tobytes() for x in packed))

        def batched(found):
            columns = list(zip(*found))
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
            names = ["bucket", "seed", "kind", "rows", "sizes", "a", "b", "w"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        held, size = [], 0
        for batch in batches:
            for row, n, a, b, w in zip(*(batch.column(c) for c in ("row", "n_pairs", "a", "b", "w"))):
                if n := n.as_py():
                    held.append((np.full(n, row.as_py()), *(_wide(x.as_py(), n) for x in (a, b, w))))
                    size += n
                if size >= SLICE:
                    yield batched(sliced(held))
                    held, size = [], 0
        if held:
            yield batched(sliced(held))

    return aligned.select("row", "n_pairs", "a", "b", "w").mapInArrow(run, f"bucket BIGINT, seed BIGINT, {_PACKED}")


def _look_up(width: int):
    def run(table: pa.Table) -> pa.Table:
        counts, found = None, [np.empty((3, 0), dtype=np.int64)]
        for batch in table.select(["kind", "a", "b", "w"]).to_batches():
            for k in np.flatnonzero(batch.column("kind").to_numpy() == 0):
                counts = [np.frombuffer(batch.column(c)[int(k)].as_py(), dtype=np.int64) for c in "abw"]
        for batch in table.to_batches():
            for k in np.flatnonzero(batch.column("kind").to_numpy() == 1):
                rows, sizes, a, b, w = (batch.column(c)[int(k)].as_py() for c in ("rows", "sizes", "a", "b", "w"))
                rows, sizes = np.frombuffer(rows, dtype=np.int64), np.frombuffer(sizes, dtype=np.uint32)
                n = int(sizes.sum())
                place = np.searchsorted(counts[0], _wide(a, n) * width + _wide(b, n))
                w = _wide(w, n)
                first = np.cumsum(sizes, dtype=np.int64) - sizes
                found.append([rows, *(np.add.reduceat(w * x[place], first) for x in (counts[2], counts[1]))])
        return pa.table(list(np.concatenate(found, axis=1)), ["row", "n_best", "count_sum"])

    return run


def align(df: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps`` of every
    row.

    ``first`` is a byte-level BPE file, ``second`` a sentence-piece model that puts a space before a
    text; special tokens are plain text. A link is a pair of occurrences, one of each tokenizer, in one
    group. The count of an id pair is the number of rows that hold it linked; ``n_best`` counts the links
    whose count is the highest of their first id, ties included, ``count_sum`` adds the counts of all
    links. ``n_overlaps`` counts the pairs of tokens that share bytes.

    Edge cases: texts that are null or empty, and those whose bytes either tokenizer does not give
    back, have no tokens: zeros and an empty digest. Repeated rows count as documents of their own and
    have results of their own, as have rows without doc_id. Texts of any length count whole. An empty
    table gives an empty result; other columns are not read.
    """
    pair = tokenizers(first, second)
    width = len(pair.b_length)
    aligned = alignments(df, first, second, doc_id, text)
    counts = written(pair_counts(aligned, width), "counts")
    buckets = max(1, -(-counts.count() // PAIRS))
    entries = aligned.agg(F.sum("n_pairs")).first()[0] or 0
    copies = max(1, -(-entries // (buckets * ENTRIES)))
    sides = _packed_counts(counts, buckets).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    slices = _slices(aligned, width, buckets).withColumn("copy", F.pmod(F.xxhash64("seed"), F.lit(copies)).cast("int"))
    sums = (
        sides.unionByName(slices.drop("seed"))
        .groupBy("bucket", "copy")
        .applyInArrow(_look_up(width), "row BIGINT, n_best BIGINT, count_sum BIGINT")
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    digests = aligned.select("row", "doc_id", *_COUNTS, "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return digests.join(sums.hint("merge"), "row", "left").select(
        "doc_id",
        *_COUNTS[:4],
        *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
        "n_overlaps",
    )
