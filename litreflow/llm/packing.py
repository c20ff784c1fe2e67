"""Packed token ids: best-fit-decreasing packing into rows of fixed length.

Documents are dealt by a hash of their text into buckets of bounded size, and
each bucket is tokenized and packed in one task; a bucket that many copies of a
row make larger is packed part by part, so its memory is bounded. A document longer than a row
is split losslessly into whole rows and a rest. Pieces are placed by falling
length into the open row with the least sufficient capacity, which a segment
tree over capacities finds in logarithmic time. A row of the result is one row
of the id matrix, with the cumulative lengths of its segments and positions
that start again at every segment.

Inputs: a null or empty text has no ids and appears in no row. Rows with the
same ``doc_id`` are packed each. A null ``doc_id`` is carried as null. The
result does not depend on the partitioning of the input. Other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, texts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ROW_LENGTH = 2048
#: Characters in a bucket, about; a longer document is a bucket's excess.
BUCKET_CHARS = 8_000_000


@lru_cache(maxsize=2)
def _encoding(name_or_path: str) -> tiktoken.Encoding:
    path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


class Capacities:
    """Open rows by free capacity; a segment tree finds the least sufficient."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of least capacity >= need, which is removed."""
        found = self._next(need)
        if found is None:
            return None
        self._change(found, -1)
        return found, self.rows[found].pop()

    def _change(self, capacity: int, by: int) -> None:
        at = self.size + capacity
        while at:
            self.count[at] += by
            at >>= 1

    def _next(self, need: int) -> int | None:
        at = self.size + need
        if not self.count[at]:
            # up to the first right neighbour that holds a row, then down left
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.size


def packed(lengths: list[int], row_length: int) -> list[list[int]]:
    """Pieces (indices into ``lengths``, each 1 .. row_length) by row."""
    rows: list[list[int]] = []
    free = Capacities(row_length)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = free.take(lengths[i])
        if got is None:
            got = row_length, len(rows)
            rows.append([])
        capacity, row = got
        rows[row].append(i)
        if capacity > lengths[i]:
            free.add(capacity - lengths[i], row)
    return rows


_SCHEMA = ("bucket int, row int, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
           "doc_ids array<bigint>, parts array<int>")


def _pack_buckets(batches: Iterator[pa.RecordBatch], vocabulary: str, row_length: int,
                  most: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, doc_id, text) sorted by bucket -> packed rows; so many
    tokens of a bucket are packed at once, at most."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int32())]
    bucket: int | None = None
    pieces: list[np.ndarray] = []
    source: list[tuple[int | None, int]] = []
    size = number = 0  # tokens held, and rows the bucket has already

    def done() -> pa.RecordBatch:
        nonlocal number
        rows = []
        for k, row in enumerate(packed([len(p) for p in pieces], row_length), number):
            sizes = [len(pieces[i]) for i in row]
            used = sum(sizes)
            matrix = np.zeros(row_length, dtype="<u4")
            matrix[:used] = np.concatenate([pieces[i] for i in row])
            positions = np.zeros(row_length, dtype="<u4")
            positions[:used] = np.concatenate([np.arange(n) for n in sizes])
            rows.append((bucket, k, used, matrix.tobytes(), [0, *np.cumsum(sizes).tolist()],
                         positions.tobytes(), [source[i][0] for i in row], [source[i][1] for i in row]))
        number += len(rows)
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    encode = _encoding(vocabulary).encode_ordinary
    for batch in slices(batches):
        for b, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
            if pieces and (b != bucket or size >= most):
                yield from slices([done()])
                pieces, source, size = [], [], 0
            if b != bucket:
                bucket, number = b, 0
            ids = np.array(encode(text), dtype="<u4")
            size += len(ids)
            for part, at in enumerate(range(0, len(ids), row_length)):
                pieces.append(ids[at : at + row_length])
                source.append((doc, part))
    if pieces:
        yield from slices([done()])


def pack(docs: DataFrame, row_length: int = ROW_LENGTH, vocabulary: str = VOCABULARY,
         bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """bucket, row, n_tokens, ids and positions (row_length little-endian
    32-bit numbers each, zeros past n_tokens), cu_seqlens, doc_ids and parts
    (document and number of the piece of each segment)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    total = rows.agg(F.sum(F.char_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_chars))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)).cast("int"))
    return (dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "doc_id", "tie")
            .select("bucket", "doc_id", "text")
            .mapInArrow(lambda it: _pack_buckets(it, vocabulary, row_length, bucket_chars), _SCHEMA))


def write_packed(rows: DataFrame, path: str) -> None:
    """The packed rows as Parquet: one row of the id matrix per record."""
    rows.write.mode("overwrite").parquet(path)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows of all documents, binary columns as digests."""
    return pack(table(spark, sf_dir, "documents")).select(
        "bucket", "row", "n_tokens", (F.size("cu_seqlens") - 1).alias("n_segments"), "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"),
        "doc_ids", "parts")


def row_digest(values: list[int], row_length: int = ROW_LENGTH) -> str:
    """Digest of one row of the id or position matrix."""
    row = np.zeros(row_length, dtype="<u4")
    row[: len(values)] = values
    return hashlib.sha256(row.tobytes()).hexdigest()
