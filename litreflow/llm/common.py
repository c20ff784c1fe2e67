"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litreflow.session import shared_dir

#: Bytes of an Arrow batch that are worked on at once; rows stay whole.
SLICE_BYTES = 4_000_000
#: Documents are handed to numpy in groups of about this many characters, so a
#: worker's memory does not depend on the Arrow batch size.
GROUP_CHARS = 1_000_000


@lru_cache(maxsize=4)
def _shipped(application: str) -> None:
    """Send the package to Python workers that could not import it (a session
    started elsewhere without ``--py-files`` or ``PYTHONPATH``)."""
    spark = SparkSession.getActiveSession()
    package = Path(__file__).resolve().parent.parent
    root = str(package.parent)
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if spark is None or root in on_path or not package.is_dir():
        return
    with tempfile.NamedTemporaryFile(suffix=".zip", prefix="package-", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for path in sorted(package.rglob("*.py")):
                z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(f.name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _shipped(spark.sparkContext.applicationId)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder. Its shuffle
    files, which nothing needs any more then, are removed at once."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint()  # planned under the setting
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def fresh(base: str, *frames: DataFrame) -> str:
    """A column name like ``base`` that none of ``frames`` has (in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def replace_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the values of ``name`` replaced, columns in the same order."""
    return df.withColumn(name, value.cast(df.schema[name].dataType))


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings; null is the empty text, invalid UTF-8 gives U+FFFD."""
    return ["" if b is None else b.decode("utf-8", "replace")
            for b in column.cast(pa.binary()).to_pylist()]


def utf8_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is the empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about SLICE_BYTES. Memory of a
    finished batch goes back to the system: workers outlive their tasks."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()
    return_memory()


def return_memory() -> None:
    """Give freed memory back to the system at the end of a task: an idle
    worker's share counts against its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def add_columns(df: DataFrame, inputs: list[str], outputs: str,
                fn: Callable[..., list[pa.Array]], pass_through: list[str],
                done: Callable[[], None] | None = None) -> DataFrame:
    """``pass_through`` columns plus what ``fn`` computes from ``inputs``.

    ``fn`` gets one Arrow array per input column of a batch and returns one
    array per output field. Rows stay in their partition. ``done`` is called
    at the end of each task, to drop what ``fn`` has cached.
    """
    added = T.StructType.fromDDL(outputs)
    schema = T.StructType([df.schema[c] for c in pass_through] + added.fields)
    source = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(pass_through + inputs)])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = fn(*[batch.column(batch.schema.get_field_index(c)) for c in inputs])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in pass_through]
            yield pa.RecordBatch.from_arrays(kept + made, names=names)
        if done is not None:
            made = kept = batch = None
            done()
            return_memory()

    return source.mapInArrow(run, schema)


def char_groups(items: list, limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of ``items`` with about ``limit`` characters each."""
    start = size = 0
    for i, x in enumerate(items):
        if size and size + len(x) > limit:
            yield start, i
            start, size = i, 0
        size += len(x)
    if start < len(items):
        yield start, len(items)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` ids of each class 0 and 1, the
    first by a hash of the id, one text an id: of several texts the one with
    the least hash. So what is collected from it is bounded by rows, whatever
    an id repeats in ``docs`` or ``labels``; copies go within the tasks."""
    known = labels.filter(f"doc_id IS NOT NULL AND {label} IN (0, 1)").select(
        F.col("doc_id").alias("labelled_id"), F.col(label).cast("int").alias("label")).distinct()
    order = [F.xxhash64(F.col("labelled_id").cast("string")), F.col("labelled_id")]
    chosen = known.filter("label = 1").orderBy(*order).limit(per_class).unionByName(
        known.filter("label = 0").orderBy(*order).limit(per_class))
    # at most 2 * per_class small rows
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    one = F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), F.col("text").isNull())).alias("one")
    return rows.groupBy("labelled_id", "label").agg(one).select("one.text", F.col("label").alias(label))


def crc_remainder(column: Column, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor`` (null: null)."""
    return F.crc32(column.cast("string").cast("binary")) % divisor


#: Words of a text: runs of letters and digits (ASCII or beyond), lower-cased.
WORD = re.compile(r"[^\W_]+")

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_kinds(is_word: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Bytes of words: ASCII letters and digits, and every byte of a character
#: beyond ASCII.
WORD_BYTES = _byte_kinds(lambda b: b >= 128 or chr(b).isalnum())
#: ASCII white space separates, all else is part of a word.
NON_SPACE_BYTES = _byte_kinds(lambda b: b not in b" \t\n\v\f\r")

_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of an odd constant modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096) - 1, _PRIME)]),
                             dtype=np.uint64)
    return _POWERS[:n]


def word_spans(text: bytes, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a text as an array, and the byte ranges of its words."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = kinds[raw]
    edges = np.diff(inside)
    return raw, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(text: bytes, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end byte of each word of a (lower-cased) text."""
    raw, starts, ends = word_spans(text, kinds)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, ends
    lengths = ends - starts
    longest = int(lengths.max())
    if longest > 4096:  # texts without white space: each such word by itself
        powers = _powers(longest)
        out = np.array([np.sum((raw[a:b].astype(np.uint64) + np.uint64(1)) * powers[: b - a],
                               dtype=np.uint64) for a, b in zip(starts, ends)], dtype=np.uint64)
        return mix64(out ^ (lengths.astype(np.uint64) << np.uint64(40))), starts, ends
    first = np.repeat(starts, np.diff(np.concatenate([starts, [len(raw)]])))
    where = np.arange(starts[0], len(raw), dtype=np.int64) - first
    np.minimum(where, longest, out=where)
    of_byte = np.where(kinds, np.arange(1, 257, dtype=np.uint64), np.uint64(0))
    values = of_byte[raw[starts[0]:]] * _powers(longest + 1)[where]
    sums = np.add.reduceat(values, starts - starts[0])
    return mix64(sums ^ (lengths.astype(np.uint64) << np.uint64(40))), starts, ends


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k consecutive words (none if fewer words)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _PRIME
        out ^= out >> np.uint64(29)
        out += words[j : j + n]
    return mix64(out)
