"""Document fingerprints by consistent weighted sampling.

A text is the weighted set of its ``SHINGLE``-word shingles (a text of fewer
words: its whole word sequence; weight: number of occurrences). For each of
``SAMPLES`` samples, every term gets two Gamma(2, 1) values r and c and a
uniform value b, all from a hash of the term. With
t = floor(ln(weight) / r + b), the term of least ln(c) - r (t - b + 1) is
sampled, and the sample is the pair (term, t). Two texts have equal samples
with a probability that equals their generalised Jaccard similarity.

Inputs: a null text is the empty text. A text without words has the
fingerprint of zeros; it is like another such text (1) and unlike all others
(0). Words are runs of letters and digits without ASCII case. In ``edited``,
rows are ordered by descending ``doc_id`` (null last), rows with the same id
by a hash of their text. Other columns are kept by ``fingerprinted``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BYTES, add_columns, gram_hashes, mix64, slices, table, texts, utf8_texts, word_hashes

SHINGLE = 5
SAMPLES = 64
#: Ranges of doc_id (one task each), at most: one short row of each comes to
#: the driver and is broadcast.
MAX_RANGES = 40_000
_BLOCK = 2048
_LEVELS = 1 << 16


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) quantiles r, ln(c), uniform b by 16-bit level; multipliers."""
    level = (np.arange(_LEVELS) + 0.5) / _LEVELS
    x = np.concatenate([np.linspace(0, 1, 20_001)[1:] ** 2 * 4, np.linspace(4, 30, 20_000)])
    gamma = np.interp(level, 1 - (1 + x) * np.exp(-x), x)
    by_sample = mix64(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
    return (gamma.astype(np.float32), np.log(gamma).astype(np.float32),
            level.astype(np.float32), by_sample)


def terms(text: bytes) -> np.ndarray:
    """Hashes of the shingles, with repeats."""
    words = word_hashes(text.lower(), WORD_BYTES)[0]
    return gram_hashes(words, min(SHINGLE, max(len(words), 1)))


def _least(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per sample, the least value over the terms and the sampled pair's mark."""
    gamma, log_gamma, uniform, by_sample = _tables()
    best = np.full(SAMPLES, np.inf, dtype=np.float32)
    mark = np.zeros(SAMPLES, dtype=np.uint64)
    rows = np.arange(SAMPLES)
    for at in range(0, len(hashes), _BLOCK):
        h, w = hashes[at : at + _BLOCK], weights[at : at + _BLOCK]
        bits = by_sample[:, None] * h[None, :]
        bits ^= bits >> np.uint64(32)
        bits *= np.uint64(0xD6E8FEB86659FD93)
        r = gamma[bits >> np.uint64(48)]
        b = uniform[(bits >> np.uint64(32)) & np.uint64(0xFFFF)]
        value = log_gamma[(bits >> np.uint64(16)) & np.uint64(0xFFFF)]
        heavy = np.flatnonzero(w > 1)
        t = None
        shift = 1 - b  # t - b + 1 with t = 0, as for weight 1
        if len(heavy):
            t = np.floor(np.log(w[heavy]).astype(np.float32) / r[:, heavy] + b[:, heavy])
            shift[:, heavy] += t
        value -= r * shift
        which = value.argmin(axis=1)
        low = value[rows, which]
        found = h[which]
        if t is not None:
            place = np.full(len(h), -1)
            place[heavy] = np.arange(len(heavy))
            of = place[which]
            found = np.where(of >= 0, found + mix64(t[rows, of].astype(np.int64).view(np.uint64)), found)
        less = low < best
        best[less], mark[less] = low[less], found[less]
    return best, mark


def _signature(*parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits per sample from the least of the parts."""
    best, mark = parts[0]
    for value, other in parts[1:]:
        less = value < best
        best, mark = np.where(less, value, best), np.where(less, other, mark)
    if np.isinf(best).all():
        return np.zeros(SAMPLES, dtype=np.uint16)
    return (mix64(mark + _tables()[3]) >> np.uint64(48)).astype(np.uint16)


def signature(text: bytes) -> np.ndarray:
    return _signature(_least(*_counted(terms(text))))


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def two_signatures(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of two texts that share most terms; what a term of the same
    weight in both gives is computed once."""
    (ha, wa), (hb, wb) = _counted(terms(a)), _counted(terms(b))
    place = np.searchsorted(hb, ha)
    place[place == len(hb)] = 0
    same = (hb[place] == ha) & (wb[place] == wa) if len(hb) else np.zeros(len(ha), dtype=bool)
    rest = np.ones(len(hb), dtype=bool)
    rest[place[same]] = False
    both = _least(ha[same], wa[same])
    return (_signature(both, _least(ha[~same], wa[~same])), _signature(both, _least(hb[rest], wb[rest])))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples."""
    if not a.any() or not b.any():
        return float(a.any() == b.any())
    return float((a == b).mean())


def _hex(x: np.ndarray) -> str:
    return x.astype(">u2").tobytes().hex()


def fingerprinted(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Every column of ``docs`` plus the fingerprint (4 hex digits per sample)."""
    return add_columns(docs, [text], f"`{name}` string",
                       lambda col: [pa.array([_hex(signature(t)) for t in utf8_texts(col)], pa.string())],
                       [c for c in docs.columns if c != name])


# -- edited texts ----------------------------------------------------------
def _above(cuts: list[int], value: Column) -> Column:
    """How many of the (ascending) cuts are not below the value: binary search."""
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        below = (span["lo"] < span["hi"]) & (F.get(held, middle) < value)
        return F.struct(F.when(below, middle + 1).otherwise(span["lo"]).alias("lo"),
                        F.when(below, span["hi"]).otherwise(middle).alias("hi"))

    steps = F.sequence(F.lit(0), F.lit(len(cuts).bit_length()))
    first = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    return F.lit(len(cuts)) - F.aggregate(steps, first, halve, lambda span: span["lo"])


def _ranges(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (doc_id, text, tie) with the number of their doc_id range, of
    about n, descending, and one more row per range: the first of the next."""
    spark = rows.sparkSession
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5],
                                        max(10_000, 4 * n))).first()[0]
    cuts = sorted(set(cuts or []))[: n - 1]
    above = _above(cuts, F.col("doc_id")) if cuts else F.lit(0)
    number = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above)
    placed = rows.withColumn("range", number.cast("int"))
    # one short row per range: its first document in descending order
    heads = sorted(placed.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("h"))
                   .select("range", "h.doc_id", "h.tie").collect())
    after = [(h["doc_id"], h["tie"], heads[i - 1]["range"]) for i, h in enumerate(heads)]
    moved = spark.createDataFrame(after, "head_id bigint, head_tie bigint, to int")
    ahead = placed.join(F.broadcast(moved), F.col("doc_id").eqNullSafe(F.col("head_id")) &
                        (F.col("tie") == F.col("head_tie"))).select(
        "doc_id", "text", "tie", F.col("to").alias("range"), F.lit(True).alias("ahead"))
    return placed.withColumn("ahead", F.lit(False)).unionByName(ahead)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, ahead, doc_id, text) in order -> the query's rows."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last = None    # (range, doc_id, text) whose next document is not known yet
    ready = None   # a finished row that lacks the next document's signature

    def finish(own: np.ndarray) -> tuple:
        row, mine = ready
        return (*row, likeness(mine, own))

    for batch in slices(batches):
        out: list[tuple] = []
        for group, ahead, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2).to_pylist(), texts(batch.column(3))):
            if ahead and last is None:
                continue  # an equal copy of the row ahead
            if last is not None:
                _, doc_id, own = last
                third = len(own) // 3
                edited = (own[: len(own) - third] + text[:third]).encode()
                mine, other = two_signatures(own.encode(), edited)
                if ready is not None:
                    out.append(finish(mine))
                ready = ((doc_id, len(own), hashlib.sha256(edited).hexdigest(), _hex(mine), _hex(other),
                          likeness(mine, other)), mine)
            last = (group, doc, text)
            if ahead:
                out.append(finish(signature(text.encode())))
                last = ready = None
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint and that of its edited text (the last third
    replaced by the beginning of the next document, descending doc_id)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    n = min(MAX_RANGES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = _ranges(rows, n).repartitionById(n + 1, F.col("range")).sortWithinPartitions(
        "range", "ahead", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return ordered.select("range", "ahead", "doc_id", "text").mapInArrow(
        _edits, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                "edited_fingerprint string, near_edited double, near_next double")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return edited(table(spark, sf_dir, "documents"))
