"""How document filters interact: what each one removes in every order.

Each filter is one bit of a document's mask of failed filters, so everything the
audit tells is a sum over mask counts. Four filters judge a text by itself. The
fifth, a text that a smaller ``doc_id`` has too, is found in three steps:

1. *Sketch.* Every text adds one to a few counters of a counting Bloom filter,
   all in one block that its hash chooses. Tasks count for themselves, the
   counts are merged by key, and a block keeps one bit per counter: two or
   more. There are ``COUNTERS`` counters a text, so the sketch grows with the
   input; up to ``BROADCAST_BLOCKS`` blocks are sent to all tasks, more are
   joined by block.
2. *Clear.* A text with a counter below two is unique. Its text is not moved.
3. *Exact.* Texts that may repeat are grouped by the whole text, copies within
   a task first, and give the least ``doc_id`` of each text. Rows find it by the
   text's sha256 and their own id, so copies of one text spread over all tasks:
   a row whose pair is not there has a larger id.

Rows of the same id, part and mask are counted together before they meet the
labels, and counts per part and mask give all orders.

Inputs: null text is the empty text, null ``source`` the empty part; a null
``doc_id`` is neither first nor a repeat and has no label. Rows with the same
id and text are not smaller than each other, so they repeat only what a smaller
id has. A label of an id counts if any of its rows in ``labels`` has it; null
labels do not. Every row of ``documents`` is counted, repeated ones too. An
empty table has no parts and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import add_columns, checkpointed, table, utf8_texts

FILTERS = "ABCDE"
#: A: fewer words, B: a lower share of distinct words (percent), C: a higher
#: share of capitals (percent), D: any of these characters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, BANNED = 200, 50, 2, b"#$%&*|"
#: Counters of the sketch for each text, and those that a text adds to.
COUNTERS, HASHES = 16, 4
#: Counters of a block: the bits of a bitmap as Spark makes them (4 KB).
BLOCK = 8 * 4096
BROADCAST_BLOCKS = 8192

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no code point


def failed(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    words = text.split()
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    return ((n < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, BANNED)) < len(text)) << 3)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of filters A to D and sha256 of every whole text."""

    def run(column: pa.Array) -> list[pa.Array]:
        found = utf8_texts(column)
        return [pa.array([failed(t) for t in found], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in found], pa.binary())]

    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    return add_columns(rows, ["text"], "mask int, digest binary", run, ["doc_id", "part"])


# -- the sketch ------------------------------------------------------------
def _spots(digest: Column, blocks: int) -> tuple[Column, Column]:
    """Block and counters (within the block) of a text's digest."""
    hashed = F.xxhash64(digest)
    spots = [F.shiftrightunsigned(hashed, 15 * j).bitwiseAND(BLOCK - 1) for j in range(HASHES)]
    return F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(blocks)).alias("block"), F.array_distinct(F.array(*spots))


def sketch(digests: DataFrame, blocks: int) -> DataFrame:
    """block, bits: the counters that are two or more, of rows (digest)."""
    block, spots = _spots(F.col("digest"), blocks)
    counters = (digests.select(block, F.explode(spots).alias("spot"))
                .groupBy("block", "spot").agg(F.count(F.lit(1)).alias("n")))
    return counters.filter("n >= 2").groupBy("block").agg(F.bitmap_construct_agg("spot").alias("bits"))


def with_possible(rows: DataFrame, merged: DataFrame, blocks: int, small: bool) -> DataFrame:
    """Rows (with a digest) and ``possible``: whether every counter of the text
    is two or more. Else no other row has this text."""
    block, spots = _spots(F.col("digest"), blocks)
    side = merged.withColumnRenamed("block", "of_block")

    def is_set(spot: Column) -> Column:
        byte = F.hex(F.substring("bits", F.shiftright(spot, 3).cast("int") + 1, F.lit(1)))
        return F.getbit(F.conv(byte, 16, 10).cast("int"), spot.bitwiseAND(7).cast("int")) == 1

    return (rows.withColumn("block", block).withColumn("spots", spots)
            .join(F.broadcast(side) if small else side, F.col("block") == F.col("of_block"), "left")
            .select(*rows.columns, (F.col("bits").isNotNull() & F.forall("spots", is_set)).alias("possible")))


def first_ids(docs: DataFrame, merged: DataFrame, blocks: int, small: bool) -> DataFrame:
    """digest, first: the least doc_id of every text that may repeat."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    return (with_possible(texts, merged, blocks, small).filter("possible")
            .groupBy("text").agg(F.min("doc_id").alias("first"))
            .select(F.unhex(F.sha2("text", 256)).alias("of_digest"), "first"))


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of all filters and n, the rows that have these."""
    own = checkpointed(judged(docs))
    blocks = max(1, -(-own.count() * COUNTERS // BLOCK))
    merged = checkpointed(sketch(own.select("digest"), blocks))
    small = merged.count() <= BROADCAST_BLOCKS
    firsts = checkpointed(first_ids(docs, merged, blocks, small).filter("first IS NOT NULL"))
    rows = own.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    found = with_possible(rows, merged, blocks, small).join(
        firsts, (F.col("digest") == F.col("of_digest")) & (F.col("doc_id") == F.col("first")), "left")
    repeated = F.col("possible") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(repeated, 16).otherwise(0)
    return (found.select("doc_id", "part", mask.alias("mask"), "n")
            .groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and how many rows have them: n, good (quality 1), toxic."""
    of_id = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    both = masks(docs).join(of_id, F.col("doc_id") == F.col("labelled_id"), "left")
    return both.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(f"is_{k}"), F.col("n")).otherwise(0)).alias(k)
                                 for k in ("good", "toxic")])


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter does at each step of each order, per part, from mask
    counts (bit k of a mask is the filter ``filters[k]``).

    A filter's effect depends on which filters come before it, not on their
    order, so effects are summed once for each such set, and orders look them
    up.
    """
    k = len(filters)
    bits = [1 << i for i in range(k)]
    states = []  # bit, mask of those before, in how many orders they are
    for bit in bits:
        others = [b for b in bits if b != bit]
        for size in range(k):
            ways = factorial(size) * factorial(k - 1 - size)
            states += [(bit, sum(c), ways) for c in combinations(others, size)]
    steps = []
    for order in permutations(range(k)):
        for step, i in enumerate(order):
            steps.append(("".join(filters[x] for x in order), step + 1, bits[i],
                          sum(bits[x] for x in order[:step])))
    spark = counts.sparkSession
    fields = "bit", "before", "ways"
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f) for v, f in zip(s, fields)]) for s in states]))
    rows = counts.select("*", each.alias("s")).select(*counts.columns, *[f"s.{f}" for f in fields])
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    passed = F.col("mask").bitwiseAND(F.col("before")) == 0  # all filters before
    zero = F.lit(0)

    def total(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(zero))

    effects = rows.groupBy("part", *fields).agg(
        total("n", ~fails & passed).alias("kept"), total("n", fails & passed).alias("removed"),
        total("n", fails & ~passed).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", fails & passed).alias("good_lost"), total("toxic", fails & passed).alias("toxic_lost"))
    effects = effects.withColumn("shapley", F.sum(F.col("ways") * F.col("removed")).over(
        Window.partitionBy("part", "bit")))
    orders = spark.createDataFrame(steps, "filter_order string, step int, of_bit int, of_before int")
    return (effects.join(F.broadcast(orders), (F.col("bit") == F.col("of_bit")) &
                         (F.col("before") == F.col("of_before")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the five filters over all documents."""
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE = r"""
WITH own AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM own),
flags AS (
  SELECT doc_id, part, t, len(w) < 200 AS a, 100 * list_unique(w) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d FROM words),
firsts AS (SELECT t AS of_text, min(doc_id) AS first_id FROM own GROUP BY t),
failed AS (
  SELECT doc_id, part, [a, b, c, d, coalesce(doc_id > first_id, false)] AS f
  FROM flags JOIN firsts ON t = of_text),
marks AS (
  SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, f, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks ON doc_id = id GROUP BY part, f),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
         s.i AS step, o[s.i] AS own_filter, o[:s.i - 1] AS earlier FROM orders, letters s),
effects AS (
  SELECT part, filter_order, step, own_filter, n, good, toxic, f[own_filter] AS fails,
         len(list_filter(earlier, lambda x: f[x])) > 0 AS gone,
         len(list_filter(f, lambda x: x)) AS n_failed FROM counts, steps),
told AS (
  SELECT part, filter_order, step, own_filter,
         sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND n_failed = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM effects GROUP BY part, filter_order, step, own_filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own_filter) AS BIGINT) AS shapley
FROM told
"""
