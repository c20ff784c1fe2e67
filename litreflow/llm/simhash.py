"""SimHash near-duplicates: 64-bit fingerprints, exact tiled comparison, components.

Fingerprints within ``radius`` bits are linked. Equal fingerprints are one
class first, so copies never make pairs. Two distinct fingerprints within the
radius agree on at least ``bands - radius`` of ``bands`` bit blocks, so every
such pair meets under one of the block combinations; there, tiles of
fingerprints are compared with exclusive-or and bit counts, and tile pairs
whose population counts differ by more than the radius are skipped. A tile
pair returns a spanning forest of its links, never all pairs. A combination
value held by more than ``TILE`` fingerprints is dealt out as tile pairs over
many tasks.

Inputs: null text is the empty text. A text without words has fingerprint
zero and is linked like any other. Rows with the same ``doc_id`` are
fingerprinted each. A null ``doc_id`` takes part, and counts as larger than
any other; a component of null ids only has a null id. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, checkpointed, fresh, table, utf8_texts

#: Fingerprints in one tile of a block value that many share.
TILE = 16_384
#: Rows and columns of one exclusive-or.
BLOCK = 512
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:])],
                      dtype=np.uint64)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprinted(docs: DataFrame, keep: list[str], shingle: int = 3, name: str = "fp") -> DataFrame:
    """Columns ``keep`` and the signed fingerprint of ``text``."""
    return add_columns(
        docs, ["text"], f"`{name}` bigint",
        lambda col: [pa.array([fingerprint(t, shingle) for t in utf8_texts(col)], pa.int64())], keep)


# -- comparison ------------------------------------------------------------
def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j; ``label`` holds each item's class root."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what is connected among distinct prints."""
    prints = np.unique(prints)
    if len(prints) < 2:
        return prints[:0], prints[:0]
    counts = np.bitwise_count(prints.view(np.uint64)).astype(np.int16)
    order = np.argsort(counts, kind="stable")
    prints, counts = prints[order], counts[order]
    bits = prints.view(np.uint64)
    label = np.arange(len(prints))
    for a in range(0, len(prints), BLOCK):
        left = bits[a : a + BLOCK, None]
        reach = counts[min(a + BLOCK, len(prints)) - 1] + radius
        for b in range(a, len(prints), BLOCK):
            if counts[b] > reach:
                break
            near = np.bitwise_count(left ^ bits[None, b : b + BLOCK]) <= radius
            i, j = np.nonzero(near)
            apart = i + a < j + b
            _unite(label, i[apart] + a, j[apart] + b)
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[label[linked]], prints[linked]


def _forests(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, fp) sorted by tile -> links."""
    tile = prints = np.zeros(0, dtype=np.int64)

    def made(groups: list[np.ndarray]) -> pa.RecordBatch:
        found = [forest(g, radius) for g in groups if len(g) > 1]
        a = np.concatenate([x for x, _ in found]) if found else prints[:0]
        b = np.concatenate([y for _, y in found]) if found else prints[:0]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        tile = np.concatenate([tile, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy()])
        cuts = np.flatnonzero(np.diff(tile)) + 1
        if len(cuts):
            yield made(np.split(prints[: cuts[-1]], cuts[:-1]))
            tile, prints = tile[cuts[-1]:], prints[cuts[-1]:]
    if len(prints):
        yield made([prints])


def links(prints: DataFrame, radius: int = 3, bands: int = 5) -> DataFrame:
    """Links (a, b) among the distinct ``fp`` of ``prints``."""
    edges = [64 * k // bands for k in range(bands + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(x) for x in combinations(blocks, bands - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(signed)])).alias("k")).select("fp", "k.band", "k.key")
    # written, like the least neighbours below: a join can be split over tasks
    # at a hot key only where both of its sides are plain shuffles
    shared = checkpointed(keyed.groupBy("band", "key").count().filter("count > 1"))
    met = keyed.join(shared, ["band", "key"])
    small = met.filter(F.col("count") <= TILE).select(
        F.xxhash64("band", "key").alias("tile"), "fp")
    # block values that many fingerprints share: tiles by population count
    large = (met.filter(F.col("count") > TILE).drop("count")
             .withColumn("ones", F.bit_count("fp").cast("int")))
    parts = (large.groupBy("band", "key", "ones")
             .agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")))
    sizes = parts.groupBy("band", "key").agg(
        F.map_from_entries(F.collect_list(F.struct("ones", "parts"))).alias("sizes"))
    name = lambda ones, part: ones * (1 << 24) + part
    own = large.join(sizes, ["band", "key"]).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("sizes")[F.col("ones")]).cast("int"))
    dealt = (own.withColumn("other", F.explode(F.sequence(F.col("ones") - radius, F.col("ones") + radius)))
             .withColumn("other_parts", F.try_element_at("sizes", F.col("other")))
             .filter("other_parts IS NOT NULL")
             .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
             .withColumn("mine", name(F.col("ones"), F.col("part")))
             .withColumn("its", name(F.col("other"), F.col("other_part")))
             .select(F.xxhash64("band", "key", F.least("mine", "its"), F.greatest("mine", "its"))
                     .alias("tile"), "fp"))
    # two block values with one tile hash are compared together, which is harmless
    tiles = small.unionByName(dealt).repartition("tile").sortWithinPartitions("tile")
    return tiles.mapInArrow(lambda it: _forests(it, radius), "a bigint, b bigint").distinct()


# -- components ------------------------------------------------------------
def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root: the least node.

    Alternates large and small stars; each round is written to the shared
    folder, and only a count and a checksum come to the driver.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = checkpointed(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = checkpointed(large)
        small_least = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (large.join(small_least, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small_least.select("a", F.col("m").alias("b"))).distinct())
        edges = checkpointed(small)
        after = state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")))
            .distinct())


def classes(prints: DataFrame, radius: int = 3, bands: int = 5) -> DataFrame:
    """Distinct ``fp`` of ``prints`` (doc_id, fp) with the component's root
    fingerprint ``root`` and least ``doc_id`` ``component_id``."""
    least = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = connected(links(least.select("fp"), radius, bands))
    rooted = (least.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(first, "root")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, bands: int = 5) -> DataFrame:
    """doc_id, fp, root, component_id of every row of ``docs``."""
    prints = checkpointed(fingerprinted(docs, ["doc_id"], shingle))
    return prints.join(classes(prints, radius, bands), "fp").select(
        "doc_id", "fp", "root", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component: that of the least ``doc_id`` (of several
    rows with that id, one of the least fingerprint). Columns as in ``docs``."""
    fp = fresh("simhash", docs)
    found = near_duplicates(docs, shingle, radius)
    kept = (found.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("k"))
            .select(F.col("k.doc_id").alias("kept_id"), F.col("k.fp").alias("kept_fp")))
    rows = fingerprinted(docs, docs.columns, shingle, name=fp)
    return (rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows[fp] == kept["kept_fp"]),
                      "left_semi")
            .dropDuplicates(["doc_id", fp]).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
