"""Language identification by compression.

One zstandard raw-content dictionary per language is cut from a bounded sample
of training texts. Texts are compared without case, as a dictionary holds few
capitals. A text is compressed whole with each dictionary; the
language of the smallest result is chosen. Where the smallest and the next are
within ``REJECT_MARGIN`` of each other the choice is marked as rejected.

Inputs: a null text, or one without a letter, is ``und`` with score 0. Rows
with null ``lang`` are not learned from. Without any training row every text
is ``und``. Equal sizes go to the language that sorts first. Other columns are
kept by ``identified``.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import add_columns, crc_remainder, table

#: Training texts per language, at most, and bytes of its dictionary.
SAMPLE_PER_LANGUAGE = 300
DICTIONARY_BYTES = 256 * 1024
#: Of one text at most so much is taken, so that none fills a dictionary.
SLICE_BYTES = 8 * 1024
#: Faster levels search a dictionary too little to tell languages apart.
LEVEL = 9
#: A margin (relative to the smallest size) below this is too narrow.
REJECT_MARGIN = 0.01
UNKNOWN = "und"


def sampled(docs: DataFrame) -> DataFrame:
    """lang, place and text of at most SAMPLE_PER_LANGUAGE distinct rows of id
    and text per language, the first by a hash of the id, each cut to
    SLICE_BYTES characters. Copies go within the tasks, before rows are ranked
    and after they are found again."""
    known = docs.select("doc_id", "lang", "text").filter(
        "lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    which = known.select("doc_id", "lang", F.xxhash64("text").alias("of_text")).distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "of_text")
    chosen = (which.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= SAMPLE_PER_LANGUAGE)
              .select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang"), "of_text", "place"))
    # SAMPLE_PER_LANGUAGE short rows a language
    rows = known.join(F.broadcast(chosen), (F.col("doc_id") == F.col("chosen_id")) &
                      (F.col("lang") == F.col("chosen_lang")) & (F.xxhash64("text") == F.col("of_text")))
    return (rows.groupBy("lang", "place").agg(F.min(F.substring("text", 1, SLICE_BYTES)).alias("text")))


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary content by language, from rows with text and language: an
    equal slice of each sampled text, until the dictionary is full."""
    out: dict[str, bytes] = {}
    for r in sorted(sampled(docs).collect(), key=lambda r: (r["lang"], r["place"])):
        held = out.get(r["lang"], b"")
        if len(held) < DICTIONARY_BYTES:
            out[r["lang"]] = (held + r["text"].lower().encode()[:SLICE_BYTES] + b"\n")[:DICTIONARY_BYTES]
    return out


@lru_cache(maxsize=4)
def _compressors(content: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, raw in content:
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False,
                                                   write_content_size=False, write_dict_id=False)))
    return out


def choose(text: bytes | None, content: tuple[tuple[str, bytes], ...]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow."""
    low = (text or b"").decode("utf-8", "replace").lower()
    if not content or not any(map(str.isalpha, low)):
        return UNKNOWN, 0.0, True
    raw = low.encode()
    sizes = sorted((len(c.compress(raw)), lang) for lang, c in _compressors(content))
    best = sizes[0][0]
    # a byte more is taken as half as likely
    score = 1 / sum(2.0 ** -min(n - best, 60) for n, _ in sizes)
    narrow = len(sizes) > 1 and sizes[1][0] - best < REJECT_MARGIN * best
    return sizes[0][1], score, narrow


def identified(docs: DataFrame, content: dict[str, bytes], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and lang_pred, score, rejected for every whole text."""
    held = tuple(sorted(content.items()))

    def run(col: pa.Array) -> list[pa.Array]:
        found = [choose(t, held) for t in col.cast(pa.binary()).to_pylist()]
        lang, score, narrow = zip(*found) if found else ((), (), ())
        return [pa.array(list(lang), pa.string()), pa.array(list(score), pa.float64()),
                pa.array(list(narrow), pa.bool_())]

    return add_columns(docs, ["text"], "lang_pred string, score double, rejected boolean", run,
                       [c for c in keep if c not in ("lang_pred", "score", "rejected")])


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    fold = crc_remainder(F.col("doc_id"), 3)
    found = identified(docs, dictionaries(docs.filter(fold != 1)), ["doc_id"])
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")
