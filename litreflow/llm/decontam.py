"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer
words, but not none, is one window). Every text is reduced to fingerprints:
of each window's ``GRAM``-word hashes the least is kept (the leftmost of
equal ones), so a document that holds an item's window holds its fingerprint
too. Documents and windows are joined on fingerprints, every hit is extended
to the whole window and compared word by word, and the words inside any
occurrence are counted as hit.

Inputs: a null text has no words. Rows with the same ``doc_id`` are judged by
their own texts; a null ``doc_id`` is kept as it is. A null ``item_id`` marks
words as hit but is not listed. With an empty benchmark nothing is hit. Other
columns of documents are kept by ``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, fresh, table

WINDOW = 10
GRAM = 5
#: Bytes of windows (their words, and 60 for each) that are broadcast at most;
#: with more, both sides are shuffled.
BROADCAST_BYTES = 32_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words as an array."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, _SEPARATORS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _upto(last: Column) -> Column:
    """0 .. last as an array, empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))


def _grams(hashes: Column, k: int) -> Column:
    """Hash of every k consecutive word hashes."""
    return F.transform(_upto(F.size(hashes) - k), lambda i: F.xxhash64(
        F.lit(k), *[F.get(hashes, i + j) for j in range(k)]))


def _least(grams: Column) -> Column:
    """Where the window that starts at each gram has its least gram."""
    span = WINDOW - GRAM + 1

    def place(i: Column) -> Column:
        return _let(F.slice(grams, i + 1, span), lambda x: (
            i + F.array_position(x, F.array_min(x)).cast("int") - 1))

    return F.transform(_upto(F.size(grams) - span), place)


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, win, len, off, hash): every window as a string, the place and
    the hash of its fingerprint."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter("size(words) > 0")
    kind = "array<struct<win:string,len:int,off:int,hash:bigint>>"

    def long(words: Column) -> Column:
        return _let(_grams(_hashed(words), GRAM), lambda g: F.zip_with(
            _least(g), _upto(F.size(words) - WINDOW), lambda at, i: F.struct(
                F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("win"),
                F.lit(WINDOW).alias("len"), (at - i).alias("off"), F.get(g, at).alias("hash"))))

    def short(words: Column) -> Column:
        choices = F.lit(None).cast("bigint")
        for k in range(1, WINDOW):
            choices = F.when(F.size(words) == k, F.get(_grams(_hashed(words), k), F.lit(0))).otherwise(choices)
        return F.array(F.struct(F.array_join(words, " ").alias("win"), F.size(words).alias("len"),
                                F.lit(0).alias("off"), choices.alias("hash")))

    made = F.when(F.size("words") >= WINDOW, _let(F.col("words"), long).cast(kind)).otherwise(
        short(F.col("words")).cast(kind))
    return items.select("item_id", F.explode(made).alias("w")).select("item_id", "w.*")


def _fingerprints(text: Column, short_lengths: list[int]) -> Column:
    """array<struct<at, hash>> of a document."""
    def of(hashes: Column) -> Column:
        main = _let(_grams(hashes, GRAM), lambda g: F.transform(
            F.array_distinct(_least(g)), lambda p: F.struct(p.alias("at"), F.get(g, p).alias("hash"))))
        each = [main]
        for k in short_lengths:
            each.append(_let(_grams(hashes, k), lambda g: F.transform(
                _upto(F.size(g) - 1), lambda p: F.struct(p.alias("at"), F.get(g, p).alias("hash")))))
        return F.concat(*each) if len(each) > 1 else main

    return _let(_hashed(words_of(text)), of)


def judged(docs: DataFrame, wins: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns, whose names are returned: number of
    words, number of hit words, and the windows that occur."""
    known = checkpointed(wins.select("win", "len", "off", "hash").distinct())
    facts = known.agg(F.coalesce(F.sum(F.octet_length("win") + F.lit(60).cast("bigint")), F.lit(0)),
                      F.collect_set(F.when(F.col("len") < WINDOW, F.col("len")))).first()
    if facts[0] <= BROADCAST_BYTES:
        known = F.broadcast(known)
    names = [fresh(x, docs) for x in ("n_words", "n_hit", "found")]
    key, hit_id, hit_key, own_hits = (fresh(x, docs) for x in ("text_key", "hit_id", "hit_key", "hits"))
    keyed = docs.withColumn(key, F.xxhash64("text"))
    hits = (docs.select("doc_id", F.xxhash64("text").alias(key), F.explode(_fingerprints(F.col("text"), sorted(facts[1])))
                         .alias("f"))
            .select("doc_id", key, "f.at", "f.hash")
            .join(known, "hash").filter(F.col("at") >= F.col("off"))
            .groupBy("doc_id", key)
            .agg(F.collect_set(F.struct((F.col("at") - F.col("off")).alias("start"), "len", "win"))
                 .alias(own_hits))
            .select(F.col("doc_id").alias(hit_id), F.col(key).alias(hit_key), own_hits))

    def verified(words: Column) -> Column:
        right = F.filter(F.col(own_hits), lambda x: F.array_join(
            F.slice(words, x["start"] + 1, x["len"]), " ") == x["win"])
        spans = lambda r: F.array_sort(F.transform(r, lambda x: F.struct(
            x["start"].alias("a"), (x["start"] + x["len"]).alias("b"))))
        covered = lambda r: F.aggregate(
            spans(r), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda acc, x: F.struct(
                F.greatest(acc["end"], x["b"]).alias("end"),
                (acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(acc["end"], x["a"]))).alias("n")),
            lambda acc: acc["n"])
        return _let(right, lambda r: F.struct(
            F.size(words).alias("words"), covered(r).alias("hit"),
            F.array_distinct(F.transform(r, lambda x: x["win"])).alias("wins")))

    both = keyed.join(hits, F.col("doc_id").eqNullSafe(F.col(hit_id)) &
                      (F.col(key) == F.col(hit_key)), "left")
    verdict = F.when(F.col(own_hits).isNull(), F.struct(
        F.size(words_of(F.col("text"))).alias("words"), F.lit(0).alias("hit"),
        F.array().cast("array<string>").alias("wins"))).otherwise(
        _let(words_of(F.col("text")), verified))
    out = both.withColumn(names[2], verdict).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(names[2])["words"].cast("long").alias(names[0]),
        F.col(names[2])["hit"].cast("long").alias(names[1]),
        F.col(names[2])["wins"].alias(names[2]))
    return out, names


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit word, columns as in ``docs``."""
    found, (_, hit, _) = judged(docs, windows(benchmark))
    return found.filter(F.col(hit) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words and items of every document."""
    wins = checkpointed(windows(benchmark))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found, (n_words, n_hit, occurring) = judged(rows, wins)
    found = checkpointed(found.select("doc_id", F.xxhash64("text").alias("text_key"),
                                      n_words, n_hit, occurring))
    items = (found.filter(F.col(n_hit) > 0).select("doc_id", "text_key", F.explode(occurring).alias("win"))
             .distinct()
             .join(wins.filter("item_id IS NOT NULL")
                   .select(F.col("item_id").cast("string").alias("item"), "win").distinct(), "win")
             .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
             .select(F.col("doc_id").alias("item_doc"), F.col("text_key").alias("item_key"), "items"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return found.join(items, F.col("doc_id").eqNullSafe(F.col("item_doc")) &
                      (F.col("text_key") == F.col("item_key")), "left").select(
        "doc_id", n_words, n_hit,
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(n_hit) > 0).alias("contaminated"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i + 1 : i + size], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(len(w) - least(10, len(w)) + 1)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, size, i, array_to_string(w[i + 1 : i + size], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(len(w) - size + 1)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
hits AS (SELECT rid, dw.size, i, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
positions AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN positions USING (rid) LEFT JOIN items USING (rid)
"""
