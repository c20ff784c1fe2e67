"""Periodic runs of a text's words, by match lengths along diagonals.

The diagonal of lag d holds the words that equal the word d places before.
Each word's earlier occurrences add one to the match lengths of their lags; a
lag that the next word does not continue ends, and if it has matched long
enough it gives a run: the matched words and the d words before them. Only
lags that match are held, and the words of many documents pass through
together, a lag or a class of lags at a time, as arrays.

*Which occurrences.* Up to ``SHORT_LAG`` words back every earlier occurrence
counts. Taking all of them for longer lags would be quadratic in a word's
frequency, so lags in (g/2, g], g = 64, 128, 256, ..., take the nearest earlier
occurrence of the g words that start at a word. No run is lost: in a run with
least period d <= g, any g words have their nearest earlier occurrence exactly
d words back (a nearer one would give those words a shorter period, and with it
the run), and a run of three periods has such words. Only words whose last
class had an earlier occurrence are looked at in the next one, so texts without
long repeats cost one sort.

A run is a stretch of words with least period q, at least ``least_words`` and
``exponent`` periods long, that no neighbouring word extends. A multiple of q
makes the same stretch, which is then given with q. ``collapsed`` is the text
without the words that any run has after its first period.

Inputs: null text is the empty text, which has no words, no runs and collapses
to the empty text. Rows are independent: repeated rows and ids give a row each,
and a null ``doc_id`` is carried (op12 does not edit such a row, as it has no
hash). Words are split at ASCII white space and compared by 64-bit hashes of
their bytes. Long texts are worked on whole, in memory in proportion to their
words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NON_SPACE_BYTES, add_columns, char_groups, mix64, table, utf8_texts, word_hashes

LEAST_WORDS = 6
EXPONENT = 4
#: Lags up to this are compared word by word.
SHORT_LAG = 32


def _stretches(at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the stretches of consecutive numbers in ``at`` (rising)
    whose neighbours have ``same`` set (one flag per neighbour pair)."""
    cuts = np.flatnonzero((np.diff(at) != 1) | ~same)
    return at[np.concatenate([[0], cuts + 1])], at[np.concatenate([cuts, [len(at) - 1]])]


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, end, least period) of all runs of a sequence of word hashes,
    by start, then period."""
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found by nearest occurrences")
    found: list[np.ndarray] = []
    n = len(words)

    def ended(first: np.ndarray, last: np.ndarray, lag: np.ndarray) -> None:
        """Diagonals that matched the words first .. last."""
        size = last - first + 1 + lag
        enough = (size >= least_words) & (size >= exponent * lag)
        if enough.any():
            found.append(np.stack([(first - lag)[enough], (last + 1)[enough], lag[enough]], axis=1))

    for lag in range(1, min(SHORT_LAG, n // exponent) + 1):
        at = np.flatnonzero(words[lag:] == words[:-lag]) + lag
        if len(at):
            first, last = _stretches(at, np.ones(len(at) - 1, dtype=bool))
            ended(first, last, np.full(len(first), lag))

    gram, size = words, 1
    at = np.arange(n)  # starts of grams that may have an earlier occurrence
    while size < n // exponent and len(at):
        # hashes of twice as many words, at every start that has them
        gram = mix64(gram[:-size] * np.uint64(0x9E3779B97F4A7C15) + gram[size:]) if n > size else gram[:0]
        size, n_grams = 2 * size, len(gram) - size
        if size <= SHORT_LAG:
            continue
        at = at[at < len(gram)]
        if not len(at):
            break
        order = np.argsort(gram[at], kind="stable")
        key, place = gram[at][order], at[order]
        again = np.flatnonzero(key[1:] == key[:-1])
        starts, lags = place[again + 1], place[again + 1] - place[again]
        rising = np.argsort(starts)
        starts, lags = starts[rising], lags[rising]
        near = (lags <= size) & (lags > max(size // 2, SHORT_LAG))
        if near.any():
            of, lag = starts[near], lags[near]
            first, last = _stretches(of, lag[1:] == lag[:-1])
            ended(first, last + size - 1, lag[np.searchsorted(of, first)])
        at = np.unique(np.concatenate([place[again], starts]))
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    least = np.ones(len(runs), dtype=bool)  # of equal stretches the least period
    least[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run has after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def collapse(texts: list[bytes], least_words: int = LEAST_WORDS,
             exponent: int = EXPONENT) -> list[tuple[int, np.ndarray, bytes]]:
    """Number of words, runs and collapsed text of every text."""
    out = []
    for a, b in char_groups(texts):
        whole = b"\n".join(texts[a:b])
        hashes, starts, _ = word_hashes(whole, NON_SPACE_BYTES)
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        counts = np.diff(np.searchsorted(starts, ends, side="left"), prepend=0)
        # words of different texts never match
        salted = mix64(hashes ^ np.repeat(mix64(np.arange(1, b - a + 1)), counts))
        runs = runs_of(salted, least_words, exponent)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        cuts = np.searchsorted(runs[:, 0], firsts)
        for i, t in enumerate(texts[a:b]):
            own = runs[cuts[i] : cuts[i + 1]] - [firsts[i], firsts[i], 0]
            words = t.split()
            if len(own):
                words = [words[j] for j in np.flatnonzero(kept_words(len(words), own))]
            out.append((int(counts[i]), own, b" ".join(words)))
    return out


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", least_words: int = LEAST_WORDS,
                  exponent: int = EXPONENT) -> DataFrame:
    """Columns ``keep`` and, for every whole text, n_words, runs (by start, then
    period) and collapsed, the text without its repeats."""

    def run(column: pa.Array) -> list[pa.Array]:
        found = collapse(utf8_texts(column), least_words, exponent)
        table_ = np.concatenate([x[1] for x in found]) if found else np.zeros((0, 3), dtype=np.int64)
        offsets = np.cumsum([0, *(len(x[1]) for x in found)]).astype(np.int32)
        struct = pa.StructArray.from_arrays(
            [pa.array(table_[:, 0]), pa.array(table_[:, 1] - table_[:, 0]), pa.array(table_[:, 2])],
            fields=list(_RUNS.value_type))
        return [pa.array([x[0] for x in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), struct).cast(_RUNS),
                pa.array([x[2] for x in found], pa.binary()).cast(pa.string())]

    return add_columns(docs, [text], "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                       "collapsed string", run, keep)


def edited(docs: DataFrame) -> DataFrame:
    """doc_id and the text; in one document of ten, by the id's crc32, the words
    from a place on are replaced by the period that begins there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    # a: the first replaced word, p: how many there are
    placed = (docs.select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g"))
              .withColumn("n", F.size("w").cast("bigint"))
              .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
              .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    from_word = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get("w", F.when(
        i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("w").isNull(), F.col("text"))
                         .otherwise(F.array_join(from_word, " ")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten of them edited."""
    found = periodic_runs(edited(table(spark, sf_dir, "documents")), ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("longest"),
                        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
                        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    length, period = F.col("longest.length"), -F.col("longest.period")
    return told.select("doc_id", "n_runs", (-F.col("longest.start")).alias("start"), length.alias("length"),
                       period.alias("period"), F.expr("1000 * longest.length div -longest.period").alias(
                           "exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")
