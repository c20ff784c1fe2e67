"""Sequences of bounded length packed by few-document patterns.

Every text becomes its token ids and one end id; a longer document is cut into
whole sequences and a rest, losslessly. What is planned is the histogram of
piece lengths (at most ``sequence_length`` numbers), never the pieces:

1. *Patterns.* Lengths are put in bins, rounded up; every way to fill a
   sequence with at most a few bins is a pattern, a column of a matrix whose
   rows are the bins.
2. *Fit.* Non-negative least squares finds how often each pattern is to be
   used so that the bins' counts are met; a bin weighs as much as its length,
   so long pieces are met closely and short ones are left over.
3. *Round.* Repeat counts are rounded down and held to the pieces there are;
   each repeat takes the longest pieces left of its bins, and as its last one
   the longest piece that still fits.
4. *Residuals*, the pieces that no pattern took, go by falling length into the
   least sufficient room that patterns have left, then into new sequences.

Several bin widths are planned so; the plan with the fewest sequences is kept.
It is a list of runs: "so many sequences from this number on have, at this
offset, so many pieces of this length". Pieces are numbered within their
length by a distributed count, and a piece's number is looked up in the runs.

Inputs: a null or empty text has the end id only, one piece of length 1. Rows
with the same ``doc_id`` are packed each; a null ``doc_id`` is carried as
null. An empty table has no pieces. Other columns are not read. Strings of
special tokens in a text are ordinary text. Equal inputs in another
partitioning take the same number of sequences; which of several pieces of one
length takes which place may differ.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import add, not_

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import char_groups, checkpointed, return_memory, slices, table, utf8_texts

VOCABULARY = "word_bpe_49k.json"
SEQUENCE_LENGTH = 4096
END_ID = 1
#: (bins of a sequence, most pieces in a pattern), each planned.
SHAPES = ((128, 2), (64, 3), (128, 3), (64, 4), (256, 2))
#: Pieces of one length are numbered in groups of about so many.
GROUP_PIECES = 4096
#: Characters that the tokenizer works on at once (its results are large).
BATCH_CHARS = 300_000
#: Bytes of texts whose words are looked up at once.
GROUP_BYTES = 250_000
#: Words of which the ids are kept, and the longest of them in bytes.
HELD_WORDS, HELD_BYTES = 500_000, 80


# -- pieces ----------------------------------------------------------------
@lru_cache(maxsize=4)
def _tokenizer(name_or_path: str, plain: bool = False) -> Tokenizer:
    """The tokenizer; ``plain``: for lower-case words of letters with one space
    between, which need neither normalisation nor the splitting pattern."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    if plain:
        made.normalizer = None
        made.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


#: Lower-case letters, each one letter in either case, and marks after a word.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_MARKS = b".,;:!?"
#: Capitals of Latin-1 in UTF-8, the second byte of a lower-case letter is 32 more.
_CAPITALS = re.compile(b"\xc3[\x80-\x96\x98-\x9e]")
_LOWER = {bytes((0xC3, x)): bytes((0xC3, x + 32)) for x in range(0x80, 0x9F)}
#: First bytes of U+0300 to U+037F: marks that may join a small letter only.
_JOINING = re.compile(b"[\xcc\xcd]")


def _split(text: bytes) -> list[bytes]:
    """Words between ASCII white space; letters up to U+00FF in lower case, as
    the tokenizer makes them, unless a mark may change with them."""
    if _JOINING.search(text) is None:
        text = _CAPITALS.sub(lambda m: _LOWER[m[0]], text.lower())
    return text.split()


class WordIds:
    """Ids of texts, from the ids of their words.

    No token spans ASCII white space, and neither normalisation nor splitting
    looks across it, so a text's ids are those of its words between white
    space, each encoded once by the library and kept while there is room: what
    was not met since the store was half full goes. Words of letters only are
    one unit of the tokenizer each: many are encoded as one text and told apart
    by the tokens that end a unit.
    """

    def __init__(self, vocabulary: str) -> None:
        made = _tokenizer(vocabulary)
        self.encode = made.encode_batch_fast
        self.encode_plain = _tokenizer(vocabulary, plain=True).encode_batch_fast
        # of words, and of words of letters without the marks after them; each
        # with what was kept before
        self.held: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.letters: dict[bytes, bytes] = {}
        self.older_letters: dict[bytes, bytes] = {}
        suffix = getattr(made.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            self.ends = np.zeros(made.get_vocab_size(), dtype=bool)
            self.ends[[i for token, i in made.get_vocab().items() if token.endswith(suffix)]] = True

    def __call__(self, docs: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        for a, b in char_groups(docs, GROUP_BYTES):
            words = [_split(t) for t in docs[a:b]]
            if len(self.held) > HELD_WORDS // 2:
                self.held, self.older = {}, self.held
            if len(self.letters) > HELD_WORDS // 2:
                self.letters, self.older_letters = {}, self.letters
            new = _missing(set().union(*words), self.held, self.older)
            self._learn(new)
            for own in words:
                yield b"".join(map(self.held.__getitem__, own))
            for word in new:
                if len(word) > HELD_BYTES:
                    del self.held[word]

    def _learn(self, new: list[bytes]) -> None:
        """Hold the ids of new words."""
        held, letters = self.held, self.letters
        stems = list(map(bytes.rstrip, new, repeat(_MARKS)))
        if self.ends is not None:
            unknown = [w for w in _missing(set(stems), letters, self.older_letters) if len(w) <= HELD_BYTES]
            strings = _strings(unknown)
            plain = list(map(_PLAIN.fullmatch, strings))
            unknown, strings = list(compress(unknown, plain)), list(compress(strings, plain))
            for i, j in char_groups(strings, BATCH_CHARS):
                letters.update(zip(unknown[i:j], self._units(strings[i:j])))
        there = list(map(letters.__contains__, stems))
        words, stems = list(compress(new, there)), list(compress(stems, there))
        marks = list(map(bytes.removeprefix, words, stems))
        kinds = list(set(marks) - {b""})
        of_mark = dict(zip(kinds, self._each(_strings(kinds))))
        of_mark[b""] = b""
        held.update(zip(words, map(add, map(letters.__getitem__, stems), map(of_mark.__getitem__, marks))))
        whole = list(compress(new, map(not_, there)))
        held.update(zip(whole, self._each(_strings(whole))))

    def _each(self, strings: list[str]) -> Iterator[bytes]:
        for i, j in char_groups(strings, BATCH_CHARS):
            for found in self.encode(strings[i:j], add_special_tokens=False):
                yield array("I", found.ids).tobytes()

    def _units(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters, encoded as one text."""
        ids = np.array(self.encode_plain([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):  # not one unit each
            yield from self._each(words)
            return
        raw, cuts = ids.tobytes(), (4 * cuts).tolist()
        yield from map(raw.__getitem__, map(slice, [0, *cuts], cuts))


def _missing(words: set[bytes], held: dict[bytes, bytes], older: dict[bytes, bytes]) -> list[bytes]:
    """The words that are not held; those held before are again."""
    new = words.difference(held)
    again = list(filter(older.__contains__, new))
    held.update(zip(again, map(older.__getitem__, again)))
    return list(new.difference(again))


def _strings(words: list[bytes]) -> list[str]:
    """Words without white space as strings; invalid UTF-8 gives U+FFFD."""
    return b" ".join(words).decode("utf-8", "replace").split(" ") if words else []


@lru_cache(maxsize=1)
def _word_ids(vocabulary: str) -> WordIds:
    """One per worker: the next tasks have many of the same words."""
    return WordIds(vocabulary)


def pieces(docs: DataFrame, sequence_length: int = SEQUENCE_LENGTH, vocabulary: str = VOCABULARY,
           end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary)
    of every piece of at most ``sequence_length`` ids."""
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = _word_ids(vocabulary), array("I", [end_id]).tobytes()
        for batch in slices(batches):
            rows, counts = [], []
            for ids in ids_of(utf8_texts(batch.column(1))):
                ids += end
                cuts = range(0, len(ids), 4 * sequence_length)
                counts.append(len(cuts))
                for k, at in enumerate(cuts):
                    raw = ids[at : at + 4 * sequence_length]
                    rows.append((k, at // 4, len(raw) // 4, zlib.crc32(raw), raw)[: len(fields)])
            doc = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            columns = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [doc, *[pa.array(c, kind) for c, (_, kind) in zip(columns, fields)]],
                names=["doc_id", *[name for name, _ in fields]])
        return_memory()

    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length int, "
              "ids_crc32 bigint" + (", ids binary" if with_ids else ""))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# -- the plan --------------------------------------------------------------
def patterns(units: int, most: int) -> list[tuple[int, ...]]:
    """Every way to write ``units`` as a falling sum of at most ``most`` parts."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, largest: int, parts: tuple[int, ...]) -> None:
        if not left:
            out.append(parts)
        elif len(parts) < most:
            least = -(-left // (most - len(parts)))  # the rest must still fit
            for part in range(min(left, largest), least - 1, -1):
                grow(left - part, part, (*parts, part))

    grow(units, units, ())
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least ||a x - b||, by an active set of columns."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0))) * max(1.0, float(np.abs(a).max(initial=0.0)))
    for _ in range(3 * a.shape[0] + 10):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        if not len(gain) or gain.max() <= tolerance:
            break
        active[int(gain.argmax())] = True
        while active.any():
            fitted = np.zeros_like(x)
            fitted[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            below = active & (fitted <= 0)
            if not below.any():
                x = fitted
                break
            step = (x[below] / np.maximum(x[below] - fitted[below], 1e-300)).min()  # as far as all stay above zero
            x = x + step * (fitted - x)
            active &= x > 1e-12
            x[~active] = 0.0
    return x


class Plan:
    """Runs of equal places: pieces ``first`` .. of length ``length`` take
    ``each`` places a sequence from ``offset`` on, from sequence ``sequence`` on.

    Pieces are counted by falling length; ``base[length]`` is the number of the
    first of its length.
    """

    def __init__(self, histogram: dict[int, int], sequence_length: int) -> None:
        self.sequence_length = sequence_length
        self.left = {n: c for n, c in sorted(histogram.items(), reverse=True) if c}
        self.base = dict(zip(self.left, np.cumsum([0, *self.left.values()]).tolist()))
        self.used = dict.fromkeys(self.left, 0)
        self.there = sorted(self.left)  # lengths of which pieces may be left
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # first, sequence, offset, length, each
        self.room: dict[int, list[tuple[int, int]]] = {}  # free -> sequences from, how many
        self.sizes: list[int] = []  # free sizes that some sequence has, rising

    def _place(self, length: int, count: int, sequence: int, offset: int, each: int = 1) -> None:
        self.runs.append((self.base[length] + self.used[length], sequence, offset, length, each))
        self.used[length] += count
        self.left[length] -= count

    def _free(self, size: int, sequence: int, count: int) -> None:
        if size and count:
            if size not in self.room:
                self.room[size] = []
                insort(self.sizes, size)
            self.room[size].append((sequence, count))

    def repeat(self, pattern: list[list[int]], times: int) -> None:
        """``times`` new sequences, each with a piece of every list of lengths,
        the longest that are left; the last piece is the longest that fits."""
        spans = [(self.sequences, times, 0)]
        self.sequences += times
        for k, lengths in enumerate(pattern):
            filled = []
            queue = iter([n for n in lengths if self.left[n]])
            length = next(queue, 0)
            for sequence, count, offset in spans:
                while count:
                    if k and k == len(pattern) - 1:
                        length = self._longest(self.sequence_length - offset)
                    while length and not self.left[length]:
                        length = next(queue, 0)
                    if not length:
                        filled.append((sequence, count, offset))
                        break
                    taken = min(count, self.left[length])
                    self._place(length, taken, sequence, offset)
                    filled.append((sequence, taken, offset + length))
                    sequence, count = sequence + taken, count - taken
            spans = filled
        for sequence, count, offset in spans:
            self._free(self.sequence_length - offset, sequence, count)

    def _longest(self, room: int) -> int:
        """The greatest length that is left and at most ``room`` (none: 0)."""
        while True:
            at = bisect_right(self.there, room) - 1
            if at < 0:
                return 0
            if self.left[self.there[at]]:
                return self.there[at]
            del self.there[at]

    def best_fit(self) -> None:
        """What is left, by falling length, into the least sufficient room.

        All pieces of a length go at once: the room that takes one of them
        stays the least sufficient until it is full.
        """
        for length in list(self.left):
            while self.left[length]:
                at = bisect_left(self.sizes, length)
                if at < len(self.sizes):
                    size = self.sizes[at]
                    sequence, count = self.room[size].pop()
                    if not self.room[size]:
                        del self.room[size], self.sizes[at]
                else:
                    size = self.sequence_length
                    sequence, count = self.sequences, -(-self.left[length] // (size // length))
                    self.sequences += count
                offset, each = self.sequence_length - size, size // length
                whole = min(count, self.left[length] // each)
                if whole:
                    self._place(length, whole * each, sequence, offset, each)
                    self._free(size - each * length, sequence, whole)
                rest = self.left[length] if whole < count else 0  # fewer than a sequence takes
                if rest:
                    self._place(length, rest, sequence + whole, offset, rest)
                    self._free(size - rest * length, sequence + whole, 1)
                    whole += 1
                self._free(size, sequence + whole, count - whole)


def fitted(histogram: dict[int, int], sequence_length: int, units: int, most: int) -> Plan:
    """The plan with ``units`` bins and patterns of at most ``most`` pieces."""
    plan = Plan(histogram, sequence_length)
    units = min(units, sequence_length)
    width = sequence_length // units
    bins: dict[int, list[int]] = {}
    for length in plan.left:  # falling; the last bin has what rounding leaves out
        bins.setdefault(min(units, -(-length // width)), []).append(length)
    # lengths of the last bin beyond its edge fit only alone
    edge = {u: max(u * width, max(lengths)) for u, lengths in bins.items()}
    usable = [p for p in patterns(units, most)
              if all(u in bins for u in p) and sum(edge[u] for u in p) <= sequence_length]
    if usable:
        order = sorted(bins)
        place = {u: i for i, u in enumerate(order)}
        a = np.zeros((len(order), len(usable)))
        for j, p in enumerate(usable):
            for u in p:
                a[place[u], j] += 1
        weight = np.array(order, dtype=float)
        counts = np.array([sum(plan.left[n] for n in bins[u]) for u in order], dtype=float)
        repeats = np.floor(non_negative_least_squares(a * weight[:, None], counts * weight) + 1e-6).astype(np.int64)
        # the most used first: they lose least by rounding
        for j in sorted(np.flatnonzero(repeats).tolist(), key=lambda j: (-repeats[j], j)):
            there = [sum(plan.left[n] for n in bins[u]) // usable[j].count(u) for u in set(usable[j])]
            times = min(int(repeats[j]), *there)
            if times:
                plan.repeat([bins[u] for u in usable[j]], times)
    plan.best_fit()
    return plan


def planned(histogram: dict[int, int], sequence_length: int = SEQUENCE_LENGTH,
            shapes: tuple[tuple[int, int], ...] = SHAPES) -> Plan:
    """The plan of fewest sequences over all ``shapes``."""
    plans = []
    least = -(-sum(n * c for n, c in histogram.items()) // sequence_length)
    for units, most in shapes:
        plans.append(fitted(histogram, sequence_length, units, most))
        if plans[-1].sequences == least:
            break  # no plan has fewer
    return min(plans, key=lambda p: p.sequences)


# -- placing ---------------------------------------------------------------
def pack(docs: DataFrame, sequence_length: int = SEQUENCE_LENGTH, vocabulary: str = VOCABULARY,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents with sequence_id and offset.

    The driver gets the histogram; a task gets the plan's runs. Both are
    bounded by ``sequence_length`` and not by the data: a run ends a length or
    fills a group of equal rooms, which then lose over half their size.
    """
    made = checkpointed(pieces(docs, sequence_length, vocabulary, end_id, with_ids))
    spark = docs.sparkSession
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    plan = planned(histogram, sequence_length)
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 5)
    held = spark.sparkContext.broadcast(runs)

    # numbers within a length: groups of bounded size, then places in a group;
    # the written pieces keep their row ids when a task runs again
    lengths = spark.createDataFrame([(n, -(-c // GROUP_PIECES), plan.base[n]) for n, c in histogram.items()],
                                    "of_length int, groups bigint, base bigint")
    rows = (made.withColumn("row_id", F.monotonically_increasing_id())
            .join(F.broadcast(lengths), F.col("length") == F.col("of_length"))
            .withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("groups"))))
    numbered = rows.select("row_id", "length", "part", "base").withColumn(
        "place", F.row_number().over(Window.partitionBy("length", "part").orderBy("row_id")))
    sizes = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("size")).withColumn(
        "before", F.coalesce(F.sum("size").over(Window.partitionBy("length").orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    if with_ids:  # ids are not sorted along: they come back by row id
        kept = numbered.join(sizes.drop("size"), ["length", "part"]).select(
            "row_id", (F.col("base") + F.col("before") + F.col("place") - 1).alias("number"))
        numbered = rows.drop("part", "groups", "base", "of_length").join(kept, "row_id")
    else:
        window = Window.partitionBy("length", "part").orderBy("row_id")
        numbered = (rows.withColumn("place", F.row_number().over(window))
                    .join(sizes.drop("size"), ["length", "part"])
                    .withColumn("number", F.col("base") + F.col("before") + F.col("place") - 1))
    columns = made.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, sequence, offset, length, each = held.value.T
        for batch in slices(batches):
            number = batch.column(len(columns)).to_numpy()
            at = np.searchsorted(firsts, number, side="right") - 1
            step, within = np.divmod(number - firsts[at], each[at])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(columns))], pa.array(sequence[at] + step),
                 pa.array(offset[at] + within * length[at])], names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema.fields)
    return (numbered.select(*columns, "number")
            .mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint"))


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, n_tokens, ids (binary), cu_seqlens,
    positions (they start again at every piece), doc_ids and parts. A group
    has at most the tokens of one sequence."""
    whole = packed.groupBy("sequence_id").agg(
        F.sum(F.col("length").cast("bigint")).alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("p"))
    return whole.select(
        "sequence_id", "n_tokens",
        F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"),
        F.concat(F.col("p.offset"), F.array("n_tokens")).alias("cu_seqlens"),
        F.flatten(F.transform("p", lambda x: F.sequence(F.lit(0), x["length"] - 1))).alias("positions"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.piece").alias("parts"))


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed sequences as Parquet."""
    sequences(packed).write.mode("overwrite").parquet(path)


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    packed = pack(table(spark, sf_dir, "documents"), with_ids=False)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"),
                         "ids_crc32", "sequence_id", "offset")
