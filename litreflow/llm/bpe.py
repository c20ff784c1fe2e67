"""Byte-level BPE encoding and decoding.

Pre-tokenization works on arrays, without a regular expression: every code
point gets a class, every class (with what follows it) is a function from
scanner state to scanner state, and because composing such functions is
associative, the states at all positions come from a blocked prefix scan.
The slices found are encoded by pair merging behind a bounded cache; slices of
one length that it lacks are merged together, a matrix row each.

Inputs: null text is the empty text, and gives no ids. Invalid UTF-8 is read
as U+FFFD. Repeated rows are encoded each. Other columns are kept as they are;
columns named like an output are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, char_groups, table, texts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Entries of the younger half of the slice cache; the older half is as large.
CACHE_SLICES = 120_000
#: Slices over this many bytes are merged with a heap and not cached.
LONG_SLICE = 160
#: Slices up to this many bytes are merged as rows of a matrix.
MATRIX_SLICE = 40

# -- scanner ---------------------------------------------------------------
# Classes of code points.
LETTER, NUMBER, OTHER, QUOTE, BLANK, SPACE = range(6)
# Symbols: classes with what follows. A contraction is an apostrophe and the
# letters s t m d (one letter) or re ve ll (two letters). "LAST" white space
# stands right before something that is not white space.
(S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_BLANK_LAST, S_SPACE_LAST, S_SPACE) = range(8)
# States: what is open after a character.
(NOTHING, IN_LETTERS, IN_NUMBERS, IN_OTHERS, PREFIX, IN_SPACE, ONE_MORE, TWO_MORE) = range(8)
N_SYMBOLS = N_STATES = 8
#: Unicode's White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """State after ``symbol`` and whether a slice starts at it."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return NOTHING, False
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}.get(symbol)
    if symbol in (S_SHORT, S_LONG):
        if state in (IN_OTHERS, PREFIX):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    if run is not None:
        return run, state not in (run, PREFIX)
    if symbol == S_BLANK_LAST:
        return PREFIX, True
    if symbol == S_SPACE_LAST:
        return NOTHING, True
    return IN_SPACE, state != IN_SPACE


class Scanner:
    """Transition functions, closed under composition, as tables."""

    def __init__(self) -> None:
        plain = [tuple(_step(s, y)[0] for s in range(N_STATES)) for y in range(N_SYMBOLS)]
        # the first character of a text starts from NOTHING, whatever came before
        first = [(f[NOTHING],) * N_STATES for f in plain]
        known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(N_STATES)), *plain, *first]))}
        todo = list(known)
        while todo:
            f = todo.pop()
            for g in list(known):
                for a, b in ((f, g), (g, f)):
                    made = tuple(b[x] for x in a)
                    if made not in known:
                        known[made] = len(known)
                        todo.append(made)
        functions = list(known)
        self.apply = np.array(functions, dtype=np.uint8)
        self.compose = np.array([[known[tuple(g[x] for x in f)] for g in functions]
                                 for f in functions], dtype=np.uint16)
        self.of_symbol = np.array([known[f] for f in plain + first], dtype=np.uint16)
        self.starts = np.array([[_step(s, y)[1] for y in range(N_SYMBOLS)]
                                for s in range(N_STATES)], dtype=bool)

    def prefixes(self, functions: np.ndarray, width: int = 64) -> np.ndarray:
        """Composition of the first 1..n functions, by blocks."""
        n = len(functions)
        if n <= width:
            out = functions.copy()
            for i in range(1, n):
                out[i] = self.compose[out[i - 1], out[i]]
            return out
        rows = -(-n // width)
        grid = np.zeros((width, rows), dtype=np.uint16)  # 0 is the identity
        padded = np.zeros(rows * width, dtype=np.uint16)
        padded[:n] = functions
        grid[:] = padded.reshape(rows, width).T
        for i in range(1, width):
            grid[i] = self.compose[grid[i - 1], grid[i]]
        before = np.zeros(rows, dtype=np.uint16)
        before[1:] = self.prefixes(grid[-1], width)[:-1]
        return self.compose[before[None, :], grid].T.reshape(-1)[:n]


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


def _matched(pattern: str, text: str) -> list[int]:
    """Code points of ``text`` that the library's pattern matches."""
    one_byte_each = {bytes([b]): b for b in range(256)}
    asked = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=one_byte_each, special_tokens={})
    return [ord(c) for c in bytes(asked.encode_ordinary(text)).decode()]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point. What is a letter or a number depends on the
    version of Unicode, so the library whose ids are wanted is asked, once."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out[_matched(r"\p{L}", points)] = LETTER
    out[_matched(r"\p{N}", points)] = NUMBER
    out[WHITE_SPACE] = SPACE
    out[0x20] = BLANK
    out[0x27] = QUOTE
    return out


def slice_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Positions where slices start. ``firsts``: where each (non-empty) text
    starts in ``points``."""
    scanner = _scanner()
    kind = _classes()[points]
    n = len(points)
    is_first = np.zeros(n + 3, dtype=bool)
    is_first[firsts] = True
    is_first[n:] = True
    spaces = kind >= BLANK
    symbol = np.array([S_LETTER, S_NUMBER, S_OTHER, S_OTHER, S_SPACE, S_SPACE],
                      dtype=np.uint8)[kind]
    follows = np.zeros(n, dtype=bool)  # white space right before something else
    follows[:-1] = spaces[:-1] & ~spaces[1:] & ~is_first[1:n]
    symbol[follows] = np.where(kind[follows] == BLANK, S_BLANK_LAST, S_SPACE_LAST)
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        has_one = ~is_first[quotes + 1]
        has_two = has_one & ~is_first[quotes + 2]
        short = has_one & np.isin(one, [ord(c) for c in "stmd"])
        long = has_two & (((one == ord("r")) & (two == ord("e"))) |
                          ((one == ord("v")) & (two == ord("e"))) |
                          ((one == ord("l")) & (two == ord("l"))))
        symbol[quotes[short]] = S_SHORT
        symbol[quotes[long & ~short]] = S_LONG
    functions = scanner.of_symbol[symbol + np.uint8(N_SYMBOLS) * is_first[:n]]
    states = np.zeros(n, dtype=np.uint8)  # before each character
    states[1:] = scanner.apply[scanner.prefixes(functions)[:-1], NOTHING]
    states[firsts] = NOTHING
    begins = scanner.starts[states, symbol]
    begins[firsts] = True
    return np.flatnonzero(begins)


# -- merging ---------------------------------------------------------------
NONE = 1 << 60  # no rank: the pair cannot be joined


class Vocabulary:
    """Ranks by bytes, bytes by id, and encoded slices."""

    def __init__(self, name_or_path: str) -> None:
        path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self._index_pairs()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _index_pairs(self) -> None:
        """Open-addressing table: (left id, right id) -> id of both together."""
        ranks = self.ranks
        pairs = [(ranks[w[:i]], ranks[w[i:]], r) for w, r in ranks.items() for i in range(1, len(w))
                 if w[:i] in ranks and w[i:] in ranks]
        left, right, made = np.array(pairs, dtype=np.int64).T
        keys = left << 32 | right
        size = 1 << (2 * len(keys)).bit_length()
        self.slots, self.made = np.full(size, -1, dtype=np.int64), np.full(size, NONE, dtype=np.int64)
        self.shift = np.uint64(64 - size.bit_length() + 1)
        at = self._slot(keys)
        while len(keys):  # one key wins each free slot, the others go on
            free = self.slots[at] == -1
            self.slots[at[free]] = keys[free]
            mine = self.slots[at] == keys
            self.made[at[mine]] = made[mine]
            keys, made, at = keys[~mine], made[~mine], (at[~mine] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each pair, NONE where there is none."""
        keys = left << 32 | right
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.made[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found = self.slots[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.made[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids (int32 bytes) of words of one length: every round joins, in each
        row, the leftmost pair of lowest rank, so each row loses one column."""
        n, size = len(words), len(words[0])
        ids = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8).reshape(n, size)]
        ranks = self.joined(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, size - 1)
        out: list[bytes] = [b""] * n
        which = np.arange(n)

        def finish(rows: np.ndarray, of: np.ndarray) -> None:
            raw, step = rows.astype(np.int32).tobytes(), 4 * rows.shape[1]
            for k, i in enumerate(of.tolist()):
                out[i] = raw[k * step : (k + 1) * step]

        while ids.shape[1] > 1 and len(ids):
            best = ranks.argmin(axis=1)
            low = ranks[np.arange(len(ids)), best]
            over = low == NONE
            if over.any():
                finish(ids[over], which[over])
                go = ~over
                ids, ranks, which, best, low = ids[go], ranks[go], which[go], best[go], low[go]
            n, k = ids.shape
            if not n:
                return out
            row = np.arange(n)
            ids[row, best] = low
            keep = np.ones((n, k), dtype=bool)
            keep[row, best + 1] = False
            ids = ids[keep].reshape(n, k - 1)
            keep = np.ones((n, k - 1), dtype=bool)
            keep[row, best] = False
            ranks = ranks[keep].reshape(n, k - 2)
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.joined(ids[left, best[left] - 1], low[left])
            right = np.flatnonzero(best < k - 2)
            ranks[right, best[right]] = self.joined(low[right], ids[right, best[right] + 1])
        finish(ids, which)
        return out

    def merge(self, word: bytes) -> list[int]:
        """Ids of one slice: always join the leftmost pair of lowest rank."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        if len(word) > LONG_SLICE:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == NONE:
                break
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap over a linked list: n log n for long slices."""
        ranks, n = self.ranks, len(word)
        ends = list(range(1, n + 1))       # of the part that starts here
        before = list(range(-1, n - 1))    # start of the part on the left
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = ends[i]
            if j < n:
                r = ranks.get(word[i : ends[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, ends[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, end = heapq.heappop(heap)
            if not alive[i] or ends[i] != j or not alive[j] or ends[j] != end:
                continue
            ends[i] = end
            alive[j] = False
            if end < n:
                before[end] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : ends[i]]])
            i = ends[i]
        return out

    def packed(self, slices: list[bytes]) -> list[bytes]:
        """Ids of every slice as int32 bytes."""
        young, old, ranks = self.young, self.old, self.ranks
        known: dict[bytes, bytes] = {}
        fresh: dict[bytes, bytes] = {}
        missing: dict[int, list[bytes]] = {}
        counts = Counter(slices)
        for w in counts:
            got = young.get(w)
            if got is None:
                got = old.get(w)
                if got is None:
                    rank = ranks.get(w)
                    if rank is None:
                        missing.setdefault(len(w), []).append(w)
                        continue
                    got = rank.to_bytes(4, "little")
                fresh[w] = got
            known[w] = got
        for size, words in missing.items():
            if size <= MATRIX_SLICE and len(words) > 3:
                made = self.merge_rows(words)
            else:
                made = [np.array(self.merge(w), dtype="<i4").tobytes() for w in words]
            known.update(zip(words, made))
            if size <= LONG_SLICE:  # what comes once may not come again
                fresh.update((w, got) for w, got in zip(words, made) if counts[w] > 1)
        if len(young) + len(fresh) > CACHE_SLICES:
            self.old, self.young = young, fresh
        else:
            young.update(fresh)
        return list(map(known.__getitem__, slices))

    def forget(self) -> None:
        """Drop the cached slices."""
        self.young, self.old = {}, {}


@lru_cache(maxsize=2)
def _vocabulary(name: str) -> Vocabulary:
    return Vocabulary(name)


def encode_texts(docs: list[str], vocabulary: str = VOCABULARY
                 ) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of every text and the bytes of the text at which its slices start."""
    vocab = _vocabulary(vocabulary)
    ids, offsets = [], []
    for a, b in char_groups(docs):
        group = docs[a:b]
        lengths = np.array([len(x) for x in group], dtype=np.int64)
        ends = np.cumsum(lengths)
        joined = "".join(group)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        if len(points):
            starts = slice_starts(points, (ends - lengths)[lengths > 0])
            raw = joined.encode("utf-8")
            if len(raw) == len(points):
                at = starts
            else:
                width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
                at = (np.cumsum(width) - width)[starts]
            at = at.astype(np.int32)
            cuts = at.tolist() + [len(raw)]
            packed = vocab.packed([raw[x:y] for x, y in zip(cuts, cuts[1:])])
            bounds = np.searchsorted(starts, np.concatenate([[0], ends])).tolist()
        else:
            packed, bounds, at = [], [0] * (len(group) + 1), np.zeros(0, dtype=np.int32)
        for x, y in zip(bounds, bounds[1:]):
            ids.append(np.frombuffer(b"".join(packed[x:y]), dtype=np.int32))
            offsets.append(at[x:y] - at[x] if y > x else at[:0])
    return ids, offsets


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.array([0, *[len(x) for x in arrays]], dtype=np.int64)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(flat))


def encode(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Every column of ``df`` plus ``ids`` and ``offsets`` (bytes at which the
    slices start in the UTF-8 text)."""
    keep = [c for c in df.columns if c not in ("ids", "offsets")]
    return add_columns(df, [text], "ids array<int>, offsets array<int>",
                       lambda col: [_lists(x) for x in encode_texts(texts(col), vocabulary)], keep,
                       done=lambda: _vocabulary(vocabulary).forget())


def decode(df: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Every column of ``df`` plus ``decoded``: the bytes of its ids (null ids:
    no bytes; an id outside the vocabulary is an error)."""
    def run(col: pa.Array) -> list[pa.Array]:
        piece = _vocabulary(vocabulary).bytes_of.__getitem__
        flat = col.flatten().to_numpy(zero_copy_only=False)
        sizes = [n or 0 for n in pc.list_value_length(col).to_pylist()]
        out, at = [], 0
        for n in sizes:
            out.append(b"".join(map(piece, flat[at : at + n].tolist())))
            at += n
        return [pa.array(out, pa.binary())]

    return add_columns(df, [ids], "decoded binary", run, [c for c in df.columns if c != "decoded"])


def encoded_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode and decode every text; counts and digests of both results."""
    both = decode(encode(docs.select("doc_id", "text"), vocabulary=vocabulary)
                  .select("doc_id", "ids"), vocabulary=vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))
