"""Repeated passages across documents, exact or fuzzy, by collinear chaining.

Seeds are word k-mers, one in ``SEED_SHARE`` by hash and the minimizers, so any
shared run of ``SEED_WORDS + SEED_WINDOW - 1`` words shares a seed; one seed is
enough to start an alignment. An occurrence of a seed is matched with the
earlier ones (of a smaller ``doc_id``) that go on like it for most words: the
occurrences of a seed are sorted by the ``AHEAD`` words after it, as in a suffix
array, and of all earlier ones the nearest in front and the nearest behind
share the most of them. Occurrences with the same words ahead meet the first
document that has these. So a run of ``SEED_WORDS + AHEAD`` words that any
earlier document has meets one that has it, whatever other documents hold
pieces of it, and a passage in n documents makes at most n matches a seed and
place, never pairs of all. Occurrences with the same words ahead are matched where the texts
are read, so a line that a third of the documents has is not sent for each.

The matches of two documents are chained with gap costs through a Fenwick tree,
and each chain is aligned word by word: the gaps between seeds by longest
common subsequence, the ends by extension. A chain with too few matching words
is split at its worst gap and the parts are judged by themselves, as is one with
a passage on both sides of a long gap. Aligned stretches of a document
are merged over its sources; merged stretches of at least ``MIN_WORDS`` words
are repeated passages. The first document that holds a passage keeps it. Of an
edited passage the places can be missed where every seed that is left goes on
alike in unrelated documents.

Inputs: null text is the empty text. A null ``doc_id`` counts as larger than
any other. Rows with the same ``doc_id`` and text are the same document: they
are not compared with each other, nor is a text with itself. Rows with the same
``doc_id`` and other texts, and null ids, come in the order of 32 bits of the
texts' xxhash64. Words are runs of
letters and digits (all characters beyond ASCII are letters), compared without
ASCII case. Other columns are kept by ``cut``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (_PRIME, WORD_BYTES, add_columns, char_groups, checkpointed, fresh, gram_hashes, mix64,
                     replace_column, slices, table, utf8_texts, word_hashes)

SEED_WORDS = 5
#: One gram in so many is a seed by its hash alone, so that it is one in every
#: text; of each window of grams the least hash is one, too.
SEED_SHARE = 4
SEED_WINDOW = 8
#: Words on each side of a seed that are compared, by 4 bits, before its texts.
SIDE = 8
#: Words after a seed that occurrences are sorted by: SIDE by 4 bits, the others
#: by a hash of 16 bits.
AHEAD = 16
#: A repeated passage has at least so many words ...
MIN_WORDS = 50
#: ... made of aligned stretches of at least so many, of which this share match.
MIN_STRETCH = 20
MIN_IDENTITY = 0.8
#: Stretches of a document at most so many words apart are one passage.
JOIN_WORDS = 5
#: Cost of a word of gap in a chain; a seed gains SEED_WORDS.
GAP_COST = 0.1
#: A run of words ends where its score (a match gains 1, a mismatch costs 2)
#: is more than this below its best.
DROP = 6
#: A chain covers at least so many words before it is aligned: any seed may.
MIN_CHAIN = SEED_WORDS
#: Words around a chain that are fetched for its extension, and the raster of
#: fetched ranges (few distinct ranges of a document that many others repeat).
PAD = 64
RASTER = 64
#: Aligned pairs of slices that a task keeps, for their copies.
HELD_PAIRS = 2000
#: Chains are broadcast to the texts up to so many bytes.
BROADCAST_BYTES = 12_000_000
_LAST_ID = (1 << 63) - 1


#: Bytes of texts whose seeds are found at once.
GROUP_BYTES = 100_000
#: Words of zeros around texts that are laid side by side, so that no seed, no
#: window of seeds and no word beside a seed is of two texts.
SPACE = SEED_WORDS + AHEAD


def laid_out(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts (``sizes`` of each) with SPACE zeros before, between
    and after them, and the place of each text's first word."""
    begins = np.cumsum(sizes + SPACE) - sizes
    out = np.zeros(int((sizes + SPACE).sum()) + SPACE, dtype=np.uint64)
    out[np.arange(len(words)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)] = words
    return out, begins


def seed_positions(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the seeds of texts that are laid out."""
    counts = np.maximum(sizes - SEED_WORDS + 1, 0)
    edges = np.zeros(len(words), dtype=np.int8)
    edges[begins] = 1
    edges[begins + counts] -= 1
    inside = np.cumsum(edges, dtype=np.int8).view(bool)
    grams = np.full(len(words), ~np.uint64(0))
    grams[: len(words) - SEED_WORDS + 1] = gram_hashes(words, SEED_WORDS)
    grams[~inside] = ~np.uint64(0)
    chosen = grams < np.uint64((1 << 64) // SEED_SHARE)
    # windows that have no seed yet; a text of fewer grams is one window
    sums = np.concatenate([[0], np.cumsum(chosen, dtype=np.int32)])
    empty = sums[SEED_WINDOW:] == sums[:-SEED_WINDOW]
    few = begins[(counts > 0) & (counts < SEED_WINDOW)]
    few = few[empty[few]]
    empty &= inside[: len(empty)] & inside[SEED_WINDOW - 1 :]
    empty[few] = True
    empty = np.flatnonzero(empty)
    windows = np.lib.stride_tricks.sliding_window_view(grams, SEED_WINDOW)[empty]
    chosen[empty + windows.argmin(axis=1)] = True
    at = np.flatnonzero(chosen)
    return grams[at], at


def sides(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``beside`` the seeds of one text."""
    sizes = np.array([len(words)])
    return beside(laid_out(words, sizes)[0], at + SPACE)


def beside(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words after the seeds, nearest first: 4 bits each of SIDE words, then
    16 bits of a hash of those up to AHEAD; and 4 bits each of SIDE words
    before, the nearest lowest."""
    bits, n = (words >> np.uint64(60)).astype(np.uint64), 1
    while n < SIDE:  # of 2, 4, 8 words
        bits = bits[:-n] << np.uint64(4 * n) | bits[n:]
        n *= 2
    far = np.zeros(len(at), dtype=np.uint64)
    for j in range(SIDE, AHEAD):  # as gram_hashes
        if j > SIDE:
            far *= _PRIME
            far ^= far >> np.uint64(29)
        far += words[at + (SEED_WORDS + j)]
    ahead = bits[at + SEED_WORDS] << np.uint64(16) | mix64(far) >> np.uint64(48)
    return ahead.view(np.int64), bits[at - SIDE].view(np.int64)


def reach(ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """How far a seed that matches may extend on its diagonal after and before
    it; ahead, behind: how the words there differ, as in ``sides``. Words after
    it, BEYOND added if it may go on, and 64 times the same before it.

    As _extend, with words that differ but have the same 4 bits as matches, so
    it never goes on for less; what goes on beyond SIDE may go on further.
    """
    out = np.zeros(len(ahead), dtype=np.int64)
    shifts = ([16 + 4 * (SIDE - 1 - j) for j in range(SIDE)], [4 * j for j in range(SIDE)])
    for scale, differ, places in zip((1, 64), (ahead, behind), shifts):
        total, best, size = (np.zeros(len(ahead), dtype=np.int64) for _ in range(3))
        going = np.ones(len(ahead), dtype=bool)
        for j, shift in enumerate(places):
            total += np.where(going, np.where(differ >> shift & 15, -2, 1), 0)
            better = going & (total > best)
            best = np.where(better, total, best)
            size = np.where(better, j + 1, size)
            going &= best - total <= DROP
        out += scale * (size + BEYOND * going)
    return out.astype(np.int16)


BEYOND = 32


def may_extend(span: np.ndarray | int, after: np.ndarray | int, before: np.ndarray | int) -> np.ndarray | bool:
    """Whether a stretch of MIN_STRETCH words can hold ``span`` words that match
    on one diagonal: reach of its last seed (after), and of its first."""
    ahead, behind = after % 64, before // 64
    return (ahead >= BEYOND) | (behind >= BEYOND) | (span + ahead % BEYOND + behind % BEYOND >= MIN_STRETCH)


_SEED = "seed bigint, ahead bigint, behind bigint, doc bigint, text_key bigint, at int"
_SEED_NAMES = [x.split()[0] for x in _SEED.split(", ")]


def _runs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by seed, ahead, doc, text_key, at: which begin a run of
    one seed and words ahead, which begin a document in it, the start of each
    row's run, and whether each row is of its run's first document."""
    n = len(rows["seed"])
    group, doc = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    group[1:] = (rows["seed"][1:] != rows["seed"][:-1]) | (rows["ahead"][1:] != rows["ahead"][:-1])
    doc[1:] = group[1:] | (rows["doc"][1:] != rows["doc"][:-1]) | (rows["text_key"][1:] != rows["text_key"][:-1])
    start = np.maximum.accumulate(np.where(group, np.arange(n), 0))
    steps = np.cumsum(doc)
    return group, doc, start, steps == steps[start]


def _origins(doc: np.ndarray, start: np.ndarray, first: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The row of the run's first document that each row meets: the n-th
    occurrence in a document the n-th there, counted round, so that a repeated
    line stays on one diagonal."""
    index = np.arange(len(doc))
    doc_start = np.maximum.accumulate(np.where(doc, index, 0))
    sizes = np.add.reduceat(first.astype(np.int64), np.flatnonzero(group))[np.cumsum(group) - 1]
    return start + (index - doc_start) % sizes


def _once(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Rows with the same id and text are one document: one row a place."""
    keep = np.ones(len(rows["seed"]), dtype=bool)
    keep[1:] = np.any([rows[k][1:] != rows[k][:-1] for k in ("seed", "ahead", "doc", "text_key", "at")], axis=0)
    return keep


def _by_seed(rows: dict[str, np.ndarray], in_order: bool) -> np.ndarray:
    """The order of rows by seed, ahead, doc, text_key, at; ``in_order``: they
    are in that of the last three, each other than the next. Few seeds are
    there more than once: only those are sorted by more than the seed."""
    if not in_order:
        return np.lexsort([rows[k] for k in ("at", "text_key", "doc", "ahead", "seed")])
    order = np.argsort(rows["seed"])
    seed = rows["seed"][order]
    tied = np.zeros(len(order) + 1, dtype=bool)
    tied[1:-1] = seed[1:] == seed[:-1]
    tied = tied[1:] | tied[:-1]
    again = np.sort(order[tied])
    order[tied] = again[np.lexsort((rows["ahead"][again], rows["seed"][again]))]
    return order


def _found(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """seed, ahead, behind and place of the texts' seeds, and how many each has."""
    for i, j in char_groups(texts, GROUP_BYTES):
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        hashes, starts, _ = word_hashes(b"\n".join(texts[i:j]).lower(), WORD_BYTES)
        sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
        words, begins = laid_out(hashes, sizes)
        seed, at = seed_positions(words, begins, sizes)
        n = np.diff(np.searchsorted(at, begins + sizes), prepend=0)
        yield seed.view(np.int64), *beside(words, at), (at - np.repeat(begins, n)).astype(np.int32), n


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text_key, text) -> _SEED, one row for each occurrence that no
    earlier document of the same slice matches in the words ahead, and matches
    with those: their place is -1 - at, the source's doc is in ``seed``, its
    text_key and place in ``ahead``."""
    for batch in slices(batches):
        doc, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        seed, ahead, behind, at, sizes = (
            np.concatenate(x) for x in zip(*_found(utf8_texts(batch.column(2).take(pa.array(order))))))
        if not len(seed):
            continue
        again = (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])
        rows = dict(zip(_SEED_NAMES, (seed, ahead, behind, np.repeat(doc, sizes), np.repeat(key, sizes), at)))
        order = _by_seed(rows, not again.any())
        rows = {k: x[order] for k, x in rows.items()}
        if again.any():
            once = _once(rows)
            rows = {k: x[once] for k, x in rows.items()}
        group, of_doc, start, first = _runs(rows)
        origin, later = _origins(of_doc, start, first, group), np.flatnonzero(~first)
        origin = origin[later]
        meant = [rows["doc"][origin], rows["text_key"][origin] << 31 | rows["at"][origin].astype(np.int64),
                 0, -1 - rows["at"][later]]
        for name, x in zip(("seed", "ahead", "behind", "at"), meant):
            rows[name][later] = x
        yield pa.RecordBatch.from_arrays([pa.array(rows[k]) for k in _SEED_NAMES], names=_SEED_NAMES)


_MATCH = "doc bigint, text_key bigint, source bigint, source_key bigint, own int, other int, reach smallint"


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    if len(columns) == 6:  # the words ahead are alike
        columns = [*columns, np.full(len(columns[0]), BEYOND, dtype=np.int16)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in columns], names=[x.split()[0] for x in _MATCH.split(", ")])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_SEED sorted by seed, ahead, doc, text_key, at -> _MATCH.

    A row of a run's later documents meets the first document. The rows of
    first documents meet the nearest rows of first documents before and after
    them that are of an earlier document: a stack holds the rows that still
    wait for one after them, in rising order of documents. Besides it, what is
    held of an open run is its first and its last document.
    """
    held, done = None, 0
    stack: list[tuple] = []  # (doc, text_key), place, ahead, behind, the row before of an earlier document
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {k: batch.column(i).to_numpy() for i, k in enumerate(batch.schema.names)}
        made = new["at"] < 0
        if made.any():  # matched where the texts were read
            x = {k: v[made] for k, v in new.items()}
            yield _batch([x["doc"], x["text_key"], x["seed"], x["ahead"] >> 31, -1 - x["at"],
                          (x["ahead"] & (1 << 31) - 1).astype(np.int32)])
            new = {k: v[~made] for k, v in new.items()}
            if not len(new["seed"]):
                continue
        rows = new if held is None else {k: np.concatenate([held[k], x]) for k, x in new.items()}
        once = _once(rows)
        done = int(once[:done].sum())
        rows = {k: x[once] for k, x in rows.items()}
        n = len(rows["seed"])
        group, of_doc, start, first = _runs(rows)
        fresh_rows = np.arange(n) >= done
        later = np.flatnonzero(~first & fresh_rows)
        if len(later):
            origin = _origins(of_doc, start, first, group)[later]
            yield _batch([rows[k][later] for k in ("doc", "text_key")] + [rows[k][origin] for k in ("doc", "text_key")]
                         + [rows["at"][later], rows["at"][origin]])
        leads = np.flatnonzero(first & fresh_rows)
        if len(leads):
            seeds = rows["seed"][leads]
            alone = np.ones(len(leads), dtype=bool)  # the only row of its seed, as far as is seen
            alone[1:] &= seeds[1:] != seeds[:-1]
            alone[:-1] &= seeds[1:] != seeds[:-1]
            alone[0] &= seeds[0] != current
            alone[-1] = False
            leads = leads[~alone]
            own: list[tuple] = []
            source: list[tuple] = []
            for seed, ahead, behind, doc, key, at in zip(*(rows[k][leads].tolist() for k in _SEED_NAMES)):
                if seed != current:
                    current, stack = seed, []
                who = (doc, key)
                row = None
                while stack and stack[-1][0] > who:
                    top = stack.pop()
                    own.append(top)
                    source.append((who, at, ahead, behind))
                if stack:
                    row = stack[-1] if stack[-1][0] < who else stack[-1][4]
                entry = (who, at, ahead, behind, row)
                if row is not None:
                    own.append(entry)
                    source.append(row)
                stack.append(entry)
            if own:
                sides_of = [np.array([[x[2], x[3]] for x in side], dtype=np.int64) for side in (own, source)]
                differ = sides_of[0] ^ sides_of[1]
                yield _batch([np.array([x[0][0] for x in own]), np.array([x[0][1] for x in own]),
                              np.array([x[0][0] for x in source]), np.array([x[0][1] for x in source]),
                              np.array([x[1] for x in own], dtype=np.int32),
                              np.array([x[1] for x in source], dtype=np.int32),
                              reach(differ[:, 0], differ[:, 1])])
        last = np.cumsum(of_doc) == of_doc.sum()
        rest = (start == start[-1]) & (first | last)
        held = {k: x[rest] for k, x in rows.items()}
        done = int(rest.sum())


def _packed(x: list[int] | np.ndarray, first: int | None = None) -> bytes:
    """Numbers as the first one (or another in its place) and the steps from
    each to the next, in as few bytes a step as all of them need."""
    x = np.asarray(x, dtype=np.int64)
    steps = x[1:] - x[:-1]
    far = max(int(steps.max()), -int(steps.min())) if len(steps) else 0
    width = 1 if far < 128 else 2 if far < 1 << 15 else 8
    return _head(width, int(x[0]) if first is None else first) + steps.astype(f"<i{width}").tobytes()


def _head(width: int, first: int) -> bytes:
    return width.to_bytes(1, "little") + first.to_bytes(8, "little", signed=True)


# -- chaining --------------------------------------------------------------
class _Fenwick:
    """Best (value, index) over keys up to a key."""

    def __init__(self, n: int) -> None:
        self.value = [-1e18] * (n + 1)
        self.index = [-1] * (n + 1)

    def offer(self, key: int, value: float, index: int) -> None:
        key += 1
        while key < len(self.value):
            if value > self.value[key]:
                self.value[key], self.index[key] = value, index
            key += key & -key

    def best(self, key: int) -> tuple[float, int]:
        """Over keys 0 .. key - 1."""
        value, index = -1e18, -1
        while key > 0:
            if self.value[key] > value:
                value, index = self.value[key], self.index[key]
            key -= key & -key
        return value, index


def chains(own: list[int], other: list[int]) -> list[list[int]]:
    """Chains of matches (indices), best first; each match is in one at most.

    ``own`` ascends. A chain ascends strictly in both; its score is the seeds'
    gain less the cost of all words skipped in either text.
    """
    rank = {p: i for i, p in enumerate(sorted(set(other)))}
    tree = _Fenwick(len(rank))
    score, before = [], []
    pending: list[int] = []
    for i, (p, q) in enumerate(zip(own, other)):
        if pending and own[pending[0]] < p:
            for j in pending:
                tree.offer(rank[other[j]], score[j] + GAP_COST * (own[j] + other[j]), j)
            pending = []
        value, j = tree.best(rank[q])
        gain = value - GAP_COST * (p + q)
        if j < 0 or gain <= 0:
            gain, j = 0.0, -1
        score.append(SEED_WORDS + gain)
        before.append(j)
        pending.append(i)
    used = [False] * len(own)
    out = []
    for i in sorted(range(len(own)), key=lambda x: (-score[x], x)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            chain.reverse()
            if own[chain[-1]] - own[chain[0]] + SEED_WORDS >= MIN_CHAIN:
                out.append(chain)
    return out


def _one_chain(own: np.ndarray, other: np.ndarray) -> bool:
    """Whether all matches ascend in both texts by steps that cost less than a
    seed gains: then they are the best chain, and the only one."""
    return bool(_linked(np.diff(own.astype(np.int64)), np.diff(other.astype(np.int64))).all())


def _linked(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Steps in both texts that are such."""
    return (p > 0) & (q > 0) & (GAP_COST * (p + q) < SEED_WORDS)


#: own, other: the seeds' places from the first one on, as _packed.
_CHAIN = ("doc bigint, text_key bigint, source bigint, source_key bigint, lo int, hi int, source_lo int, source_hi int, "
          "own binary, other binary")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted _MATCH -> chains that may have a stretch: one on a single diagonal
    may not if the words on both sides rule it out."""
    names = [x.split()[0] for x in _CHAIN.split(", ")]
    rest = None

    kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()] * 2

    def made(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        pair, (own, other, near) = columns[:4], columns[4:]
        begins = np.ones(len(own) + 1, dtype=bool)
        begins[1:-1] = np.any([x[1:] != x[:-1] for x in pair], axis=0)
        lone = begins[1:] & begins[:-1]  # the only match of its pair
        far = near.astype(np.int64)
        keep = ~lone | may_extend(SEED_WORDS, far, far)
        if not keep.any():
            return
        pair = [x[keep] for x in pair]
        own, other, near = (x[keep].astype(np.int64) for x in (own, other, near))
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in pair], axis=0)) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(own)]]) - 1
        p, q = np.diff(own), np.diff(other)

        def none(which: np.ndarray) -> np.ndarray:
            """Pairs without such a step."""
            sums = np.concatenate([[0], np.cumsum(which)])
            return sums[first] == sums[last]

        single = none(~_linked(p, q))
        span = own[last] - own[first]
        run = (span == other[last] - other[first]) & none(p > SEED_WORDS)
        whole = single & (~run | may_extend(span + SEED_WORDS, near[last], near[first]))
        a, z = first[whole], last[whole]
        if len(a):
            head = _head(1, 0)  # the steps of a single chain are short
            packed = [[head + raw[i:j] for i, j in zip(a.tolist(), z.tolist())]
                      for raw in (x.astype("<i1").tobytes() for x in (p, q))]
            bounds = [own[a], own[z] + SEED_WORDS, other[a], other[z] + SEED_WORDS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip([*[x[a] for x in pair], *[x.astype(np.int32) for x in bounds], *packed], kinds)],
                names=names)
        rows = []
        for a, b in zip(first[~single].tolist(), (last[~single] + 1).tolist()):
            p, q = own[a:b].tolist(), other[a:b].tolist()
            for chain in chains(p, q):
                x, y = [p[i] for i in chain], [q[i] for i in chain]
                run = x[-1] - x[0] == y[-1] - y[0] and all(j - i <= SEED_WORDS for i, j in zip(x, x[1:]))
                if run and not may_extend(x[-1] - x[0] + SEED_WORDS, int(near[a + chain[-1]]), int(near[a + chain[0]])):
                    continue
                rows.append((*[int(k[a]) for k in pair], x[0], x[-1] + SEED_WORDS, y[0], y[-1] + SEED_WORDS,
                             _packed(x, 0), _packed(y, 0)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        new = [batch.column(i).to_numpy() for i in range(7)]
        held = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
        last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last document may go on
        if cut:
            yield from made(*[x[:cut] for x in held])
        rest = [x[cut:] for x in held]
    if rest is not None and len(rest[0]):
        yield from made(*rest)


# -- alignment -------------------------------------------------------------
def _common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two short lists."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full  # zero bits: ends of common subsequences (bit-parallel)
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


#: Words that an extension looks at one by one: most end there.
FEW = 16


def _extend(a: np.ndarray, b: np.ndarray, cost: int = 2) -> tuple[int, int]:
    """Words by which an alignment goes on, and how many of them match: a match
    gains 1, a mismatch costs ``cost``, and DROP below the best so far ends it."""
    total = best = size = matched = equal = 0
    for j, (x, y) in enumerate(zip(a[:FEW].tolist(), b[:FEW].tolist()), 1):
        if x == y:
            total += 1
            equal += 1
            if total > best:
                best, size, matched = total, j, equal
        else:
            total -= cost
            if best - total > DROP:
                return size, matched
    n = min(len(a), len(b))
    if n <= FEW:
        return size, matched
    same = a[:n] == b[:n]
    totals = np.cumsum(np.where(same, 1, -cost))
    bests = np.maximum.accumulate(np.maximum(totals, 0))
    stop = np.flatnonzero(bests - totals > DROP)
    end = int(stop[0]) if len(stop) else n
    if not end or totals[:end].max() <= 0:
        return 0, 0
    size = int(totals[:end].argmax()) + 1
    return size, int(same[:size].sum())


def _on_diagonals(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[tuple[int, int, int]]:
    """Seeds whose words match (hashes may be equal by chance), those that
    overlap or touch on one diagonal as one: places and length."""
    if len(p) == 1:
        x, y = int(p[0]), int(q[0])
        same = a[x : x + SEED_WORDS].tobytes() == b[y : y + SEED_WORDS].tobytes()
        return [(x, y, SEED_WORDS)] if same and x + SEED_WORDS <= len(a) else []
    there = (p + SEED_WORDS <= len(a)) & (q + SEED_WORDS <= len(b))
    p, q = p[there], q[there]
    within = np.arange(SEED_WORDS)
    same = (a[p[:, None] + within] == b[q[:, None] + within]).all(axis=1)
    p, q = p[same], q[same]
    if not len(p):
        return []
    step = np.diff(p)
    cuts = np.flatnonzero((step != np.diff(q)) | (step > SEED_WORDS))
    first, last = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(p) - 1]])
    return list(zip(p[first].tolist(), q[first].tolist(), (p[last] - p[first] + SEED_WORDS).tolist()))


def aligned(a: np.ndarray, b: np.ndarray, own: np.ndarray, other: np.ndarray) -> list[tuple[int, int, float]]:
    """Aligned ranges of ``a`` and their shares of matching words, from the
    matched seed positions in ``a`` (own) and ``b`` (other).

    A chain that matches as a whole is one range, unless a gap that loses more
    than DROP has a passage on both sides. Any other is split where it loses
    most, and its parts are judged in the same way.
    """
    blocks: list[list[int]] = []  # from, to in a, from, to in b, matching words
    lost = []  # words without a match before each block but the first
    for p, q, length in _on_diagonals(a, b, np.asarray(own, dtype=np.int64), np.asarray(other, dtype=np.int64)):
        if not blocks:
            blocks.append([p, p + length, q, q + length, length])
            continue
        x, y = blocks[-1][1], blocks[-1][3]
        if (p <= x or q <= y) and p - x == q - y:  # one diagonal without a gap
            blocks[-1][1], blocks[-1][3] = p + length, q + length
            blocks[-1][4] += p + length - x
            continue
        common = 0
        if p < x or q < y:  # a jump inside the last seed: the rest of this one
            skip = min(length, max(x - p, y - q))
            p, q, size = p + skip, q + skip, length - skip
        else:
            size = length
            common = _common(a[x:p].tolist(), b[y:q].tolist())
        if not size:
            continue
        lost.append(max(p - x, q - y) - common)
        blocks.append([p, p + size, q, q + size, size + common])
    sums = np.cumsum([0, *(k[4] for k in blocks)])
    gaps = [0, *(max(k[0] - j[1], k[2] - j[3]) - n for j, k, n in zip(blocks, blocks[1:], lost))]

    def judged(i: int, j: int, cost: int = 2) -> tuple[int, int, float]:
        """Blocks i .. j and their extension."""
        (lo, _, low, _, _), (_, hi, _, high, _) = blocks[i], blocks[j]
        left, more = _extend(a[:lo][::-1], b[:low][::-1], cost)
        right, most = _extend(a[hi:], b[high:], cost)
        matched = int(sums[j + 1] - sums[i]) - gaps[i] + more + most
        longer = max(hi - lo, high - low) + left + right
        return lo - left, hi + right, matched / longer

    out = []
    todo = [(0, len(blocks) - 1)] if blocks else []
    while todo:
        i, j = todo.pop()
        lo, hi, identity = judged(i, j)
        worst = max(range(i, j), key=lambda g: lost[g], default=-1)
        if identity >= MIN_IDENTITY:
            halves = [judged(i, worst), judged(worst + 1, j)] if worst >= 0 and 2 * lost[worst] > DROP else []
            if not halves or any(y - x < MIN_WORDS or s < MIN_IDENTITY for x, y, s in halves):
                out.append((lo, hi, identity))
                continue
        elif worst < 0:  # ends that match too little are left out
            lo, hi, identity = judged(i, j, 4)
            if identity >= MIN_IDENTITY:
                out.append((lo, hi, identity))
            continue
        todo += [(worst + 1, j), (i, worst)]
    return [x for x in out if x[1] - x[0] >= MIN_STRETCH]


def _ids(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(_LAST_ID))


def _unpacked(raw: bytes) -> np.ndarray:
    if len(raw) == 9:
        return np.frombuffer(raw, dtype="<i8", offset=1)
    steps = np.frombuffer(raw, dtype=f"<i{raw[0]}", offset=9)
    out = np.empty(len(steps) + 1, dtype=np.int64)
    out[0] = 0
    np.cumsum(steps, out=out[1:])
    return out + int.from_bytes(raw[1:9], "little", signed=True)


def _words(texts: list[bytes]) -> Iterator[tuple[int, bytes, Callable[..., bytes], Callable[..., bytes]]]:
    """Of each text: how many words, 32 bits of each word's hash, and what packs
    the byte places at which words lo .. hi - 1 start, and end."""

    def packer(places: np.ndarray) -> Callable[[int, int], bytes]:
        steps = np.diff(places)
        if len(steps) and steps.max() > 127:
            return lambda lo, hi: _packed(places[lo:hi])
        raw = steps.astype("<i1").tobytes()
        return lambda lo, hi: _head(1, int(places[lo])) + raw[lo : hi - 1]

    for i, j in char_groups(texts, GROUP_BYTES):
        edges = np.cumsum([0, *(len(t) + 1 for t in texts[i:j])])
        words, starts, ends = word_hashes(b"\n".join(texts[i:j]).lower(), WORD_BYTES)
        short = (words >> np.uint64(33)).astype("<i4").tobytes()
        cuts = np.searchsorted(starts, edges).tolist()
        for edge, a, b in zip(edges.tolist(), cuts, cuts[1:]):
            yield b - a, short[4 * a : 4 * b], packer(starts[a:b] - edge), packer(ends[a:b] - edge)


def _word_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text_key, text, asked, chains) -> rows of word hashes: the ranges
    asked for by others, and own ranges around each chain with the words' byte
    places."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(),
             *[pa.binary()] * 4]
    for batch in slices(batches):
        out: list[tuple] = []
        docs, keys, asked, chained = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
        for doc, key, ranges, own, words in zip(docs, keys, asked, chained, _words(utf8_texts(batch.column(2)))):
            n, short, starts, ends = words
            for r in ranges or ():
                out.append((doc, key, r["from"], r["to"], short[4 * r["from"] : 4 * r["to"]], *[None] * 7))
            for c in own or ():
                lo, hi = max(0, c["lo"] - PAD), min(n, c["hi"] + PAD)
                at = c["source_lo"] - PAD
                low, high = max(0, at // RASTER * RASTER), -(-(c["source_hi"] + PAD) // RASTER) * RASTER
                out.append((c["source"], c["source_key"], low, high, short[4 * lo : 4 * hi], doc, key, lo,
                            # the first seed's place in the slices
                            _head(c["own"][0], c["lo"] - lo) + c["own"][9:],
                            _head(c["other"][0], c["source_lo"] - low) + c["other"][9:],
                            starts(lo, hi), ends(lo, hi)))
        columns = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         names=[x.split()[0] for x in _SLICE.split(", ")])


#: words: 32 bits of each word's hash; own, other, starts, ends: as _packed.
_SLICE = ("source bigint, source_key bigint, low int, high int, words binary, doc bigint, text_key bigint, "
          "lo int, own binary, other binary, starts binary, ends binary")


def _parts(words: bytes, source_words: bytes, own: bytes, other: bytes, lo: int, starts: bytes,
           ends: bytes) -> list[dict]:
    """Aligned stretches of a chain's slices, by words and bytes of the text."""
    a, b = np.frombuffer(words, dtype=np.int32), np.frombuffer(source_words, dtype=np.int32)
    found = aligned(a, b, _unpacked(own), _unpacked(other))
    if not found:
        return []
    s, e = _unpacked(starts), _unpacked(ends)
    return [{"word_lo": x + lo, "word_hi": y + lo, "byte_lo": int(s[x]), "byte_hi": int(e[y - 1]),
             "identity": identity} for x, y, identity in found]


def _key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(0xFFFFFFFF)


def stretches(docs: DataFrame) -> DataFrame:
    """Aligned stretches: doc, text_key, source, word_lo, word_hi, byte_lo,
    byte_hi, identity."""
    rows = docs.select(_ids().alias("doc"), _key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    # what is matched already may go anywhere
    to = F.when(F.col("at") < 0, F.xxhash64("doc", "at")).otherwise(F.col("seed"))
    matches = (rows.mapInArrow(_seeds, _SEED).repartition(to)
               .sortWithinPartitions("seed", "ahead", "doc", "text_key", "at").mapInArrow(_neighbours, _MATCH))
    found = checkpointed(matches.repartition("doc", "text_key")
                         .sortWithinPartitions("doc", "text_key", "source", "source_key", "own", "other")
                         .mapInArrow(_chained, _CHAIN))
    low = F.greatest(F.lit(0), F.floor((F.col("source_lo") - PAD) / RASTER) * RASTER).cast("int")
    high = (F.ceil((F.col("source_hi") + PAD) / RASTER) * RASTER).cast("int")
    asked = (found.select(F.col("source").alias("doc"), F.col("source_key").alias("text_key"), low.alias("from"), high.alias("to")).distinct()
             .groupBy("doc", "text_key").agg(F.collect_list(F.struct("from", "to")).alias("asked")))
    own = found.groupBy("doc", "text_key").agg(F.collect_list(F.struct(
        "source", "source_key", "lo", "hi", "source_lo", "source_hi", "own", "other")).alias("chains"))
    wanted = asked.join(own, ["doc", "text_key"], "full")
    size = found.agg(F.sum(F.octet_length("own") + F.octet_length("other") + 80)).first()[0] or 0
    if size <= BROADCAST_BYTES:  # so that texts are not shuffled for a few
        wanted = F.broadcast(wanted)
    cut = checkpointed(rows.join(wanted, ["doc", "text_key"]).select("doc", "text_key", "text", "asked", "chains")
                       .mapInArrow(_word_slices, _SLICE))
    theirs = (cut.filter("doc IS NULL").select("source", "source_key", "low", "high",
                                               F.col("words").alias("source_words"))
              .dropDuplicates(["source", "source_key", "low", "high"]))  # rows with the same id and text
    both = cut.filter("doc IS NOT NULL").join(theirs, ["source", "source_key", "low", "high"])

    def run(own_words: pa.Array, source_words: pa.Array, own_at: pa.Array, other_at: pa.Array,
            lo: pa.Array, starts: pa.Array, ends: pa.Array) -> list[pa.Array]:
        out = []
        columns = [x.to_pylist() for x in (own_words, source_words, own_at, other_at, lo, starts, ends)]
        known: dict[tuple, list[dict]] = {}  # copies of a text are alike, and lie together
        for pair in zip(*columns):
            parts = known.get(pair)
            if parts is None:
                if len(known) >= HELD_PAIRS:
                    known.clear()
                parts = known[pair] = _parts(*pair)
            out.append(parts)
        fields = [(k, pa.int32()) for k in ("word_lo", "word_hi", "byte_lo", "byte_hi")]
        return [pa.array(out, pa.list_(pa.struct([*fields, ("identity", pa.float64())])))]

    done = add_columns(
        both, ["words", "source_words", "own", "other", "lo", "starts", "ends"],
        "parts array<struct<word_lo:int,word_hi:int,byte_lo:int,byte_hi:int,identity:double>>", run,
        ["doc", "text_key", "source"])
    return done.select("doc", "text_key", "source", F.inline("parts")).distinct()


def passages(docs: DataFrame) -> DataFrame:
    """Repeated passages of each document with the stretches they are made of:
    doc, text_key, word_lo, word_hi, byte_lo, byte_hi, parts."""
    per_doc = stretches(docs).groupBy("doc", "text_key").agg(F.array_sort(F.collect_list(F.struct(
        "word_lo", "word_hi", "byte_lo", "byte_hi", "source", "identity"))).alias("s"))
    kind = ("array<struct<word_lo:int,word_hi:int,byte_lo:int,byte_hi:int,"
            "parts:array<struct<source:bigint,word_lo:int,word_hi:int,identity:double>>>>")

    def merged(columns: pa.Array) -> list[pa.Array]:
        out = []
        for spans in columns.to_pylist():
            runs: list[dict] = []
            for x in spans:
                part = {k: x[k] for k in ("source", "word_lo", "word_hi", "identity")}
                if runs and x["word_lo"] <= runs[-1]["word_hi"] + JOIN_WORDS:
                    run = runs[-1]
                    run["word_hi"] = max(run["word_hi"], x["word_hi"])
                    run["byte_hi"] = max(run["byte_hi"], x["byte_hi"])
                    run["parts"].append(part)
                else:
                    runs.append({k: x[k] for k in ("word_lo", "word_hi", "byte_lo", "byte_hi")}
                                | {"parts": [part]})
            out.append([r for r in runs if r["word_hi"] - r["word_lo"] >= MIN_WORDS])
        fields = [pa.field(k, pa.int32()) for k in ("word_lo", "word_hi", "byte_lo", "byte_hi")]
        part = pa.struct([("source", pa.int64()), ("word_lo", pa.int32()), ("word_hi", pa.int32()),
                          ("identity", pa.float64())])
        return [pa.array(out, pa.list_(pa.struct([*fields, pa.field("parts", pa.list_(part))])))]

    return (add_columns(per_doc, ["s"], f"runs {kind}", merged, ["doc", "text_key"])
            .filter("size(runs) > 0"))


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages: they stay in the first document
    that has them. A document left without a word goes, if it had one before.
    ``n_chars``, where there is such a column, follows the text."""
    doc_name, key_name = fresh("doc", docs), fresh("text_key", docs)
    left, runs_name = fresh("left", docs), fresh("runs", docs)
    run_doc, run_key = fresh("run_doc", docs), fresh("run_key", docs)
    runs = passages(docs).select("doc", "text_key", "runs").toDF(run_doc, run_key, runs_name)
    keyed = docs.withColumn(doc_name, _ids()).withColumn(key_name, _key())
    both = keyed.join(runs, (F.col(doc_name) == F.col(run_doc)) & (F.col(key_name) == F.col(run_key)),
                      "left")
    raw = F.col("text").cast("binary")
    # what is left: before, between and after the runs, in bytes
    ends = F.concat(F.transform(F.col(runs_name), lambda r: r["byte_lo"]), F.array(F.octet_length("text")))
    begins = F.concat(F.array(F.lit(0)), F.transform(F.col(runs_name), lambda r: r["byte_hi"]))
    pieces = F.zip_with(begins, ends, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    shorter = both.withColumn(left, F.when(F.col(runs_name).isNotNull(), F.array_join(pieces, "")))
    has_word = F.col(left).rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    out = shorter.filter(F.col(left).isNull() | has_word)
    out = out.withColumn("text", F.coalesce(left, "text"))
    if "n_chars" in docs.columns:
        out = replace_column(out, "n_chars", F.when(
            F.col(left).isNotNull(), F.char_length(left)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a repeated passage with the earlier document it repeats."""
    found = passages(table(spark, sf_dir, "documents"))
    return (found.select("doc", F.explode("runs").alias("r"))
            .select("doc", "r.word_lo", "r.word_hi", F.explode("r.parts").alias("p"))
            .select(F.when(F.col("doc") != _LAST_ID, F.col("doc")).alias("doc_id"),
                    F.when(F.col("p.source") != _LAST_ID, F.col("p.source")).alias("source_id"),
                    F.col("word_lo").alias("passage_start"),
                    (F.col("word_hi") - F.col("word_lo")).alias("passage_words"),
                    F.col("p.word_lo").alias("start"),
                    (F.col("p.word_hi") - F.col("p.word_lo")).alias("n_words"),
                    F.col("p.identity").alias("identity")))
