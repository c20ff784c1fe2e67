"""Toxicity by weak supervision.

Voters look for word patterns: the words of fixed insult lists, one voter per
list, and word beginnings or whole words mined from the labelled sample, one
voter each; one more voter says "clean" where nothing is found, and the known
label of a training row votes too. A generative model with a hidden class
(fitted by expectation maximization, without assuming that voters are
independent: each vote counts by the inverse of its summed correlation with
the others) turns the votes into posterior labels. A linear classifier on
pattern counts is trained on those posteriors and scores every whole text.

Inputs: null text is the empty text and gets a score like any other. Labels
that are null are left out; a document with several label rows or several text
rows is used once per pair. Without labelled rows, or with one class only, the
insult lists alone vote. Other columns of documents are kept by ``filtered``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (WORD, add_columns, checkpointed, crc_remainder, fresh, labelled_texts, table,
                     texts)

#: Labelled rows of each class that are used for training, at most.
SAMPLE_PER_CLASS = 4000
#: Mined patterns that become voters, at most, and candidates for them.
MAX_VOTERS = 64
MAX_CANDIDATES = 3000
#: A mined pattern occurs in so many toxic sample documents at least ...
MIN_SUPPORT = 6
#: ... which are this share of the (class-balanced) documents it occurs in.
MIN_PRECISION = 0.9
THRESHOLD = 0.7
#: Lengths of mined word beginnings, and how often one has to occur in a
#: document to be a sign (each number is a candidate of its own).
STEMS = (4, 5, 6, 7, 8)
REPEATS = (1, 2, 3)

#: Common insults, by language.
LEXICONS = {
    "en": "idiot moron stupid loser scum trash worthless pathetic disgusting clown bastard jerk "
          "imbecile dumb filthy bitch asshole",
    "fr": "connard idiote crétin abruti salaud ordure imbécile débile minable bouffon",
    "de": "idiotin trottel arschloch depp abschaum dummkopf versager wertlos widerlich mistkerl",
    "es": "idiotas estúpido imbécil basura cabrón gilipollas tonto escoria inútil asqueroso",
}

# A pattern is a word ("scum") or a word beginning ("vequ*").
Patterns = tuple[str, ...]


@lru_cache(maxsize=4)
def _automaton(patterns: Patterns) -> ahocorasick.Automaton:
    found: dict[str, list[tuple[int, bool]]] = {}
    for i, p in enumerate(patterns):
        found.setdefault(p.rstrip("*"), []).append((i, p.endswith("*")))
    out = ahocorasick.Automaton()
    for word, entries in found.items():
        out.add_word(word, (len(word), entries))
    out.make_automaton()
    return out


def _in_word(c: str) -> bool:
    return c.isalnum()


def pattern_counts(text: str, patterns: Patterns) -> dict[int, int]:
    """How often each pattern (by index) occurs at the start of a word."""
    out: dict[int, int] = {}
    if not patterns:
        return out
    low = text.lower()
    n = len(low)
    for last, (size, entries) in _automaton(patterns).iter(low):
        first = last - size + 1
        if first and _in_word(low[first - 1]):
            continue
        whole = last + 1 == n or not _in_word(low[last + 1])
        for i, stem in entries:
            if stem or whole:
                out[i] = out.get(i, 0) + 1
    return out


def _signs(text: str) -> list[str]:
    """"pattern n" for each pattern that occurs n times or more, n in REPEATS."""
    counts: Counter = Counter()
    for w, n in Counter(WORD.findall(text.lower())).items():
        if w.isdigit():
            continue
        if len(w) > 2:
            counts[w] += n
        for k in STEMS:
            if len(w) >= k:
                counts[w[:k] + "*"] += n
    return [f"{p} {r}" for p, n in counts.items() for r in REPEATS if n >= r]


# -- label model -----------------------------------------------------------
class LabelModel:
    """Hidden class behind voters that say 1, -1 or nothing (0)."""

    def __init__(self, prior: float) -> None:
        self.prior = min(max(prior, 0.02), 0.98)

    def fit(self, votes: np.ndarray, trusted: int, rounds: int = 30) -> np.ndarray:
        """Posterior probability of class 1 for every row of ``votes``.

        Voters start as right four times out of five, ``trusted`` far more
        often; one that repeats others starts with a share of a vote. How
        voters correlate within a class is taken from these first classes; a
        vote then counts by the inverse of its summed correlations.
        """
        n, m = votes.shape
        everyone = np.ones(n)
        trust = 1.4 / self._correlations(votes, everyone).sum(axis=1)
        trust[trusted] = 4.0
        values = np.stack([votes == v for v in (-1, 0, 1)]).astype(np.float64)
        odds = np.log(self.prior / (1 - self.prior))
        post = _sigmoid(votes @ trust + odds)
        self.correlation = self._correlations(votes, (post > 0.5).astype(np.float64))
        self.weight = 1 / self.correlation.sum(axis=1)
        for _ in range(rounds):
            mass = np.array([(1 - post).sum(), post.sum()])
            seen = np.stack([np.einsum("vnm,n->vm", values, q) for q in (1 - post, post)])
            given = (seen + 0.5) / (mass[:, None, None] + 1.5)  # class, value, voter
            ratio = np.log(given[1]) - np.log(given[0])
            new = _sigmoid(np.einsum("vnm,vm->n", values, ratio * self.weight) + odds)
            moved = np.abs(new - post).max()
            post = new
            if moved < 1e-4:
                break
        self.accuracy = self._accuracies(votes, post)
        return post

    @staticmethod
    def _correlations(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
        """Absolute correlation of two voters within a class, the larger of both."""
        out = np.eye(votes.shape[1])
        for q in (post, 1 - post):
            q = q / max(q.sum(), 1e-9)
            centred = votes - q @ votes
            cov = (centred * q[:, None]).T @ centred
            sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            rho = np.abs(cov / np.outer(sd, sd))
            rho[rho < 0.2] = 0  # noise of a bounded sample
            out = np.maximum(out, np.minimum(rho, 1))
        np.fill_diagonal(out, 1)
        return out

    @staticmethod
    def _accuracies(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
        right = ((votes == 1) * post[:, None]).sum(0) + ((votes == -1) * (1 - post[:, None])).sum(0)
        return right / np.maximum((votes != 0).sum(0), 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# -- classifier ------------------------------------------------------------
def _features(counts: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Per pattern: found at least as often as it takes to be a sign, log count
    beyond; of all: log hits, log kinds, log density."""
    counts = np.maximum(counts - (least - 1), 0)
    hits = counts.sum(axis=1)
    return np.column_stack([
        counts > 0, np.log1p(counts), np.log1p(hits), np.log1p((counts > 0).sum(axis=1)),
        np.log1p(1000 * hits / np.maximum(lengths, 20)), np.ones(len(counts))]).astype(np.float64)


def _fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty),
                               x.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Patterns and weights; small, so it travels with the tasks."""

    def __init__(self, patterns: Patterns, least: np.ndarray, weights: np.ndarray) -> None:
        self.patterns, self.least, self.weights = patterns, least, weights

    def counts(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(docs), len(self.patterns)), dtype=np.float64)
        for row, text in enumerate(docs):
            for i, n in pattern_counts(text, self.patterns).items():
                out[row, i] = n
        return out, np.array([len(t) for t in docs], dtype=np.float64)

    def scores(self, docs: list[str]) -> np.ndarray:
        if not docs:
            return np.zeros(0)
        return _sigmoid(_features(*self.counts(docs), self.least) @ self.weights)


# -- training --------------------------------------------------------------
def _document_counts(sample: DataFrame) -> DataFrame:
    """In how many toxic and clean sample documents each sign occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter = Counter()
        clean: Counter = Counter()
        for batch in batches:
            for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                (toxic if label else clean).update(_signs(text))
        names = list(toxic)  # what is in no toxic document is no candidate
        for a in range(0, len(names), 50_000):
            part = names[a : a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([toxic[x] for x in part], pa.int64())],
                names=["pattern", "toxic"])
        for a in range(0, len(names := list(clean)), 50_000):
            part = names[a : a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([-clean[x] for x in part], pa.int64())],
                names=["pattern", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, "pattern string, toxic bigint")
    return rows.groupBy("pattern").agg(
        F.sum(F.when(F.col("toxic") > 0, F.col("toxic")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") < 0, -F.col("toxic")).otherwise(0)).alias("clean"))


def _cover(presence: np.ndarray, toxic: np.ndarray) -> list[int]:
    """Patterns that, one after the other, explain the most unexplained toxic
    documents; ties go to the earlier pattern."""
    left = presence[toxic == 1].copy()
    chosen: list[int] = []
    while len(chosen) < MAX_VOTERS and left.shape[1]:
        gain = left.sum(axis=0)
        best = int(gain.argmax())
        if gain[best] < MIN_SUPPORT:
            break
        chosen.append(best)
        left = left[~left[:, best]]
    return chosen


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Mine patterns, fit the label model and the classifier on the sample."""
    words = sorted({w for x in LEXICONS.values() for w in x.split()})
    sample = checkpointed(labelled_texts(docs, labels, "toxic", per_class))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    signs: list[tuple[str, int]] = []
    if n1 and n0:
        share = F.col("toxic") / n1 / (F.col("toxic") / n1 + F.col("clean") / n0)
        signs = [(p, int(n)) for p, n in (r["pattern"].rsplit(" ", 1) for r in _document_counts(sample)
                 .filter((F.col("toxic") >= MIN_SUPPORT) & (share >= MIN_PRECISION))
                 .orderBy(F.desc("toxic"), F.length("pattern"), "pattern").limit(MAX_CANDIDATES)
                 .collect())]
    candidates = tuple(dict.fromkeys([p for p, _ in signs] + words))

    # the sample's pattern counts: 2 * per_class rows of sparse counts at most
    def run(text: pa.Array) -> list[pa.Array]:
        found = [pattern_counts(t, candidates) for t in texts(text)]
        return [pa.array([list(x) for x in found], pa.list_(pa.int32())),
                pa.array([list(x.values()) for x in found], pa.list_(pa.int32())),
                pa.array([len(t) for t in texts(text)], pa.int64())]

    rows = add_columns(sample, ["text"], "which array<int>, counts array<int>, size bigint",
                       run, ["toxic"]).collect()
    rows.sort(key=lambda r: (r["toxic"], r["size"], r["which"], r["counts"]))
    counts = np.zeros((len(rows), len(candidates)), dtype=np.float32)
    for k, r in enumerate(rows):
        counts[k, r["which"]] = r["counts"]
    label = np.array([r["toxic"] for r in rows], dtype=np.int64)
    lengths = np.array([r["size"] for r in rows], dtype=np.float64)
    place = {p: i for i, p in enumerate(candidates)}
    of = np.array([place[p] for p, _ in signs], dtype=np.int64)
    present = counts[:, of] >= np.array([n for _, n in signs]) if signs else np.zeros((len(rows), 0), bool)
    chosen = _cover(present, label)
    # a pattern is one voter, with the number that explains most
    mined = list({p: (p, n) for p, n in reversed([signs[i] for i in chosen])}.values())[::-1]
    used = mined + [(w, 1) for w in words if w not in {p for p, _ in mined}]
    patterns = tuple(p for p, _ in used)
    least = np.array([n for _, n in used], dtype=np.float64)
    if not (n1 and n0):
        # nothing to learn from: any listed insult speaks for toxicity
        weights = np.zeros(2 * len(used) + 4)
        weights[-4], weights[-1] = 8.0, -4.0
        return Model(patterns, least, weights)
    counts = counts[:, [place[p] for p in patterns]]
    found = counts >= least
    lists = [[patterns.index(w) for w in x.split()] for x in LEXICONS.values()]
    voters = [found[:, i].astype(int) for i in range(len(mined))]
    voters += [found[:, x].any(axis=1).astype(int) for x in lists]
    voters.append(-(~found.any(axis=1)).astype(int))
    voters.append(2 * label - 1)
    post = LabelModel(n1 / (n1 + n0)).fit(np.column_stack(voters), trusted=len(voters) - 1)
    return Model(patterns, least, _fit_linear(_features(counts, lengths, least), post))


def scored(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """Columns ``keep`` and the toxicity score of every whole text."""
    return add_columns(docs, ["text"], f"`{name}` double",
                       lambda col: [pa.array(model.scores(texts(col)), pa.float64())], keep)


def filtered(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents below the threshold, columns as in ``docs``. Labels are
    learned outside the held-out fold, as in the query."""
    model = train(docs, _training_fold(labels))
    score = fresh("toxicity", docs)
    return (scored(docs, model, docs.columns, score).filter(F.col(score) < threshold).drop(score))


def _training_fold(labels: DataFrame) -> DataFrame:
    return labels.filter(crc_remainder(F.col("doc_id"), 3) != 1)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, _training_fold(table(spark, sf_dir, "labels")))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id",
        F.coalesce(crc_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
