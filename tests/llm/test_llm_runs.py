"""Periodic runs (op12) against a direct search for every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import llm_helpers as H
from litreflow.llm import periodic_runs as R


def brute_runs(words, least=6, exponent=4):
    """Every maximal stretch of least period q, by trying all periods."""
    found = {}
    n = len(words)
    for q in range(1, n + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - (i - q) >= max(least, exponent * q):
                found.setdefault((i - q, j), q)  # q rises: the least comes first
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_row(doc, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for a, size, q in runs for i in range(a + q, a + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{size},{q}\n" for a, size, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def random_words(rng):
    """Words of a few kinds with periodic stretches of all sizes, some nested."""
    out = []
    while len(out) < rng.choice([5, 60, 400, 900]):
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        elif kind < 0.8:
            root = [rng.randrange(rng.choice([2, 5, 500])) for _ in range(rng.randrange(1, 140))]
            if rng.random() < 0.3:
                root = root[: rng.randrange(1, 5)] * 4 + root  # a run within the period
            size = int(len(root) * rng.uniform(2.5, 7)) + rng.randrange(4)
            out += (root * 9)[:size]
        else:
            out += [rng.randrange(3)] * rng.randrange(1, 30)
    return out


@pytest.mark.parametrize("exponent,least", [(4, 6), (3, 5), (5, 1)])
def test_random_sequences_equal_brute_force(exponent, least, monkeypatch):
    rng = random.Random(exponent)
    for short in (32, 2):
        monkeypatch.setattr(R, "SHORT_LAG", short)
        for _ in range(60):
            words = random_words(rng)
            got = R.runs_of(np.array([hash(("w", w)) & (1 << 64) - 1 for w in words], dtype=np.uint64),
                            least, exponent)
            got = sorted((int(a), int(b - a), int(q)) for a, b, q in got)
            assert got == brute_runs(words, least, exponent)


def test_fewer_than_three_periods_is_an_error():
    with pytest.raises(ValueError):
        R.runs_of(np.zeros(4, dtype=np.uint64), 4, 2)


def test_long_periodic_texts_are_found_in_near_linear_time():
    rng = random.Random(8)
    root = [rng.randrange(50) for _ in range(20_001)]
    words = np.array([rng.randrange(50) for _ in range(999)] + root * 5 + [99], dtype=np.uint64)
    runs = R.runs_of(R.mix64(words))
    assert [999, 999 + 5 * 20_001, 20_001] in runs.tolist()
    one = R.runs_of(np.full(300_000, 7, dtype=np.uint64))
    assert one.tolist() == [[0, 300_000, 1]]


def test_texts_of_one_group_do_not_mix():
    same = b"a b c a b c"
    out = R.collapse([same, same, same, b"", b"x", same + b" " + same])
    assert [len(x[1]) for x in out] == [0, 0, 0, 0, 0, 1]
    assert out[5][2] == b"a b c" and out[3][2] == b""


def test_query_equals_brute_force_on_odd_documents(spark, tmp_path):
    from pyspark.sql import functions as F
    df = H.odd_docs(spark)
    for c in ("w", "g", "n", "a", "p", "collapsed", "n_runs", "longest"):
        df = df.withColumn(c, F.lit("x"))
    sf = H.tables(tmp_path, spark, documents=df)
    out = R.op12_periodic_runs(spark, sf)
    assert out.columns[:8] == COLUMNS
    # the texts of one word of 300,000 letters and of 30,000 words have no run
    want = [brute_row(d, t) if len(t or "") < 100_000 else None for d, t, *_ in H.odd_rows()]
    got = H.rows_of(out, *COLUMNS)
    for row in filter(None, want):
        assert row in got
    assert len(got) == len(want)


def test_query_equals_brute_force_with_edited_rows(spark, tmp_path):
    rng = random.Random(3)
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:60] + list(range(60)) + [None, 5, 5]
    rows = []
    for d in ids:
        text = rng.choice([" ", "\n\t", "  "]).join(f"w{x}" for x in random_words(rng))
        rows.append((d, rng.choice(["", " ", "\r"]) + text, "en", "a", 1))
    rows += [(i, t, "en", "a", 1) for i in ids[:5] for t in (None, "", " \x0b ", "one")]
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    got = H.rows_of(R.op12_periodic_runs(spark, sf), *COLUMNS)
    assert got == sorted((brute_row(r[0], r[1]) for r in rows), key=repr)


def test_empty_table(spark, tmp_path):
    sf = H.tables(tmp_path, spark, documents=H.empty_docs(spark))
    assert R.op12_periodic_runs(spark, sf).collect() == []
