"""Pattern packing (op11): plan against brute force, pieces against the library."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import llm_helpers as H
import public_tokenizers
from litreflow.llm import pattern_packing as P


def reference_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    t.encode_special_tokens = True
    return [[*t.encode(x, add_special_tokens=False).ids, 1] for x in texts]


def check_plan(plan, histogram):
    """Every piece has one place; sequences have no gap and no excess."""
    spots = defaultdict(list)
    firsts = sorted(plan.runs)
    number = 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            first, sequence, offset, of, each = max(r for r in firsts if r[0] <= number)
            assert of == length
            step, within = divmod(number - first, each)
            spots[sequence + step].append((offset + within * length, length))
            number += 1
    for places in spots.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= plan.sequence_length
    assert len(spots) == plan.sequences


def best_fit_decreasing(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def test_patterns_are_all_partitions():
    for units, most in [(1, 1), (7, 3), (12, 4), (9, 2)]:
        want = {tuple(sorted(c, reverse=True)) for k in range(1, most + 1)
                for c in itertools.combinations_with_replacement(range(1, units + 1), k) if sum(c) == units}
        got = P.patterns(units, most)
        assert set(got) == want and len(got) == len(want)


def test_least_squares_meets_its_conditions():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a = rng.integers(0, 4, size=(rng.integers(2, 8), rng.integers(2, 15))).astype(float)
        b = rng.integers(0, 50, size=a.shape[0]).astype(float)
        x = P.non_negative_least_squares(a, b)
        gain = a.T @ (b - a @ x)
        # no column could lower the error, and used ones are at their optimum
        assert (x >= 0).all() and (gain <= 1e-5).all() and np.abs(gain[x > 1e-9]).max(initial=0) < 1e-5


@pytest.mark.parametrize("shape", ["mixed", "halves", "one", "short", "full"])
def test_plan_places_every_piece_once(shape):
    rng = random.Random(shape)
    for _ in range(12):
        size = rng.randrange(5, 120)
        draw = {"mixed": lambda: rng.randrange(1, size + 1), "halves": lambda: size // 2 + rng.randrange(0, 3),
                "one": lambda: size // 3, "short": lambda: rng.randrange(1, 4), "full": lambda: size}[shape]
        lengths = [min(size, max(1, draw())) for _ in range(rng.randrange(1, 250))]
        histogram = dict(Counter(lengths))
        plan = P.planned(histogram, size)
        check_plan(plan, histogram)
        for units, most in P.SHAPES:
            check_plan(P.fitted(histogram, size, units, most), histogram)
        assert -(-sum(lengths) // size) <= plan.sequences <= best_fit_decreasing(lengths, size) * 1.03 + 1


def test_patterns_beat_best_fit_where_pieces_must_match():
    # thirds of unequal length: falling order pairs them badly
    rng = random.Random(4)
    lengths = []
    for _ in range(3000):
        a, b = sorted(rng.sample(range(900, 2300), 2))
        lengths += [x for x in (a, b, 4096 - a - b) if x >= 900]
    histogram = dict(Counter(lengths))
    assert P.planned(histogram).sequences < best_fit_decreasing(lengths, 4096)


def test_plan_is_small_for_any_number_of_pieces():
    rng = random.Random(6)
    histogram = {n: rng.randrange(1, 10**9) for n in range(1, 4097)}
    plan = P.planned(histogram)
    total = sum(n * c for n, c in histogram.items())
    assert plan.sequences <= 1.01 * -(-total // 4096)
    assert len(plan.runs) < 60_000
    assert sum(plan.left.values()) == 0


def check_pieces(rows, texts_by_row, size):
    """rows of the query against the ids of the texts, as a multiset."""
    want = Counter()
    for doc, ids in texts_by_row:
        for k, at in enumerate(range(0, len(ids), size)):
            raw = np.array(ids[at : at + size], dtype="<u4").tobytes()
            want[(doc, k, at, len(raw) // 4, zlib.crc32(raw))] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= size
    total = sum(len(ids) for _, ids in texts_by_row)
    return len(places), -(-total // size)


def test_odd_documents(spark, tmp_path):
    rows = H.odd_rows() + [(20, "a <|endoftext|> b <|startoftext|>", "en", "a", 33)]
    df = H.odd_docs(spark)
    from pyspark.sql import functions as F
    more = spark.createDataFrame(rows[-1:], H.SCHEMA)
    for c in H.CLASHING + ["length", "row_id", "part", "sequence_id"]:
        df = df.withColumn(c, F.lit("x"))
        more = more.withColumn(c, F.lit("y"))
    sf = H.tables(tmp_path, spark, documents=df.unionByName(more))
    out = P.op11_pattern_packing(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = reference_ids([r[1] or "" for r in rows])
    used, least = check_pieces(out.collect(), [(r[0], i) for r, i in zip(rows, ids)], P.SEQUENCE_LENGTH)
    assert used == least


def test_word_ids_equal_the_library_for_every_code_point():
    t = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    t.encode_special_tokens = True
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    docs = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}'s{chr(c)}" for c in points[i : i + 64])
            for i in range(0, len(points), 64)]
    parts = [*" \t\n\r\x0b\x0c\x1c\x1d\x85\xa0\u3000 abé1²'sΣσÉ\u0301\u0302İßŉ日本.,-!", "'re", "<|endoftext|>", "ΣΑΣ "]
    docs += ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(5000)]
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in t.encode_batch(docs, add_special_tokens=False)]
    assert list(P.WordIds(P.VOCABULARY)([d.encode() for d in docs])) == want


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    rng = random.Random(2)
    docs = [H.words(rng, 200, 5000).encode() for _ in range(40)] + [b"x" * 500, b"x" * 500]
    want = list(P.WordIds(P.VOCABULARY)(docs))
    monkeypatch.setattr(P, "HELD_WORDS", 50)
    monkeypatch.setattr(P, "BATCH_CHARS", 100)
    monkeypatch.setattr("litreflow.llm.common.GROUP_CHARS", 3000)
    assert list(P.WordIds(P.VOCABULARY)(docs)) == want


def test_words_are_encoded_once_in_either_case_and_while_they_are_met(monkeypatch):
    ids_of, asked = P.WordIds(P.VOCABULARY), []
    whole, plain = ids_of.encode, ids_of.encode_plain

    def counted(encode):
        def run(strings, **options):
            asked.extend(w for x in strings for w in x.split(" "))
            return encode(strings, **options)
        return run

    ids_of.encode, ids_of.encode_plain = counted(whole), counted(plain)
    list(ids_of(["\u00c9tre \u00e9tre \u00c9TRE Word word".encode()]))
    assert sorted(asked) == ["word", "\u00e9tre"]
    monkeypatch.setattr(P, "HELD_WORDS", 100)
    asked.clear()
    for k in range(40):  # 800 words go by, one stays
        list(ids_of([" ".join(["usual,", *(f"x{k}y{j}" for j in range(20))]).encode()]))
    assert asked.count("usual") == 1 and len(ids_of.held) + len(ids_of.older) <= 200


@pytest.mark.parametrize("text", [
    "H\u0331 \u1e96 T\u0308t J\u030c", "\u00c9\u0301x \u00c9. \u00c9TRE,", "\u0130stanbul \u1e9e \u0391\u03a3.",
    "<|ENDOFTEXT|> <|endoftext|>,", "Foo., bar!? (X), DON'T 'S \u00c9's", "\u00d7\u00d7 \u00df\u00de \u00f7 \u212aK",
    "A\x1cB\x85C D\x0bE"])
def test_words_in_lower_case_have_the_ids_of_the_text(text):
    want = np.array(reference_ids([text])[0][:-1], dtype="<u4").tobytes()
    assert list(P.WordIds(P.VOCABULARY)([text.encode()])) == [want]


def test_empty_table(spark, tmp_path):
    sf = H.tables(tmp_path, spark, documents=H.empty_docs(spark))
    assert P.op11_pattern_packing(spark, sf).collect() == []


def test_copies_spread_and_written_sequences(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 16)
    rng = random.Random(9)
    rows = [(i % 90, H.words(rng, rng.randrange(1, 40)), "en", "a", 1) for i in range(300)]
    rows += [(5, "the same words again and again", "en", "a", 1)] * 200  # one id, one text
    docs = spark.createDataFrame(rows, H.SCHEMA).repartition(5)
    packed = P.pack(docs, sequence_length=64)
    got = packed.collect()
    ids = reference_ids([r[1] for r in rows])
    used, least = check_pieces(got, [(r[0], i) for r, i in zip(rows, ids)], 64)
    assert used <= 1.02 * least
    path = f"{tmp_path}/packed"
    P.write_packed(packed, path)
    back = {}
    for r in spark.read.parquet(path).collect():
        row = np.frombuffer(bytes(r["ids"]), dtype="<u4")
        assert len(row) == r["n_tokens"] == r["cu_seqlens"][-1] == len(r["positions"]) <= 64
        for a, b, doc, part in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], r["parts"]):
            assert r["positions"][a:b] == list(range(b - a))
            back.setdefault((doc, part), []).append(tuple(row[a:b].tolist()))
    want = {}
    for (doc, *_), x in zip(rows, ids):
        for k, at in enumerate(range(0, len(x), 64)):
            want.setdefault((doc, k), []).append(tuple(x[at : at + 64]))
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in want.items()}
