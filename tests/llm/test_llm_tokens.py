"""Byte-level BPE (op9) and packing (op6)."""

import base64
import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import llm_helpers as H
from litreflow.llm import bpe, packing


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_equal_the_library(reference):
    rng = random.Random(3)
    alphabet = list("abst'rveldm  \n\t 　é1²½٣.,-!'''日本\U0001F600́ſ\x1c\x85ªⅣ ")
    docs = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)]
    docs += ["a" * 3000 + "'re" * 60, "x" * 500 + " " * 400, "'", " ", "  ", "'s's've", "\n's", " 's"]
    ids, offsets = bpe.encode_texts(docs)
    for doc, got, at in zip(docs, ids, offsets):
        assert got.tolist() == reference.encode_ordinary(doc)
        assert not len(at) or at[0] == 0


def test_every_code_point_equals_the_library(reference):
    # after a letter, a number, a quote and white space, before and after its like
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for context in ("a{0}1{0} ", "{0}{0}b'{0}s\n{0}"):
        docs = ["".join(context.format(chr(c)) for c in points[i : i + 256]) for i in range(0, len(points), 256)]
        ids, _ = bpe.encode_texts(docs)
        assert [d for d, got in zip(docs, ids) if got.tolist() != reference.encode_ordinary(d)] == []


def test_long_slices_merge_like_short_ones():
    vocab = bpe._vocabulary(bpe.VOCABULARY)
    rng = random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 60))).encode()
        assert vocab._merge_long(word) == vocab.merge(word) or len(word) == 1


def test_round_trip_of_odd_documents(spark, tmp_path, reference):
    sf = H.tables(tmp_path, spark, documents=H.odd_docs(spark))
    got = H.rows_of(bpe.op9_byte_bpe(spark, sf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for doc, text, *_ in H.odd_rows():
        ids = reference.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_encode_keeps_other_columns(spark):
    docs = H.odd_docs(spark)
    assert set(bpe.encode(docs).columns) == set(docs.columns)  # ids and offsets replaced
    assert bpe.encode(docs).schema["ids"].dataType.simpleString() == "array<int>"


def test_empty_table(spark, tmp_path):
    sf = H.tables(tmp_path, spark, documents=H.empty_docs(spark))
    assert bpe.op9_byte_bpe(spark, sf).count() == 0
    assert packing.op6_packing(spark, sf).count() == 0


def test_best_fit_matches_brute_force():
    rng = random.Random(2)
    for _ in range(100):
        length = rng.choice([7, 8, 64])
        sizes = [rng.randint(1, length) for _ in range(rng.randrange(60))]
        rows, free = [], []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(free[r], r) for r in range(len(rows)) if free[r] >= sizes[i]]
            if fits:
                least = min(f for f, _ in fits)
                r = next(r for f, r in fits if f == least)
            else:
                rows.append([])
                free.append(length)
                r = len(rows) - 1
            rows[r].append(i)
            free[r] -= sizes[i]
        got = packing.packed(sizes, length)
        assert sorted(i for r in got for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= length for r in got)
        assert len(got) == len(rows)  # rows of equal capacity are interchangeable


def test_packing_is_lossless(spark, reference):

    docs = H.odd_docs(spark)
    rows = packing.pack(docs, row_length=256, bucket_chars=50_000).collect()
    found = defaultdict(lambda: defaultdict(list))
    for r in rows:
        ids, positions = (np.frombuffer(r[c], dtype="<u4") for c in ("ids", "positions"))
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256
        assert not ids[r["n_tokens"]:].any()
        for doc, part, a, b in zip(r["doc_ids"], r["parts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            found[doc][part].append(ids[a:b].tolist())
    for doc, text, *_ in H.odd_rows():
        ids = reference.encode_ordinary(text or "")
        for part, at in enumerate(range(0, len(ids), 256)):
            assert ids[at : at + 256] in found[doc][part]
    total = sum(len(reference.encode_ordinary(t or "")) for _, t, *_ in H.odd_rows())
    assert sum(r["n_tokens"] for r in rows) == total


def test_copies_of_a_row_are_packed_part_by_part(spark, reference):
    text = "the same words for each of a great many rows " * 20
    docs = spark.createDataFrame([(1, text, "en", "a", 1)] * 300 + [(2, "another", "en", "a", 1)], H.SCHEMA)
    n = len(reference.encode_ordinary(text))
    rows = packing.pack(docs, row_length=512, bucket_chars=20 * n).collect()
    assert sum(r["n_tokens"] for r in rows) == 300 * n + len(reference.encode_ordinary("another"))
    assert len({(r["bucket"], r["row"]) for r in rows}) == len(rows)
    # one batch of copies at a time, however many there are in the bucket
    batches = [packing.pa.RecordBatch.from_arrays(
        [packing.pa.array(x) for x in ([0] * 300, [1] * 300, [text] * 300)], names=["bucket", "doc_id", "text"])]
    sizes = [b.num_rows for b in packing._pack_buckets(iter(batches), packing.VOCABULARY, 512, 20 * n)]
    assert len(sizes) >= 15


def test_packing_does_not_depend_on_partitions(spark):
    docs = H.odd_docs(spark, extra=False)
    one, many = (packing.pack(d, 128, bucket_chars=40_000).drop("doc_ids", "parts")
                 for d in (docs.coalesce(1), docs.repartition(7)))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_matrix_merging_equals_one_by_one():
    vocab = bpe._vocabulary(bpe.VOCABULARY)
    rng = random.Random(12)
    for size in (1, 2, 3, 7, 19, 40):
        words = ["".join(rng.choice("aeinrst hlé") for _ in range(size)).encode()[:size] for _ in range(200)]
        words = [w for w in words if len(w) == size]
        got = vocab.merge_rows(words)
        one = {w: np.array(vocab._merge_long(w), dtype="<i4").tobytes() for w in words}
        # a slice that is one token is looked up before merging
        assert got == [one[w] for w in words]


def test_results_do_not_depend_on_the_cache(monkeypatch):
    rng = random.Random(14)
    docs = [H.words(rng, 400, 3000) for _ in range(60)]
    want = [x.tolist() for x in bpe.encode_texts(docs)[0]]
    monkeypatch.setattr(bpe, "CACHE_SLICES", 40)
    bpe._vocabulary.cache_clear()
    assert [x.tolist() for d in docs for x in bpe.encode_texts([d])[0]] == want
    vocab = bpe._vocabulary(bpe.VOCABULARY)
    assert len(vocab.old) < 3000 and len(vocab.young) < 3000
    bpe._vocabulary.cache_clear()
