"""Training samples under an id that holds a third of the rows, and the
classifiers' results against plain loops."""

import random

import numpy as np
import zstandard

import llm_helpers as H
from litreflow.llm import langid, quality, toxicity
from litreflow.llm.common import labelled_texts

LABELS = "doc_id bigint, quality int, toxic int"


def _hot(spark, n=900):
    """A third of the rows has one id, with many texts; others one row each."""
    rng = random.Random(1)
    rows = [(i, H.words(rng, rng.randrange(5, 60), 300), "en" if i % 2 else "fr", "a", 1) for i in range(2 * n)]
    rows += [(7, f"hot {i % 40} " + H.words(rng, 30, 50), "en", "a", 1) for i in range(n)]
    labels = [(i, i % 2, i % 2) for i in range(2 * n)] + [(7, 1, 1)] * n
    return (spark.createDataFrame(rows, H.SCHEMA).repartition(6), spark.createDataFrame(labels, LABELS).repartition(4),
            rows)


def test_collected_rows_stay_within_the_sample(spark, monkeypatch):
    docs, labels, _ = _hot(spark)
    for label in ("quality", "toxic"):
        found = labelled_texts(docs, labels, label, 50).collect()
        assert len(found) <= 100 and {r[label] for r in found} == {0, 1}
        everything = labelled_texts(docs, labels, label, 10_000).collect()
        assert len(everything) == 1800  # one row an id
        assert sum(r.text.startswith("hot") for r in everything) <= 1
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 40)
    rows = langid.sampled(docs).collect()
    assert len(rows) <= 80 and len({(r.lang, r.place) for r in rows}) == len(rows)


def test_one_text_does_not_fill_a_dictionary(spark):
    rng = random.Random(2)
    long = H.words(rng, 100_000, 500)
    rows = [(1, long, "en", "a", 1)] * 50 + [(i, f"own{i} text", "en", "a", 1) for i in range(2, 60)]
    content = langid.dictionaries(spark.createDataFrame(rows, H.SCHEMA))["en"].decode()
    assert len(content) <= 2 * langid.SLICE_BYTES
    assert all(f"own{i} text" in content for i in range(2, 60))


def test_training_on_a_hot_id_gives_the_model_of_one_row_each(spark):
    docs, labels, rows = _hot(spark, 200)
    # of the hot id's texts the one with the least hash is used
    chosen = labelled_texts(docs.filter("doc_id = 7"), labels, "toxic", 10_000).first().text
    plain = [r for r in rows if r[0] != 7] + [(7, chosen, "en", "a", 1)]
    once = spark.createDataFrame(plain, H.SCHEMA)
    a, b = toxicity.train(docs, labels), toxicity.train(once, labels.distinct())
    assert a.patterns == b.patterns and np.allclose(a.weights, b.weights)


def test_language_is_the_smallest_result_of_plain_compression():
    rng = random.Random(3)
    content = tuple((f"l{k}", " ".join(f"{chr(97 + k)}{rng.randrange(300)}" for _ in range(3000)).encode())
                    for k in range(4))
    for _ in range(60):
        k = rng.randrange(4)
        text = " ".join(f"{chr(97 + (k if rng.random() < .8 else rng.randrange(4)))}{rng.randrange(300)}" for _ in range(
            rng.randrange(1, 200))).upper()
        sizes = {}
        for lang, raw in content:
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=held, write_checksum=False,
                                            write_content_size=False, write_dict_id=False)
            sizes[lang] = len(made.compress(text.lower().encode()))
        best = min(sizes, key=lambda x: (sizes[x], x))
        lang, score, narrow = langid.choose(text.encode(), content)
        assert lang == best and 0 < score <= 1
        second = sorted(sizes.values())[1]
        assert narrow == (second - sizes[best] < langid.REJECT_MARGIN * sizes[best])


def test_quality_score_equals_a_loop_over_all_chunks():
    rng = np.random.default_rng(4)
    net = quality.Network()
    for text in (b"", b"short", bytes(rng.integers(32, 127, 3000, dtype=np.uint8))):
        parts = quality.chunks(text)
        covered = np.zeros(len(text), dtype=bool)
        for k in range(len(parts)):
            covered[k * quality.STRIDE : k * quality.STRIDE + quality.CHUNK] = True
        assert covered.all()  # the whole text, every byte in some chunk
        assert 0 <= net.score(text) <= 1
        one_by_one = [net.score(text[k * quality.STRIDE : k * quality.STRIDE + quality.CHUNK])
                      for k in range(max(1, len(parts)))]
        logits = [np.log(p / (1 - p)) for p in one_by_one]
        assert np.isclose(net.score(text), 1 / (1 + np.exp(-np.mean(logits))), atol=1e-5)


def test_pattern_counts_equal_a_scan():
    rng = random.Random(6)
    patterns = ("ab*", "abc", "b*", "ca", "xyz*")  # beginnings and whole words
    for _ in range(100):
        text = "".join(rng.choice("abcxyz   ") for _ in range(rng.randrange(60)))
        words = [w.lower() for w in toxicity.WORD.findall(text)]
        want = {}
        for i, p in enumerate(patterns):
            n = sum(w.startswith(p[:-1]) if p.endswith("*") else w == p for w in words)
            if n:
                want[i] = n
        assert dict(toxicity.pattern_counts(text, patterns)) == want
