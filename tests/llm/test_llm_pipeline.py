"""The pipeline's stages one after the other, over documents with planted
copies, passages, benchmark text and toxic words."""

import random

import pytest

import llm_helpers as H

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(77)
    rows, labels, kind = [], [], {}
    passage, items = H.words(rng, 65), [(i, H.words(rng, 30)) for i in range(5)]

    def add(name, text):
        kind[len(rows)] = name
        rows.append((len(rows), text, "en", "s", len(text)))
    for i in range(120):
        add("clean", H.words(rng, 150, 50_000))
    for i in range(60):
        w = H.words(rng, 120, 50_000).split()
        w[20] = w[50] = w[70] = "vilestuff" + rng.choice(["", "er", "ing"])
        add("toxic", " ".join(w))
    for i in range(6):
        add("copy", rows[i][1])
        add("near", rows[10 + i][1] + " extra")
    for i in range(6):
        add("passage", H.words(rng, 80, 50_000) + " " + passage + " " + H.words(rng, 80, 50_000))
    for i in range(5):
        add("leak", H.words(rng, 80, 50_000) + " " + items[i][1] + " " + H.words(rng, 80, 50_000))
    labels = [(d, 1, int(k == "toxic")) for d, k in kind.items()]
    folder = tmp_path_factory.mktemp("planted")
    sf = H.tables(folder, spark, documents=spark.createDataFrame(rows, H.SCHEMA),
                  labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
                  benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    return sf, rows, kind


def test_stages_decide_as_planted(spark, planted):
    sf, rows, kind = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, by = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        by[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == columns
    gone = lambda name: {kind[d] for d in range(len(rows)) if d not in by[name]}
    assert gone("toxicity") == {"toxic"}
    assert not any(kind[d] == "toxic" for d in by["toxicity"])
    assert sum(kind[d] in ("copy", "near") for d in by["simhash"]) <= 1
    assert all(d in by["simhash"] for d, k in kind.items() if k == "clean")
    first = min(d for d, k in kind.items() if k == "passage")
    for d, k in kind.items():
        if k == "passage":
            assert (by["substring"][d]["text"] == rows[d][1]) == (d == first)
        if k == "clean":
            assert by["substring"][d]["text"] == rows[d][1]
    assert not any(kind[d] == "leak" for d in by["decontamination"])
    assert set(by["byte_bpe"]) == set(by["decontamination"])


def test_run_equals_the_stages(spark, planted):
    sf, _, kind = planted
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() == sum(k in ("clean", "passage") for k in kind.values()) + sum(
        kind[r["doc_id"]] in ("copy", "near") for r in got.collect())
    assert corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substring", "decontamination", "byte_bpe"]


def test_pipeline_over_odd_documents(spark, tmp_path):
    sf = H.tables(tmp_path, spark, documents=H.odd_docs(spark),
                  labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"),
                  benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    ids = sorted((r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()), key=repr)
    assert ids == sorted([1, 4, 5, 7, 8, 8, -9, None], key=repr)
