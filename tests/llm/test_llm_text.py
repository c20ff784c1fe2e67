"""Decontamination (op2), language (op3), quality (op4), chat (op5),
toxicity (op10), the pipeline."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import llm_helpers as H
from conftest import SF_SMALL
from litreflow.llm import chat, decontam, langid, quality, queries, toxicity


def duck_rows(sql, columns, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(c)] for c in columns) for r in cur.fetchall()), key=repr)


# -- op2 ---------------------------------------------------------------------
COLUMNS2 = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def contaminated_tables(spark, short=False):
    rng = random.Random(21)
    items = [(i, H.words(rng, rng.randrange(12, 40), 60).upper()) for i in range(12)]
    items += [(12, None), (13, ""), (None, items[3][1]), (4, items[4][1]), (20, items[5][1])]
    if short:
        items += [(30, "w1 w2"), (31, "W3, w4! w5;w6 w7"), (32, "w8 w8 w8")]
    docs = H.odd_rows()
    for i in range(40):
        w = H.words(rng, 40, 60).split()
        if i % 2:
            piece = items[i % 12][1].lower().split()
            a = rng.randrange(len(piece) - 5)
            w[10:10] = piece[a : a + rng.randrange(5, 20)]
        docs.append((100 + i, " - ".join(w), "en", "s", 0))
    return spark.createDataFrame(docs, H.SCHEMA), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("short", [False, True])
def test_decontamination_equals_sql(spark, short):
    docs, bench = contaminated_tables(spark, short)
    got = H.rows_of(decontam.report(docs, bench), *COLUMNS2)
    assert got == duck_rows(decontam.ORACLE, COLUMNS2, documents=docs, benchmark=bench)
    assert sum(r[2] > 0 for r in got) > 5


def test_decontamination_without_broadcast(spark, monkeypatch):
    docs, bench = contaminated_tables(spark)
    want = H.rows_of(decontam.report(docs, bench), *COLUMNS2)
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert H.rows_of(decontam.report(docs, bench), *COLUMNS2) == want


def test_words_of_a_megabyte_are_not_broadcast(spark, monkeypatch):
    big = "x" * 1_000_000
    text = " ".join(["a", big] + [f"w{i}" for i in range(12)])
    docs = spark.createDataFrame([(1, f"before {text} after", "en", "s", 0), (2, "w1 w2 w3", "en", "s", 0)], H.SCHEMA)
    bench = spark.createDataFrame([(1, text), (2, "w5 " * 12)], "item_id bigint, text string")
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 1_500_000)
    monkeypatch.setattr(decontam.F, "broadcast", lambda df: pytest.fail("two windows of a megabyte are broadcast"))
    got = H.rows_of(decontam.report(docs, bench), "doc_id", "n_words", "n_hit", "n_items")
    assert got == [(1, 16, 14, 1), (2, 3, 0, 0)]


def test_decontaminated_documents(spark):
    docs, bench = contaminated_tables(spark)
    docs = docs.withColumn("hits", docs["text"]).withColumn("n_hit", docs["n_chars"])
    clean = decontam.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    hit = [r[0] for r in H.rows_of(decontam.report(docs, bench), "doc_id", "contaminated") if r[1]]
    assert Counter(r[0] for r in H.rows_of(clean, "doc_id")) == Counter(
        r[0] for r in H.rows_of(docs, "doc_id") if r[0] not in hit)
    nothing = bench.limit(0)
    assert decontam.decontaminated(docs, nothing).count() == docs.count()
    assert decontam.report(H.empty_docs(spark), bench).count() == 0


# -- op3 ---------------------------------------------------------------------
def lang_rows(n=120):
    rng = random.Random(2)
    parts = {"aa": ["the", "ing", "and", "th", "er"], "bb": ["eau", "ou", "le", "que", "ment"],
             "cc": ["sch", "ung", "ich", "ein", "der"]}
    return [(i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4)))
                         for _ in range(rng.randrange(4, 80))), lang, "s", 0)
            for i, lang in ((i, rng.choice(list(parts))) for i in range(n))]


def test_languages_of_held_out_rows(spark, tmp_path):
    rows = lang_rows() + H.odd_rows()
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    got = langid.op3_language(spark, sf).collect()
    lang = {r[0]: r[2] for r in lang_rows()}
    own = [r for r in got if r["held_out"] and r["doc_id"] in lang and r["doc_id"] > 10]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in own]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows)
    none = langid.op3_language(spark, H.tables(tmp_path / "odd", spark, documents=H.odd_docs(spark))).collect()
    und = Counter(r["doc_id"] for r in none if r["lang_pred"] == "und")
    assert und == Counter([1, 2, 3, None])     # null or without a letter
    empty = H.tables(tmp_path / "empty", spark, documents=H.empty_docs(spark))
    assert langid.op3_language(spark, empty).count() == 0


def test_language_needs_no_other_column(spark):
    content = {"aa": b"the and of", "bb": b"le la les"}
    docs = H.odd_docs(spark).drop("lang", "source")
    assert {"lang_pred", "score", "rejected"} < set(langid.identified(docs, content, docs.columns).columns)
    assert {r[0] for r in H.rows_of(langid.identified(docs, {}, ["doc_id"]), "lang_pred")} == {"und"}


# -- op4 and op10 --------------------------------------------------------------
def test_chunks_cover_the_text():
    rng = random.Random(1)
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(rng.randrange(256) for _ in range(n))
        x = quality.chunks(text)
        back = bytes(x[0][: min(n, 512)].astype("u1")) + b"".join(
            bytes(r[r < 256].astype("u1")[quality.CHUNK - quality.STRIDE:]) for r in x[1:])
        assert back == text


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = quality.Network(seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 256, (3, quality.CHUNK)).astype(np.int16), np.array([0.0, 1.0, 1.0])

    def loss():
        z = net.logits(x)
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))
    g = net.gradients(x, y)
    for k in net.p:
        flat, grad = net.p[k].reshape(-1), g[k].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - grad[i]) < 1e-4


def labelled(spark, toxic_word="grumblefoo"):
    rng = random.Random(31)
    docs, labels = [], []
    for i in range(300):
        w = H.words(rng, rng.randrange(20, 90)).split()
        good, bad = i % 4 != 0, i % 5 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = toxic_word + rng.choice(["s", "ing", ""])
        text = " ".join(w) if good else "!! ".join(w).upper()
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), int(bad)))
    labels += [(5, None, None), (None, 1, 1), (9999, 1, 0)]
    return (spark.createDataFrame(docs + [r for r in H.odd_rows() if r[0] is None or r[0] < 0], H.SCHEMA),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), dict((d, (q, t)) for d, q, t in labels[:300]))


@pytest.mark.parametrize("query, column", [(quality.op4_quality, 0), (toxicity.op10_toxicity, 1)])
def test_classifiers_on_held_out_rows(spark, tmp_path, query, column):
    docs, labels, truth = labelled(spark)
    sf = H.tables(tmp_path, spark, documents=docs, labels=labels)
    rows = query(spark, sf).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40
    assert np.mean([r["predicted"] == truth[r["doc_id"]][column] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


@pytest.mark.parametrize("query", [quality.op4_quality, toxicity.op10_toxicity])
def test_classifiers_without_labels_or_documents(spark, tmp_path, query):
    _, labels, _ = labelled(spark)
    sf = H.tables(tmp_path / "a", spark, documents=H.odd_docs(spark), labels=labels.limit(0))
    rows = query(spark, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in H.odd_rows())
    sf = H.tables(tmp_path / "b", spark, documents=H.empty_docs(spark), labels=labels)
    assert query(spark, sf).count() == 0


def test_listed_insults_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "a fine day"), (3, "idiotic is no listed word")],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = toxicity.filtered(docs, labels)
    assert H.rows_of(kept, "doc_id") == [(2,), (3,)]


def test_filtered_keeps_columns(spark):
    docs, labels, truth = labelled(spark)
    docs = docs.withColumn("toxicity", docs["lang"]).withColumn("score", docs["lang"])
    kept = toxicity.filtered(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert sum(d in ids for d, (_, t) in truth.items() if t) <= 2
    assert sum(d not in ids for d, (_, t) in truth.items() if not t) <= 2


def test_label_model_finds_accuracies_and_correlated_voters():
    rng = np.random.default_rng(5)
    y = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, np.where(y, 1, -1), np.where(y, -1, 1))
    good, fair, weak = vote(0.95), vote(0.8), vote(0.65)
    votes = np.column_stack([weak, weak, weak, weak, fair, good])
    model = toxicity.LabelModel(0.3)
    post = model.fit(votes, trusted=5)
    assert np.mean((post > 0.5) == y) > 0.93
    assert model.accuracy[5] > model.accuracy[4] > model.accuracy[0]
    assert model.weight[0] < 0.35 < 0.9 < model.weight[5]


# -- op5 ---------------------------------------------------------------------
COLUMNS5 = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def conversations(spark):
    rng = random.Random(41)
    marks = ["\\", "#", "<", "</turn>", "### assistant: ", "\n", ":", "\\h", "\\b", "é", "日", ""]
    rows = []
    for c in range(25):
        for t in range(rng.choice([1, 2, 3, 9, 40])):
            text = "".join(rng.choice(marks + ["word "]) for _ in range(rng.randrange(8)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "odd: <role>#\\c", None]),
                         rng.choice([text, text, None])))
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (4, None, "user", "x"), (None, 0, "assistant", "no id")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_conversations_equal_sql(spark, tmp_path):
    rows = conversations(spark)
    sf = H.tables(tmp_path, spark, conversations=rows)
    got = H.rows_of(chat.op5_chat(spark, sf), *COLUMNS5)
    assert got == duck_rows(chat.ORACLE, COLUMNS5, conversations=rows)


def test_empty_conversations_leave_the_probe(spark, tmp_path):
    rows = conversations(spark).limit(0)
    got = chat.op5_chat(spark, H.tables(tmp_path, spark, conversations=rows)).collect()
    assert [r["conv_id"] for r in got] == [chat.PROBE_ID]
    text = chat.PROBE_TEXT
    assert got[0]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


NODES = [  # tree, node, parent, role, text, score
    (1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0),
    (1, 4, 2, "user", "c", 9.0), (1, 5, 3, "user", "d", 1.0), (1, 6, 99, "user", "orphan", 0.5),
    (2, 1, None, "user", "x", None), (2, 1, None, "user", "x", None), (2, 2, 2, "user", "own parent", 1.0),
    (2, 3, 4, "user", "circle", 1.0), (2, 4, 3, "user", "circle", 1.0), (2, 5, 3, "user", "under", 1.0),
    (None, 1, None, "user", "no tree", 1.0), (None, 2, 1, "assistant", None, 1.0),
]


def test_branches_are_ranked_and_circles_left_out(spark):
    nodes = spark.createDataFrame(NODES, "tree_id bigint, node_id bigint, parent_id bigint, role string, "
                                         "text string, score double")
    rows = chat.chosen_paths(nodes).orderBy("tree_id", "rank", "depth").collect()
    got = {}
    for r in rows:
        got.setdefault((r["tree_id"], r["rank"]), []).append(r["text"])
    assert got == {(1, 1): ["hi", "a", "c"], (1, 2): ["hi", "b", "d"], (1, 3): ["orphan"],
                   (2, 1): ["x"], (None, 1): ["no tree", ""]}
    best = chat.formatted(chat.chosen_paths(nodes, top=1)).filter("tree_id = 1").collect()
    assert [r["formatted"] for r in best] == ["### user: hi</turn>\n### assistant: a</turn>\n### user: c</turn>\n"]


def test_loss_mask_points_into_the_conversation(spark):
    rows = chat.formatted(chat.chosen_paths(chat.linear_trees(conversations(spark)), top=1)).collect()
    assert any(r["loss"] for r in rows)
    for r in rows:
        lines = r["formatted"].split(chat.CLOSE)
        for m in r["loss"]:
            piece = r["formatted"][m["at"] : m["at"] + m["len"]]
            assert piece == lines[m["turn"]][m["start"] : m["start"] + m["len"]]
            assert "<" not in piece and "#" not in piece


def test_long_threads_take_few_rounds(spark):
    n = 300
    nodes = spark.range(n).selectExpr("cast(1 as bigint) tree_id", "id node_id", "nullif(id - 1, -1) parent_id",
                                      "'user' role", "cast(id as string) text", "1 score")
    rows = chat.chosen_paths(nodes).orderBy("depth").collect()
    assert [r["text"] for r in rows] == [str(i) for i in range(n)]


# -- all ---------------------------------------------------------------------
def test_one_query_for_each_operator():
    names = [q for q in queries.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_chat"])
def test_native_operators_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
