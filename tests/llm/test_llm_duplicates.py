"""SimHash components (op7), repeated passages (op8), fingerprints (op1)."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import llm_helpers as H
from litreflow.llm import fingerprints, simhash, substring


# -- op7 ---------------------------------------------------------------------
def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """(doc_id, fp) rows -> least reachable doc_id by distance <= 3."""
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        known = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(known) if known else None
    return [least[find(i)] for i in range(len(pairs))]


def near_copies(rng, n):
    base = H.words(rng, 300)
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out


def test_simhash_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = H.odd_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(
        near_copies(rng, 25) + near_copies(rng, 10) + [H.words(rng, rng.randrange(1, 40)) for _ in range(40)])]
    docs = spark.createDataFrame(rows, H.SCHEMA)
    sf = H.tables(tmp_path, spark, documents=docs)
    pairs = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted(((d, f"{fp:016x}", c) for (d, fp), c in zip(pairs, brute_components(pairs))), key=repr)
    assert H.rows_of(simhash.op7_simhash(spark, sf), "doc_id", "fingerprint", "component_id") == want


def test_tiles_of_a_hot_block_value(spark, monkeypatch):
    """With tiny tiles every shared block value is dealt out as tile pairs."""
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 60:
        x = rng.choice(sorted(prints))
        for _ in range(rng.randrange(1, 5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    pairs = [(i, p) for i, p in enumerate(sorted(prints))]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in pairs]
    found = simhash.classes(spark.createDataFrame(signed, "doc_id bigint, fp bigint"))
    got = {r["fp"]: r["component_id"] for r in found.collect()}
    assert [got[p] for _, p in signed] == brute_components(pairs)


def test_forest_emits_no_more_than_members():
    prints = np.array([x ^ (1 << b) for x in (0, 1 << 40) for b in range(12)], dtype=np.int64)
    a, b = simhash.forest(prints, 3)
    assert len(a) < len(set(prints.tolist()))


def test_a_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "a bigint, b bigint")
    assert {r["root"] for r in simhash.connected(chain).collect()} == {0}


def test_deduplicated_keeps_one_row_and_all_columns(spark):
    docs = H.odd_docs(spark)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(6) == 0 and ids.count(5) == 1       # copies of 5
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids  # texts without words
    assert ids.count(8) == 2                              # two texts of one id
    assert simhash.deduplicated(H.empty_docs(spark)).count() == 0


# -- op8 ---------------------------------------------------------------------
def passage_docs():
    rng = random.Random(8)
    passage = H.words(rng, 70).split()
    rows = []
    for i in range(12):
        own = [H.words(rng, 60), H.words(rng, 90)]
        p = list(passage)
        if i % 3 == 1:
            p[20] = "edited"
            p.insert(45, "inserted")
        if i < 9:
            rows.append((i, f"{own[0]}. {' '.join(p).upper()}! {own[1]}", "en", "s", 1))
        else:
            rows.append((i, f"{own[0]} {own[1]}", "en", "s", 1))
    return rows


def test_passages_are_found_exactly_where_they_are(spark, tmp_path):
    rows = passage_docs()
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    found = substring.op8_substring(spark, sf).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 9))  # 0 keeps it, 9-11 are clean
    assert {r["source_id"] for r in found} <= set(range(9))
    for r in found:
        assert abs(r["passage_start"] - 60) <= 2 and abs(r["passage_words"] - 70) <= 5
        assert r["identity"] >= 0.8


def test_cut_leaves_the_first_and_clean_documents_alone(spark):
    rows = passage_docs()
    docs = spark.createDataFrame(rows, H.SCHEMA)
    left = {r["doc_id"]: r for r in substring.cut(docs).collect()}
    assert len(left) == len(rows)
    for doc, text, *_ in rows:
        if doc == 0 or doc >= 9:
            assert left[doc]["text"] == text and left[doc]["n_chars"] == 1
        else:
            assert len(left[doc]["text"].split()) <= 155
            assert left[doc]["n_chars"] == len(left[doc]["text"])


def test_cut_of_odd_documents(spark):
    docs = H.odd_docs(spark)
    kept = substring.cut(docs)
    assert kept.columns == docs.columns
    got = Counter(r["doc_id"] for r in kept.collect())
    want = Counter(r[0] for r in H.odd_rows())
    want[6] = 0  # wholly a passage of document 5
    assert +got == +want
    assert substring.cut(H.empty_docs(spark)).count() == 0


def test_chains_equal_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randrange(1, 9)
        pairs = sorted({(rng.randrange(0, 60), rng.randrange(0, 60)) for _ in range(n)})
        own, other = [p for p, _ in pairs], [q for _, q in pairs]
        best = 0.0
        for mask in range(1, 1 << len(pairs)):
            at = [i for i in range(len(pairs)) if mask >> i & 1]
            if all(own[a] < own[b] and other[a] < other[b] for a, b in zip(at, at[1:])):
                skipped = own[at[-1]] - own[at[0]] + other[at[-1]] - other[at[0]]
                best = max(best, substring.SEED_WORDS * len(at) - substring.GAP_COST * skipped)
        found = substring.chains(own, other)
        score = [substring.SEED_WORDS * len(c) - substring.GAP_COST * (
            own[c[-1]] - own[c[0]] + other[c[-1]] - other[c[0]]) for c in found]
        long = [c for c in found if own[c[-1]] - own[c[0]] + substring.SEED_WORDS >= substring.MIN_CHAIN]
        assert found == long
        assert not score or max(score) <= best + 1e-9


def test_matches_that_ascend_by_small_steps_are_one_chain():
    rng = random.Random(32)
    seen = set()
    for _ in range(300):
        own, other = ([], [])
        x = y = 0
        for _ in range(rng.randrange(1, 12)):
            x, y = x + rng.randrange(1, 40), y + rng.choice([rng.randrange(1, 40), -3 if rng.random() < 0.05 else 2])
            own.append(x)
            other.append(y)
        one = substring._one_chain(np.array(own, dtype=np.int32), np.array(other, dtype=np.int32))
        seen.add(one)
        if one:
            assert substring.chains(own, other) == [list(range(len(own)))]
    assert seen == {True, False}


def test_steps_are_packed_and_unpacked():
    rng = random.Random(33)
    for far in (3, 100, 1000, 10**6):
        x = [rng.randrange(-far, far) for _ in range(rng.randrange(1, 50))]
        assert substring._unpacked(substring._packed(x)).tolist() == x
        moved = substring._packed(x, 0)
        assert substring._unpacked(substring._head(moved[0], 7) + moved[9:]).tolist() == [v - x[0] + 7 for v in x]


def test_common_subsequence():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        assert substring._common(a, b) == row[-1]


def test_two_passages_around_a_gap_are_both_found(spark, tmp_path):
    rng = random.Random(21)
    rows, want = [], {}
    for k, (size, gap) in enumerate((s, g) for s in (60, 100, 200) for g in (20, 40, 60, 100, 150, 400)):
        p, q = (H.words(rng, size, 200_000) for _ in range(2))
        for doc in (2 * k, 2 * k + 1):
            text = " ".join([H.words(rng, 80, 200_000), p, H.words(rng, gap, 200_000), q, H.words(rng, 90, 200_000)])
            rows.append((doc, text, "en", "s", 1))
        want[2 * k + 1] = [(80, 80 + size), (80 + size + gap, 80 + 2 * size + gap)]
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    got = {}
    for r in substring.op8_substring(spark, sf).collect():
        got.setdefault(r["doc_id"], set()).add((r["passage_start"], r["passage_start"] + r["passage_words"]))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_a_passage_whose_pieces_occur_in_other_documents_before(spark, tmp_path):
    rng = random.Random(22)
    rows = []
    for k in range(8):  # 15-word pieces in two documents each, then the whole in two
        passage = H.words(rng, 75, 200_000).split()
        texts = [" ".join(passage[15 * i : 15 * i + 15]) for i in range(5) for _ in range(2)]
        texts += [" ".join(passage)] * 2
        rows += [(20 * k + i, f"{H.words(rng, 80, 200_000)} {t} {H.words(rng, 70, 200_000)}", "en", "s", 1)
                 for i, t in enumerate(texts)]
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    got = {(r["doc_id"], r["source_id"], r["passage_start"], r["passage_words"])
           for r in substring.op8_substring(spark, sf).collect()}
    assert got == {(20 * k + 11, 20 * k + 10, 80, 75) for k in range(8)}


def _seed_batches(rows, size):
    return iter([substring.pa.RecordBatch.from_arrays(
        [substring.pa.array(list(c)) for c in zip(*rows[a : a + size])], names=substring._SEED_NAMES)
        for a in range(0, len(rows), size)])


def test_neighbours_equal_a_search_and_do_not_depend_on_the_batches():
    rng = random.Random(23)
    for _ in range(30):
        rows = sorted({(rng.randrange(5), rng.randrange(6), 0, rng.randrange(9), rng.randrange(2), i)
                       for i in range(rng.randrange(1, 120))})
        leads, want = [], set()
        for seed, ahead, _, doc, key, at in rows:
            run = [r for r in rows if r[:2] == (seed, ahead)]
            lead = [r for r in run if r[3:5] == run[0][3:5]]
            if (doc, key) == run[0][3:5]:
                leads.append((seed, ahead, 0, doc, key, at))
                continue
            place = [r[5] for r in run if r[3:5] == (doc, key)].index(at)
            want.add((doc, key, *run[0][3:5], at, lead[place % len(lead)][5]))
        for i, (seed, _, _, doc, key, at) in enumerate(leads):
            earlier = [j for j, r in enumerate(leads) if r[0] == seed and r[3:5] < (doc, key)]
            for j in (max((j for j in earlier if j < i), default=None), min((j for j in earlier if j > i), default=None)):
                if j is not None:
                    want.add((doc, key, *leads[j][3:5], at, leads[j][5]))
        for size in (1, 2, 7, 500):
            got = [tuple(r.values())[:6] for b in substring._neighbours(_seed_batches(rows, size)) for r in b.to_pylist()]
            assert len(got) == len(set(got)) and set(got) == want


def test_words_on_both_sides_rule_out_only_what_cannot_be_a_stretch():
    rng = random.Random(28)
    for _ in range(2000):
        a = np.array([rng.randrange(1 << 64) for _ in range(60)], dtype=np.uint64)
        b = a.copy()
        for i in range(60):
            if rng.random() < rng.choice([0.05, 0.3, 0.9]):
                b[i] = rng.randrange(1 << 64)
        at = rng.randrange(0, 55)
        b[at : at + substring.SEED_WORDS] = a[at : at + substring.SEED_WORDS]
        one, two = (substring.sides(x, np.array([at])) for x in (a, b))
        left, _ = substring._extend(a[:at][::-1], b[:at][::-1])
        right, _ = substring._extend(a[at + substring.SEED_WORDS:], b[at + substring.SEED_WORDS:])
        if left + right + substring.SEED_WORDS >= substring.MIN_STRETCH:
            far = substring.reach(one[0] ^ two[0], one[1] ^ two[1]).astype(int)
            assert substring.may_extend(substring.SEED_WORDS, far, far)[0]


def _passages(spark, rows):
    return {(r["doc_id"], r["source_id"], r["passage_start"], r["passage_words"])
            for r in _stretch_rows(spark, rows)}


def _stretch_rows(spark, rows):
    found = substring.passages(spark.createDataFrame(rows, H.SCHEMA).repartition(3))
    from pyspark.sql import functions as F
    return (found.select("doc", F.explode("runs").alias("r")).select("doc", "r", F.explode("r.parts").alias("p"))
            .select(F.col("doc").alias("doc_id"), F.col("p.source").alias("source_id"),
                    F.col("r.word_lo").alias("passage_start"),
                    (F.col("r.word_hi") - F.col("r.word_lo")).alias("passage_words")).collect())


@pytest.mark.parametrize("layers", [1, 3])
def test_a_passage_is_found_whatever_holds_overlapping_pieces_of_it(spark, layers):
    """Twelve earlier documents a layer hold overlapping 19-word pieces of 90
    words that two documents share: the two are found, with or without other
    documents beside them."""
    rng = random.Random(29)
    word = lambda n: H.words(rng, n, 200_000)
    passage = word(90).split()
    rows = []
    for layer in range(layers):
        for k in range(12):
            at = min(71, 6 * k + layer)
            rows.append((100 * layer + k, f"{word(60)} {' '.join(passage[at : at + 19])} {word(60)}", "en", "s", 1))
    rows += [(d, f"{word(80)} {' '.join(passage)} {word(70)}", "en", "s", 1) for d in (1000, 1001)]
    alone = _passages(spark, rows)
    assert {(d, start, size) for d, _, start, size in alone} == {(1001, 80, 90)}
    assert 1000 in {source for _, source, _, _ in alone}
    other = word(70)
    more = [(d, f"{word(50)} {other} {word(50)}", "en", "s", 1) for d in (2000, 2001)]
    more += [(3000 + i, word(150), "en", "s", 1) for i in range(20)]
    beside = _passages(spark, rows + more)
    assert {x for x in beside if x[0] < 2000} == alone
    assert {(d, start, size) for d, _, start, size in beside if d >= 2000} == {(2001, 50, 70)}


def test_whole_query_against_the_alignment_of_all_pairs(spark):
    """Every later document that shares a passage with an earlier one, by a
    search for runs of words in all pairs, and no other."""
    rng = random.Random(30)
    texts = [H.words(rng, rng.randrange(60, 160), 200_000).split() for _ in range(60)]
    for _ in range(60):  # pieces of 20 to 90 words copied about, some edited
        source, size = rng.choice(texts), rng.randrange(20, 90)
        at = rng.randrange(max(1, len(source) - size))
        piece = [w if rng.random() < rng.choice([1, 1, 0.95]) else f"x{rng.random()}"[:9] for w in source[at : at + size]]
        target = rng.choice(texts)
        cut = rng.randrange(len(target))
        target[cut:cut] = piece

    def longest_common(a, b):
        best, before = 0, [0] * (len(b) + 1)
        for x in a:
            now = [0] * (len(b) + 1)
            for j, y in enumerate(b):
                if x == y:
                    now[j + 1] = before[j] + 1
                    best = max(best, now[j + 1])
            before = now
        return best

    exact = {i for i in range(60) for j in range(i) if longest_common(texts[i], texts[j]) >= substring.MIN_WORDS + 8}
    words = [set(zip(*[t[k:] for k in range(5)])) for t in texts]
    related = {i for i in range(60) for j in range(i) if words[i] & words[j]}
    got = {x[0] for x in _passages(spark, [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)])}
    assert exact <= got <= related and exact


def test_a_line_of_a_third_of_the_documents_is_not_sent_for_each(spark):
    rng = random.Random(31)
    line = H.words(rng, 60, 200_000)
    docs = spark.createDataFrame([(i, f"{H.words(rng, 20, 200_000)} {line if i % 3 == 0 else ''} {H.words(rng, 20, 200_000)}",
                                   "en", "s", 1) for i in range(900)], H.SCHEMA).repartition(2)
    rows = docs.selectExpr("doc_id AS doc", "0L AS text_key", "text")
    sent = rows.mapInArrow(substring._seeds, substring._SEED).filter("at >= 0").groupBy("seed").count()
    # the line's inner seeds are sent once a slice; those at its end go on differently
    assert sent.filter("count > 50").count() <= 16
    assert {x[0] for x in _passages(spark, docs.collect())} == set(range(3, 900, 3))


def test_seeds_and_words_of_many_texts_are_found_at_once(monkeypatch):
    """The same as of each text by itself, and not with work for each text."""
    rng = random.Random(35)
    texts = [H.words(rng, rng.choice([0, 1, 4, 5, 6, 12, 13, 40, 200]), 50).encode() for _ in range(300)]
    texts += [b"", b"\n\n", b"a" * 5000 + b" b c d e f", "Ä é \u4e2d. x y z, a B".encode(), texts[7], texts[8]]
    batch = substring.pa.RecordBatch.from_arrays(
        [substring.pa.array(x) for x in ([i // 2 for i in range(len(texts))], [i % 2 for i in range(len(texts))],
                                         [t.decode() for t in texts])], names=["doc", "text_key", "text"])
    calls = []
    one_by_one = substring.word_hashes
    monkeypatch.setattr(substring, "word_hashes", lambda *x: calls.append(x) or one_by_one(*x))

    def found():
        words = [(n, short, *(f(0, n) if n else b"" for f in fs)) for n, short, *fs in substring._words(texts)]
        return [b.to_pylist() for b in substring._seeds(iter([batch]))], words

    seeds, words = found()
    assert len(calls) < len(texts) / 10
    monkeypatch.setattr(substring, "GROUP_BYTES", 1)
    assert (seeds, words) == found() and sum(map(len, seeds))
    for text, (n, short, *_) in zip(texts, words):
        hashes = one_by_one(text.lower(), substring.WORD_BYTES)[0]
        assert n == len(hashes) and short == (hashes >> np.uint64(33)).astype("<i4").tobytes()
    # the definition: a quarter of the grams, and the least of each window or of a short text
    for text in texts:
        grams = substring.gram_hashes(one_by_one(text.lower(), substring.WORD_BYTES)[0], substring.SEED_WORDS).tolist()
        want = {i for i, g in enumerate(grams) if g < (1 << 64) // substring.SEED_SHARE}
        for i in range(max(1, len(grams) - substring.SEED_WINDOW + 1) if grams else 0):
            window = grams[i : i + substring.SEED_WINDOW]
            if not any(i + j in want and g < (1 << 64) // substring.SEED_SHARE for j, g in enumerate(window)):
                want.add(i + window.index(min(window)))
        seed, _, _, at, _ = next(substring._found([text]))
        assert at.tolist() == sorted(want) and seed.view(np.uint64).tolist() == [grams[i] for i in sorted(want)]


def test_edited_passages_are_found(spark, tmp_path):
    """Every s-th word replaced: identity 83 to 92 %."""
    rng = random.Random(24)
    rows = []
    for k in range(60):
        words = H.words(rng, 100, 200_000).split()
        edited = [f"edit{rng.random()}"[:4] + str(rng.random())[2:] if i % (6, 8, 12)[k % 3] == 5 else w
                  for i, w in enumerate(words)]
        rows += [(2 * k + i, f"{H.words(rng, 80, 200_000)} {' '.join(w)} {H.words(rng, 70, 200_000)}", "en", "s", 1)
                 for i, w in enumerate((words, edited))]
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    got = {(r["doc_id"], r["source_id"]) for r in substring.op8_substring(spark, sf).collect()}
    assert got <= {(2 * k + 1, 2 * k) for k in range(60)} and len(got) >= 57


def test_passages_with_words_put_in_and_left_out_are_found(spark):
    """A word more or less every 9 words: no seed's own diagonal is a stretch."""
    rng = random.Random(34)
    rows = []
    for k in range(40):
        words = H.words(rng, 100, 200_000).split()
        edited = []
        for i, w in enumerate(words):
            if i % 10 == 9:
                edited += [w, f"more{rng.randrange(10**9)}"] if k % 2 else []
            else:
                edited.append(w)
        rows += [(2 * k + i, f"{H.words(rng, 80, 200_000)} {' '.join(w)} {H.words(rng, 70, 200_000)}", "en", "s", 1)
                 for i, w in enumerate((words, edited))]
    got = {x[:2] for x in _passages(spark, rows)}
    assert got <= {(2 * k + 1, 2 * k) for k in range(40)} and len(got) >= 36


def test_passages_of_a_repeated_line_are_found(spark, tmp_path):
    rng = random.Random(25)
    rows, want = [], {}
    for k, (line, size) in enumerate((x, n) for x in (2, 4, 8, 12, 16, 18) for n in (60, 96, 400)):
        passage = " ".join([H.words(rng, line, 200_000)] * -(-size // line))
        rows += [(3 * k + i, f"{H.words(rng, 80, 200_000)} {passage} {H.words(rng, 70, 200_000)}", "en", "s", 1)
                 for i in range(3)]
        want |= {3 * k + i: (80, -(-size // line) * line) for i in (1, 2)}
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA))
    found = substring.op8_substring(spark, sf).collect()
    assert {(r["doc_id"], r["passage_start"], r["passage_words"]) for r in found} == {
        (doc, *x) for doc, x in want.items()}


def test_texts_of_one_id_and_of_null_ids_are_compared(spark):
    rng = random.Random(26)
    rows = []
    for ids in ([None] * 4, [7] * 4):
        passage = H.words(rng, 70, 200_000)
        rows += [(i, f"{H.words(rng, 80, 200_000)} {passage} {H.words(rng, 70, 200_000)}", "en", "s", 1) for i in ids]
    rows += [rows[0]] * 2  # rows with the same id and text are one document
    left = substring.cut(spark.createDataFrame(rows, H.SCHEMA)).collect()
    assert len(left) == len(rows)
    for doc in (None, 7):
        sizes = {r["text"]: len(r["text"].split()) for r in left if r["doc_id"] == doc}
        assert sorted(sizes.values()) == [150, 150, 150, 220]


def test_a_seed_counts_only_where_its_words_match():
    rng = random.Random(27)
    a, b = (substring.word_hashes(H.words(rng, 40, 200_000).encode(), substring.WORD_BYTES)[0] for _ in range(2))
    assert substring.aligned(a, b, [0, 5, 10, 15, 20], [0, 5, 10, 15, 20]) == []
    assert substring.aligned(a, a, [5, 20], [5, 20]) == [(0, 40, 1.0)]


# -- op1 ---------------------------------------------------------------------
def true_likeness(a, b):
    wa, wb = Counter(fingerprints.terms(a.encode()).tolist()), Counter(fingerprints.terms(b.encode()).tolist())
    keys = wa.keys() | wb.keys()
    return sum(min(wa[k], wb[k]) for k in keys) / max(1, sum(max(wa[k], wb[k]) for k in keys))


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = random.Random(13)
    errors = []
    for _ in range(60):
        base = H.words(rng, 120, 30).split()   # few words: weights over one
        other = base[: rng.randrange(10, 120)] + H.words(rng, 60, 30).split() + base[:20]
        a, b = " ".join(base * rng.randrange(1, 4)), " ".join(other)
        x, y = fingerprints.signature(a.encode()), fingerprints.signature(b.encode())
        errors.append(fingerprints.likeness(x, y) - true_likeness(a, b))
        both = fingerprints.two_signatures(a.encode(), b.encode())
        assert (both[0] == x).all() and (both[1] == y).all()
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.08               # 64 samples: at most 0.0625


def test_edited_texts_equal_brute_force(spark, tmp_path):
    rng = random.Random(17)
    rows = [(rng.randrange(10**9), H.words(rng, rng.randrange(60)), "en", "s", 0) for _ in range(300)]
    rows += [(5, None, None, None, None), (6, "", None, None, None), (7, "é" * 1000, None, None, None)]
    sf = H.tables(tmp_path, spark, documents=spark.createDataFrame(rows, H.SCHEMA).repartition(5))
    got = {r["doc_id"]: r for r in fingerprints.op1_fingerprints(spark, sf).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for i, (doc, text, *_) in enumerate(ordered):
        text, nxt = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + nxt[:third]
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        sig = fingerprints.signature
        assert r["fingerprint"] == fingerprints._hex(sig(text.encode()))
        assert r["edited_fingerprint"] == fingerprints._hex(sig(new.encode()))
        assert r["near_next"] == fingerprints.likeness(sig(text.encode()), sig(nxt.encode()))


def test_fingerprints_of_odd_documents(spark, tmp_path):
    sf = H.tables(tmp_path, spark, documents=H.odd_docs(spark))
    rows = fingerprints.op1_fingerprints(spark, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in H.odd_rows())
    by = {}
    for r in rows:
        by.setdefault(r["n_chars"], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for n, x in by.items() if n > 100)
    assert by[0] == {"0" * 256}
    sf = H.tables(tmp_path / "empty", spark, documents=H.empty_docs(spark))
    assert fingerprints.op1_fingerprints(spark, sf).count() == 0
    assert "fingerprint" in fingerprints.fingerprinted(H.odd_docs(spark)).columns
