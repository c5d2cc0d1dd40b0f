"""Language ID, BPE, the n-gram Jaccard join and top-k search against plain versions, the library and held-out rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rawscan.llm import bpe, components, jaccard, language, topk

DOCS = "doc_id bigint, text string, lang string, n_shingles string"


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- language ---


def _speech(rng, syllables, words):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


KINDS = {"aa": ["th", "er", "on", "an", "ing"], "bb": ["sch", "ei", "ung", "zu", "ü"], "cc": ["ou", "é", "que", "la", "tre"]}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    data = [(i, _speech(rng, KINDS[k], rng.randint(3, 60)), k, None) for i in range(900) for k in [rng.choice(list(KINDS))]]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def model(labelled):
    return language.fit(labelled, language.Settings(sample_rows=400))


def test_held_out_accuracy(labelled, model):
    found = language.predict(labelled, model, keep=("lang",)).withColumn("held", language.fold() == 1).where("held").collect()
    assert len(found) > 200 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_fold_is_crc32_of_the_id(spark, labelled):
    import zlib

    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 3 for r in labelled.select("doc_id", language.fold().alias("f")).collect())


def test_predictions_do_not_depend_on_the_label(spark, labelled, model):
    blind = labelled.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert sorted(rows(language.predict(labelled, model))) == sorted(rows(language.predict(blind, model)))


def test_texts_without_letters_and_extremes(spark, model):
    long = _speech(random.Random(2), KINDS["bb"], 200_000)
    data = [(1, None, None, None), (2, "", None, None), (3, "123 !? \n", None, None), (4, long, None, None), (4, long, None, None), (None, "Sch ei ung", None, None), (6, "日本", None, None)]
    found = language.predict(spark.createDataFrame(data, DOCS), model).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in found if r.doc_id in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert [r.lang_pred for r in found if r.doc_id == 4 or r.doc_id is None] == ["bb"] * 3
    assert next(r.lang_pred for r in found if r.doc_id == 6) in KINDS


def test_rejection_is_calibrated(labelled, model):
    """Clean held-out rows stay; texts in no language go, with a threshold that the held-back rows and noise decide."""
    clean = language.predict(labelled, model).withColumn("held", language.fold() == 1).where("held").collect()
    assert sum(r.rejected for r in clean) <= 0.01 * len(clean) and 0.34 < model.threshold < 1
    rng = random.Random(6)
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz ") for _ in range(200)) for _ in range(100)] + ["日本語 テキスト " * 9, "Привет мир как дела " * 9]
    p = model.probabilities(noise).max(1)
    assert (p < model.threshold).mean() > 0.8


def test_every_language_is_learned(spark):
    rng = random.Random(4)
    data = [(i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{rng.choice('xyz')}" for _ in range(30)), f"l{k:03d}", None) for i in range(4500) for k in [i % 300]]
    found = language.fit(spark.createDataFrame(data, DOCS), language.Settings(sample_rows=250, epochs=1))
    assert len(found.languages) == 300 and found.table.shape[1] == 16 and found.linear.shape == (16, 300)


def test_where_a_long_text_is_cut_does_not_matter(model):
    text = _speech(random.Random(9), KINDS["aa"], 120_000)
    ids, n = language._bag(language._plain(text), model.settings)
    assert n.sum() > 3 * 250_000
    assert np.allclose(language._means(model.table, [text], model.settings), language._mean_of(model.table, [(ids, n)]), atol=1e-6)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], DOCS)
    assert language.fit(empty) is None and rows(language.predict(empty, None)) == []
    unlabelled = spark.createDataFrame([(1, "abc", None, None)], DOCS)
    assert rows(language.predict(unlabelled, language.fit(unlabelled))) == [(1, "und", 0.0, True)]


def test_pieces_do_not_change_what_short_texts_get(model):
    texts = ["", "a", "Sch ei", _speech(random.Random(3), KINDS["cc"], 500)]
    alone = np.vstack([model.probabilities([t]) for t in texts])
    assert np.allclose(alone, model.probabilities(texts))


# --- BPE ---


@pytest.fixture(scope="module")
def codec(vocabulary):
    return bpe.Codec(bpe.Vocabulary.load(vocabulary))


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


SAMPLES = [
    "", " ", "a", "Hello world", "I'm don't we'LL 12345 ²³ ½", "  \n\n  x  \t\r\n", "é" * 700, "日本語テキスト😀👩‍👩‍👧 " * 50, "x<|endoftext|>y <|endoftext|><|endoftext|>", "\x1c\x85\xa0a",
    "abc" * 4000, "a" * 20_001, "ßäöü" * 90 + " tail", "___--__!!??", "　wide space ", "Ａｂｃ１２", "ệ̃", "﻿bom", "aaab" * 33,
]


def test_encoding_and_decoding_equal_the_library(codec, library):
    found = codec.encode(SAMPLES)
    assert found == [e.ids for e in library.encode_batch(SAMPLES, add_special_tokens=False)]
    assert [codec.decode(x) for x in found] == [library.decode(x, skip_special_tokens=False) for x in found]


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text_equals_the_library(codec, library, texts):
    found = codec.encode(texts)
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [codec.decode(x) for x in found] == texts


@settings(max_examples=80, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(min_size=2, max_size=16), min_size=1, max_size=8))
def test_both_trees_merge_alike(codec, words):
    assert bpe.merge_together(codec.vocab, words, 16) == [bpe.merge_alone(codec.vocab, w) for w in words]


def test_bpe_rows(spark, vocabulary, library):
    data = [(i, t, "x", None) for i, t in enumerate([*SAMPLES, None])] + [(0, "again", None, None), (None, "x", None, None)]
    docs = spark.createDataFrame(data, DOCS)
    want = []
    for i, t, *_ in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(rows(bpe.digests(docs, vocabulary)), key=repr) == sorted(want, key=repr)
    assert {r.doc_id: (len(r.ids), r.decoded) for r in bpe.encoded(docs.where("doc_id > 0"), vocabulary).collect()} == {i: (n, t or "") for (i, n, *_), (_, t, *_) in zip(want, data, strict=True) if i}
    assert rows(bpe.digests(spark.createDataFrame([], DOCS), vocabulary)) == []


def test_forgetting_words_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.Codec(bpe.Vocabulary.load(vocabulary))
    texts = ["one two three four five", "six seven one two", "three six"]
    assert [small.encode([t])[0] for t in texts] == bpe.Codec(small.vocab).encode(texts)


# --- n-gram Jaccard ---


def jaccard_plain(data, percent=80, width=5):
    sets = {}
    for i, t, *_ in data:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(width, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(x for x in sets if x is not None)
    for a in ids:
        for b in ids:
            if a < b and sets[a]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    least[y] = x
    return {i: (len(s), None if i is None else root(i)) for i, s in sets.items()}


def _family(rng, size, words, edits, first):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for k in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            copy += [f"t{rng.randrange(10**6)}" for _ in range(rng.randint(1, max(1, words // 5)))]
        yield first + k, rng.choice([" ", "\n", "\t "]).join(copy)


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_components(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 10 if seed == 1 else 100_000)
    rng = random.Random(seed)
    data = []
    for size, words, edits in [(40, 120, 6), (25, 60, 4), (30, 20, 2), (30, 8, 1), (20, 300, 14)]:
        data += _family(rng, size, words, edits, len(data))
    passage = " ".join(f"p{k}" for k in range(60))
    for _ in range(40):
        data.append((len(data), passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60)))))
    for text in [None, "", " \n\t", "one", "One", "one two three four", "ONE TWO three FOUR", "é È", "É È", "x y", "x y z", "a b c d e", "a b c d e f"]:
        data += [(len(data), text), (len(data) + 1, text)]
    data += [(3, data[3][1]), (None, "one"), (len(data) + 9, "z " * 50_000)]
    docs = spark.createDataFrame([(i, t, None, "clash") for i, t in data], DOCS).repartition(5)
    want = jaccard_plain(data)
    found = rows(jaccard.jaccard_components(docs))
    assert len(found) == len(data)
    assert {i: (n, c) for i, n, c in found} == want
    assert len({c for _, c in want.values()}) < len(data) - 30


def test_jaccard_of_an_id_with_several_texts(spark):
    rng = random.Random(12)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    near = lambda t: t.rsplit(" ", 3)[0]
    data = [(5, one), (5, two), (7, near(one)), (9, near(two)), (11, three), (12, three), (12, "alone"), (13, near(three)), (14, "alone"), (15, "other"), (15, ""), (16, "")]
    found = rows(jaccard.jaccard_components(spark.createDataFrame([(i, t, None, None) for i, t in data], DOCS).repartition(3)))
    want = {5: 5, 7: 5, 9: 5, 11: 11, 12: 11, 13: 11, 14: 11, 15: 15, 16: 16}
    assert len(found) == len(data) and {(i, c) for i, _, c in found} == set(want.items())
    assert sorted(n for i, n, _ in found if i == 12) == [1, 76]


def test_jaccard_with_a_shingle_that_all_have(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD", 2000)
    rng = random.Random(2)
    common = "c1 c2 c3 c4 c5 c6"
    data = [(i, f"{common} " + " ".join(f"w{rng.randrange(10**5)}" for _ in range(rng.randint(1, 12)))) for i in range(600)]
    data += [(600 + i, data[i][1] + " end") for i in range(0, 600, 7)]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in data], DOCS).repartition(3)
    assert {i: (n, c) for i, n, c in rows(jaccard.jaccard_components(docs))} == jaccard_plain(data)


def test_members_of_a_group_that_its_leader_is_not_linked_with(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 4000)
    data = [(i, " ".join(f"w{k}" for k in range(i * 3, i * 3 + 100))) for i in range(90)]  # a chain: each is near the next ones alone
    docs = spark.createDataFrame([(i, t, None, None) for i, t in data], DOCS).repartition(3)
    assert {i: (n, c) for i, n, c in rows(jaccard.jaccard_components(docs))} == jaccard_plain(data)


def test_jaccard_of_an_empty_table(spark):
    assert rows(jaccard.jaccard_components(spark.createDataFrame([], DOCS))) == []


def test_no_set_that_is_linked_is_settled_early():
    for n in range(1, 400):
        for m in range(math.ceil(0.8 * n), n + 1):  # the smaller set
            common = math.ceil(0.8 * (n + m) / 1.8)
            if common > m or 100 * common < 80 * (n + m - common):
                continue
            shared = min(jaccard._lowest(n, 80) - (n - common), jaccard._lowest(m, 80) - (m - common))
            assert shared >= jaccard._needed(n, 80) and shared >= jaccard._needed(m, 80)


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, 500), (7, 6), (7, 6)]
    least = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert dict(rows(found)) == {x: c for x, c in least.items() if any(x in p and p[0] != p[1] for p in links)}
    assert found.count() == len(dict(rows(found)))


# --- top k ---


VECTORS = "vec_id bigint, embedding array<float>, score string"


def topk_plain(data, k, every):
    plain = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in plain:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in plain if i != q and len(y) == len(x))[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("group", [65_536, 64])
def test_top_k(spark, group, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", group)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "HEAD_ROWS", 20)
    rng = np.random.default_rng(9)
    data = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 30])).tolist(), "clash") for i in range(700)]
    data += [(700 + i, [0.5] * 8, None) for i in range(120)] + [(900 + i, [float(i % 3)] * 3, None) for i in range(30)]
    data += [(1000, None, None), (1050, [1.0, None] * 4, None), (1100, [float("nan")] * 8, None), (1150, [float("inf")] * 8, None), (1200, [], None), (1250, [], None), (None, [1.0] * 8, None), (1300, [1.0] * 5, None)]
    found = rows(topk.top_k(spark.createDataFrame(data, VECTORS).repartition(4), 5, 50))
    assert set(found) == topk_plain(data, 5, 50) and len(found) == len(set(found))


def test_top_k_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SERVED", 1)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=1536) * (1 + i % 5)).tolist(), None) for i in range(400)]
    found = rows(topk.top_k(spark.createDataFrame(data, VECTORS).repartition(3), 5, 10))
    v = np.floor(256 * np.array([x for _, x, _ in data], np.float32).astype(float))
    want = set()
    for q in range(0, 400, 10):
        scores = sorted((-int(s), i) for i, s in enumerate(v @ v[q]) if i != q)[:5]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    assert set(found) == want


def test_top_k_with_few_rows_and_repeated_rows(spark):
    data = [(0, [1.0, 2.0], None), (0, [1.0, 2.0], None), (1, [3.0, 1.0], None), (2, [3.0, 1.0], None)]
    assert sorted(rows(topk.top_k(spark.createDataFrame(data, VECTORS)))) == [(0, 1, 1, 327_680), (0, 2, 2, 327_680)]
    assert rows(topk.top_k(spark.createDataFrame([], VECTORS))) == []
    assert rows(topk.top_k(spark.createDataFrame([(1, [1.0], None)], VECTORS))) == []
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([(0, [1e30], None)], VECTORS))
