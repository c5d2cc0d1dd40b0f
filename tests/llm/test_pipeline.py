"""The pipeline's stages and their chain against plain versions, on a small table."""

import hashlib
import random
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rawscan.llm import line_dedup
from tests.llm.test_models import KINDS, _speech, jaccard_plain

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def made():
    rng = random.Random(8)
    banner = "accept all our cookies before you go on reading"
    data = []
    for i in range(240):
        kind = rng.choice(list(KINDS))
        lines = [_speech(rng, KINDS[kind], rng.randint(8, 30)) for _ in range(rng.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), banner)
        data.append([i, "\n".join(lines), kind if i % 7 else None, f"src{i % 24}"])
    for i in range(240, 300):  # near copies: a word or two changed
        words = data[i - 240][1].split(" ")
        if len(words) > 60:
            words[rng.randrange(len(words))] = "changed"
        data.append([i, " ".join(words), data[i - 240][2], f"src{rng.randrange(24)}"])
    data += [[300, None, None, None], [301, "", "aa", "src1"], [302, "123 !!", "aa", "src2"], [303, banner, "aa", "src3"], [304, "é " * 30_000, "cc", "src4"], [304, "é " * 30_000, "cc", "src4"]]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in data]


def test_stages(spark, made, vocabulary, tmp_path):
    docs, rows = spark.createDataFrame(made, DOCS), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        rows[name] = docs.collect()
    columns = [c.split(" ")[0] for c in DOCS.split(", ")]
    assert all(rows[n][0].asDict().keys() >= set(columns) for n, _ in corpus_pipeline.STAGES[:-1])

    kept = {r.doc_id for r in rows["language_id"]}
    assert kept == {i for i, *_ in made} - {300, 301, 302} and all(r.lang for r in rows["language_id"])
    assert all(r.lang == lang for r in rows["language_id"] for i, _, lang, *_ in made if i == r.doc_id and lang)

    sites, first = defaultdict(set), {}
    for r in rows["language_id"]:
        for p, line in enumerate(r.text.split("\n")):
            sites[line.strip(" ")].add(r.source)
            first[line.strip(" ")] = min(first.get(line.strip(" "), (r.doc_id, p)), (r.doc_id, p))
    want = {}
    for r in rows["language_id"]:
        lines = r.text.split("\n")
        own = [x for p, x in enumerate(lines) if not x.strip(" ") or len(sites[x.strip(" ")]) < line_dedup.MIN_SITES or first[x.strip(" ")] == (r.doc_id, p)]
        if own == lines or "".join(own).strip():
            want[r.doc_id] = "\n".join(own)
    assert {r.doc_id: r.text for r in rows["line_dedup"]} == want and 303 not in want
    assert all(r.n_chars == len(r.text) for r in rows["line_dedup"])

    groups = jaccard_plain([(r.doc_id, r.text) for r in rows["line_dedup"]])
    assert {r.doc_id for r in rows["ngram_jaccard"]} == {i for i, (_, c) in groups.items() if i == c}
    assert len(rows["ngram_jaccard"]) < len(rows["line_dedup"]) - 20

    assert sorted(r.doc_id for r in rows["mixing"]) == sorted(r.doc_id for r in rows["ngram_jaccard"])
    assert len({r.mix_position for r in rows["mixing"]}) == len(rows["mixing"])

    library = Tokenizer.from_file(vocabulary)
    texts = {r.doc_id: r.text for r in rows["mixing"]}
    assert len(rows["bpe"]) == len(rows["mixing"])
    for r in rows["bpe"]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_chains_the_stages(spark, made, tmp_path):
    spark.createDataFrame(made, DOCS).write.parquet(f"file://{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert {"doc_id", "lang", "source", "mix_position", "n_tokens"} <= set(found.columns) and 100 < found.count() < len(made)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_near_duplicates_keeps_rows_without_id_and_one_row_an_id(spark):
    rng = random.Random(3)
    text, other = (" ".join(str(rng.random()) for _ in range(60)) for _ in range(2))
    data = [(None, text, "aa", "s1", 1), (None, text, "aa", "s1", 1), (None, None, None, None, None), (1, text, "aa", "s2", 1), (1, text, "aa", "s2", 1), (2, text, "aa", "s2", 1), (3, other, "bb", "s3", 2), (3, other, "aa", "s3", 2)]
    found = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(data, DOCS), "").collect()
    want = [data[0], data[1], data[2], data[3], data[7]]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_columns_with_clashing_names_and_rows_without_id_pass_the_stages(spark, made, tmp_path):
    more = ["lang_pred", "score", "rejected", "n_lines", "n_removed", "_bad", "_of", "mix_notes", "mix_position", "mix_block", "rank", "id", "tok", "chunk", "_text", "Score_", "_mix_key"]
    data = [(*row, *[f"{c}{k}" for c in more]) for k, row in enumerate(made[:120] + made[300:])] + [(None, made[0][1], "aa", None, 5, *more), (None, made[0][1], "aa", None, 5, *more)]
    docs = spark.createDataFrame(data, DOCS + "".join(f", {c} string" for c in more))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        assert set(docs.columns) == set(DOCS.replace(",", "").split(" ")[::2]) | set(more)
        found = docs.collect()
        assert sum(r.doc_id is None for r in found) == 2
        own = {(r[0], r[5:]) for r in data}
        assert all((r.doc_id, tuple(str(r[c]) for c in more)) in own for r in found) or name == "mixing"
        assert {(r.doc_id, r.lang_pred, r._bad, r.mix_notes, r.Score_) for r in found} <= {(r[0], r[5], r[10], r[12], r[20]) for r in data}
