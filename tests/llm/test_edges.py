"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns through every operator and stage."""

import random

import pytest

from streamguard.llm import common, gridjoin, licences, maintext, minhash, mixing, packing, perplexity, substring, tokenfile, warc
from streamguard.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, _rank int, key string, row long, id long"


def rows():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    prose = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    texts = prose + [None, "", "  \t\n", prose[0], prose[1] + " tail", " ".join(words * 60), "one two", "ünï çödé ☃ " * 30]
    out = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], len(t or ""), i, i, "k", i, i) for i, t in enumerate(texts)]
    return [*out, out[3], out[3], (None, prose[2], None, None, None, None, None, None, None, None), (None, None, None, "a", 0, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    common.bounded_batches(spark)
    return common.cut(spark.createDataFrame(rows(), SCHEMA))


@pytest.fixture(scope="module")
def empty(spark):
    return common.cut(spark.createDataFrame([], SCHEMA))


OPERATORS = {
    "perplexity": lambda d: perplexity.quality(d),
    "mixing": lambda d: mixing.report(d),
    "substring": lambda d: substring.digests(d),
    "packing": lambda d: packing.pack(packing.pieces(d, tokenizer("byte_bpe_50k.json"))),
    "tokenfile": lambda d: tokenfile.round_trip(d, tokenizer("word_bpe_49k.json")),
    "minhash": lambda d: minhash.near_duplicates(d),
    "licences": lambda d: licences.scan(d.selectExpr("doc_id as key", "concat('x/', doc_id) as path", "text")),
    "warc": lambda d: warc.round_trip(d.selectExpr("doc_id as page_id", "lang as url", "text as html")),
    "maintext": lambda d: maintext.extract(d.selectExpr("doc_id as page_id", "lang as url", "text as html", "size", "key")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_on_odd_rows(docs, empty, name):
    whole, none = OPERATORS[name](docs).collect(), OPERATORS[name](empty).collect()
    assert none == []
    assert len(whole) >= docs.count() if name == "packing" else len(whole) == docs.count()


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [2.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [0.0, 1.0]), (None, [1.0, 0.0]), (12, [1.0, 0.4843]), (13, [1.0, -0.4844])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in gridjoin.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>")).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False) and got[12] == (3, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 13)) and got[None] == (0, None, True)
    assert gridjoin.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_stages(spark, docs, empty):
    import corpus_pipeline
    for start in (docs, empty):
        now = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before, now = now, common.cut(stage(spark, now, ""), name)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert now.columns == start.columns, name
            if start is empty:
                assert now.count() == 0
            elif name == "near_dedup":
                texts = [" ".join((r[0] or "").split()) for r in now.select("text").collect()]
                assert all(texts.count(t) == 1 for t in texts if t)
                gone = {" ".join((r[0] or "").split()) for r in before.select("text").collect()} - set(texts)
                assert all(t.endswith(" tail") for t in gone)  # a near copy of a text that stays


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (2, b), (2, b), (None, c), (None, a), (5, c + " more"), (6, None), (7, None)]
    data = [(i, t, "en", "s", 0, "x", "y", i) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, kept_text string, component_id long"
    got = corpus_pipeline.near_dedup(spark, common.cut(spark.createDataFrame(data, schema)), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "kept_text", "component_id"]
    assert sorted((str(r.doc_id), r.text or "", r._row, r.kept_text) for r in got.collect()) == sorted((i, t, "x", "y") for i, t in (("1", a), ("1", b), ("5", c + " more"), ("6", ""), ("7", "")))


@pytest.mark.parametrize("stage", ["quality", "substring", "mixing"])
def test_stages_give_further_columns_back(spark, stage):
    import corpus_pipeline
    words = " ".join(f"w{i}" for i in range(60))
    names = ["_row", "_id", "_key", "_copies", "_copy", "_tag", "_lost", "kept_text", "size"]
    data = [(i, f"{words} {i}", "en", "s", 0, *[f"{n}{i}" for n in names]) for i in range(6)]
    docs = common.cut(spark.createDataFrame(data, ["doc_id", "text", "lang", "source", "n_chars", *names]))
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert got.columns == docs.columns and got.count() > 0
    assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in names)
