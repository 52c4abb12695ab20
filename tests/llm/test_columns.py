"""Extra columns of any name and type, conflicting labels, and what the pipeline keeps."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from campaignlens.llm import jaccard_groups, langid, mixing, quality_crf, toxicity, urlrules
from tests.llm.helpers import documents, prose, words

ODD = {
    "m": "map('k', doc_id)", "n": "array(map(1, 'x'))", "root": "1", "_row": "2", "_tie": "'t'", "size": "9", "a.b": "3",
    "_k0": "true", "best": "0",
}


def test_stages_keep_map_columns_and_clashing_names(spark):
    rnd = random.Random(3)
    rows = [(i, prose(rnd, 40, 10**5), "en", f"s{i % 3}") for i in range(20)]
    rows += [(50, rows[0][1], "en", "s0"), (0, rows[0][1], "en", "s0"), (60, None, "en", "s1")]
    docs = documents(spark, rows).withColumns({c: F.expr(x) for c, x in ODD.items()})
    kept = jaccard_groups.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(20), 60]
    assert all(r["m"] == {"k": r["doc_id"]} for r in kept.collect())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs).collect()))


def test_url_rules_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "https://a.example.net/en/x"), (2, None)], "page_id long, url string")
    clash = pages.selectExpr("*", "1 AS best", "2 AS _h", "3 AS _p", "4 AS token", "map(1, 2) AS r", "5 AS c0")
    got = urlrules.judge(clash)
    assert got.columns == [*clash.columns, "host", "path", "rule", "verdict"]
    plain = {r["page_id"]: r["verdict"] for r in urlrules.judge(pages).collect()}
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == plain
    assert all((r["best"], r["_h"], r["c0"]) == (1, 2, 5) for r in got.collect())


@pytest.mark.parametrize("learn, label", [(toxicity.learn, "toxic"), (quality_crf.learn, "quality")])
def test_conflicting_labels_count_as_the_largest(spark, learn, label):
    rnd = random.Random(5)
    bad = ["you are an idiot and stupid", "shut up you stupid fool", "idiot you make me sick"]
    rows = [(i, (rnd.choice(bad) + " " if i % 2 else "") + prose(rnd, 30)) for i in range(60)]
    docs = documents(spark, rows).select("doc_id", "text")
    one = spark.createDataFrame([(i, i % 2) for i in range(60)], f"doc_id long, {label} int")
    two = one.unionByName(spark.createDataFrame([(i, 0) for i in range(0, 60, 3)], f"doc_id long, {label} int"))
    module = toxicity if label == "toxic" else quality_crf
    scores = []
    for labels in (one, two, two.repartition(5)):
        found = module.score(docs, learn(docs, labels), keep_text=False).orderBy("doc_id").collect()
        scores.append([round(r["score"], 6) for r in found])
    assert scores[0] == scores[1] == scores[2]


TEXTS = {
    "en": "the house is on the hill and we are going there with all of our friends this summer because it is warm ",
    "de": "das haus steht auf dem berg und wir gehen im sommer mit allen unseren freunden dorthin weil es warm ist ",
}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, TEXTS[lang] * 3, lang) for i, lang in enumerate(["en", "de"] * 10)]
    rows += [
        (100, "A.", "en"), (101, "Avec.", "en"), (102, "A. / All rights reserved.", "en"),
        (200, "Быстрая коричневая лиса прыгает через ленивую собаку и потом идет домой спать " * 2, None),
        (201, "Nopea ruskea kettu hyppaa laiskan koiran yli ja menee sitten kotiin nukkumaan koska paiva oli pitka", None),
        (202, "1234 5678", "en"), (203, None, "en"), (204, "", "en"),
    ]
    docs = documents(spark, [(i, t, lang, "s") for i, t, lang in rows])
    return {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}


def test_short_texts_stay_and_unlearned_languages_go(judged):
    assert judged == {*range(20), 100, 101, 102}
    assert langid.JUDGED > 1


def test_language_stage_keeps_known_short_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r[0] for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()}
    lettered = {r["doc_id"] for r in docs.select("doc_id", "text").collect() if any(c.isalpha() for c in r["text"] or "")}
    assert kept == lettered


def test_mix_leaves_wordless_documents_out(spark):
    docs = documents(spark, [(1, "a b c", "en", "s"), (2, "", "en", "s"), (3, " \n\t", "en", "s"), (4, None, "en", "s")])
    assert {r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, "").collect()} == {1}


def test_planted_copies_go_inside_the_pipeline(spark):
    rnd = random.Random(9)
    base = TEXTS["en"] + prose(rnd, 80, 10**6)
    near = base.replace(" w", " v", 2)
    docs = documents(spark, [(1, base, "en", "s"), (2, base, "en", "s"), (3, near, "en", "s"), (4, TEXTS["en"] + prose(rnd, 80, 10**6), "en", "s")])
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 4] and all(words(r["text"]) for r in kept)
