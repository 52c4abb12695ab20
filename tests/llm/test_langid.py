import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import langid
from campaignlens.llm.common import crc_bucket
from campaignlens.llm.queries import op1_language_id
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents

EN = "the cat sat on the mat and the dog ran with the other dogs in the park"
DE = "der hund und die katze sind nicht in dem haus und schlafen auf der matte"


def rows():
    return [(i, (EN if i % 2 else DE) + f" {'xyz' * (i % 3)}", "en" if i % 2 else "de", "s") for i in range(30)]


def test_bundle_is_the_sum_of_bound_trigram_vectors():
    text = "Ab, ab c\n"
    grams, counts = langid.trigrams(text)
    seen = {tuple(g): c for g, c in zip(grams.tolist(), counts.tolist())}
    a, b, c = (ord(x) for x in "abc")
    assert seen == {(0, a, b): 2, (a, b, 0): 2, (0, c, 0): 1}
    total = np.zeros(64)
    for (x, y, z), n in seen.items():
        v = langid.letter_vectors(np.array([x, y, z]), 64).astype(int)
        total += n * np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    assert np.array_equal(langid.bundle(text, 64), total)


def test_long_text_is_bound_in_blocks(monkeypatch):
    text = " ".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 7 % 26) for i in range(900))
    whole = langid.bundle(text, 64)
    monkeypatch.setattr(langid, "_BLOCK", 17)
    assert np.array_equal(whole, langid.bundle(text, 64))


def test_languages_edge_cases_and_clashing_columns(spark):
    known = rows()
    extra = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34!", None, "s"), (103, "die katze und der hund", None, "s"), (104, EN * 4000, None, "s"), (105, EN, None, "s"), (105, EN, None, "s")]
    docs = documents(spark, known + extra).withColumn("score", F.lit("mine")).withColumn("a b.c", F.lit(1))
    prototypes = langid.learn(docs, F.lit(True))
    assert prototypes.languages == ["de", "en"]
    out = langid.identify(docs, prototypes)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "a b.c", "lang_pred", "score", "cosine"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in known)
    for i in (100, 101, 102):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["cosine"]) == (langid.UNKNOWN, 0.0, 0.0)
    assert got[103]["lang_pred"] == "de" and got[104]["lang_pred"] == got[105]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values()) and out.count() == len(known) + len(extra)


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = documents(spark, [(1, "some text", None, "s")])
    prototypes = langid.learn(docs, F.lit(True))
    assert prototypes.languages == []
    assert langid.identify(docs, prototypes).first()["lang_pred"] == langid.UNKNOWN
    assert langid.identify(docs.where("doc_id = 9"), prototypes).count() == 0


def test_sample_bound_and_held_out_rows(spark):
    docs = documents(spark, rows())
    some = langid.learn(docs, F.lit(True), train_rows=10)
    assert set(some.languages) <= {"de", "en"}
    only = langid.learn(docs, F.col("lang") == "de")
    assert only.languages == ["de"]


def test_held_out_accuracy(spark):
    out = op1_language_id(spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id")
    held = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.95


@pytest.mark.parametrize(("ident", "bucket"), [(0, 0xF4DBDF21 % 5), (None, 0)])
def test_crc_bucket(spark, ident, bucket):
    df = spark.createDataFrame([(ident,)], "i long")
    assert df.select(crc_bucket(F.col("i"), 5)).first()[0] == bucket
