import random
from collections import Counter

import pytest

import corpus_pipeline
from campaignlens.llm import langid, nbest
from campaignlens.llm.common import store
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, documents, prose, removed_lines, words
from tests.llm.test_mixing import levels


@pytest.fixture(scope="module")
def steps(spark):
    """Every stage's input and output over a small corpus with copies, shared lines and odd rows."""
    rnd = random.Random(12)
    line = prose(rnd, 15, 10**6)
    rows = [(i, "\n".join([line, prose(rnd, 30, 10**4), prose(rnd, 30, 10**4)]), "en", f"s{i % 4}") for i in range(40)]
    rows += [(100, rows[3][1] + " more", "en", "s1"), (101, None, "en", "s0"), (102, "123 456", None, "s0"), (103, "", "en", None), (3, rows[3][1], "en", "s3")]
    docs = documents(spark, rows)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF_SMALL)))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stage_columns(steps):
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {"doc_id", "ids", "alternatives"} <= set(steps[-1].columns)


def test_language_stage_drops_texts_without_letters_only(steps):
    gone = Counter(rows_of(steps[0])) - Counter(rows_of(steps[1]))
    assert sorted(r[0] for r in gone) == [101, 102, 103] and langid.MIN_COSINE > 0


def test_line_stage(steps):
    before = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    want = removed_lines(list(before.items()))
    for r in steps[2].collect():
        lines = before[r["doc_id"]].split("\n")
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in want[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
    assert steps[2].count() == steps[1].count() and any(want.values())


def test_near_duplicate_stage(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    group = components(texts)
    kept = [r["doc_id"] for r in steps[3].collect()]
    assert Counter(kept)[3] == 1
    assert set(kept) == {i for i in texts if group[i] == i or not words(texts[i])}


def test_mixing_stage(steps):
    before = steps[3].collect()
    sizes: dict = {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    want = levels(sizes)
    taken: Counter = Counter()
    copies: Counter = Counter()
    for r in steps[4].collect():
        taken[r["source"]] += len(words(r["text"]))
        copies[r["doc_id"]] += 1
    longest = max(len(words(r["text"])) for r in before)
    assert all(abs(taken[s] - want[s]) <= 2 * longest for s in sizes) and max(copies.values()) <= 2


def test_last_stage_decodes_to_its_input(spark, steps):
    v = nbest.Vocabulary(nbest.model_bytes(spark))
    got = sorted((r["doc_id"], nbest.decode_ids(v, r["ids"])) for r in steps[-1].collect())
    assert got == sorted((r["doc_id"], r["text"]) for r in steps[4].collect())


def test_empty_documents(spark):
    docs = documents(spark, [(1, "x")]).where("doc_id = 2")
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF_SMALL))
    assert docs.count() == 0
