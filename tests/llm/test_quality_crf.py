import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from campaignlens.llm import quality_crf, textops
from tests.llm.helpers import documents, prose


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    sizes = [3, 0, 5, 1, 2]
    at = np.concatenate([[0], np.cumsum(sizes)])
    potential, table = rng.normal(size=at[-1]), rng.normal(size=(2, 2))
    p, pairs = quality_crf.marginals(potential, at, table)
    want, want_pairs = np.zeros(at[-1]), np.zeros((2, 2))
    for k, n in enumerate(sizes):
        s = potential[at[k] : at[k + 1]]
        total, mine, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            score = np.exp(sum(s[i] * y[i] for i in range(n)) + sum(table[a, b] for a, b in zip(y, y[1:])))
            total += score
            mine += score * np.array(y, float)
            for a, b in zip(y, y[1:]):
                both[a, b] += score
        if n:
            want[at[k] : at[k + 1]] = mine / total
            want_pairs += both / total
    assert p == pytest.approx(want) and pairs == pytest.approx(want_pairs)


def test_line_features_and_neighbours():
    raw, offsets = textops.text_buffers(pa.array(["Good line here.\n\nAA!! BB!!\nAA!! BB!!", None, "x x x"]))
    lines = quality_crf.line_features(raw, offsets)
    assert np.diff(lines.at).tolist() == [3, 0, 1]
    names = quality_crf.FEATURES
    same, stutter, bang = (lines.x[:, names.index(n)] for n in ("same_as_before", "stutter", "bang"))
    assert same.tolist() == [0, 0, 1, 0] and stutter[3] == pytest.approx(2 / 3) and bang[1] == 2
    x = quality_crf.with_neighbours(lines)
    k = len(names)
    assert np.array_equal(x[1, k : 2 * k], lines.x[0]) and np.array_equal(x[1, 2 * k : 3 * k], lines.x[2])
    assert not x[0, k : 2 * k].any() and not x[3, k : 3 * k].any()


def corpus(n=160):
    rnd = random.Random(8)
    rows, marks = [], []
    for i in range(n):
        good = i % 3 != 0
        lines = [prose(rnd, 9).capitalize() + "." for _ in range(rnd.randint(1, 6))]
        if not good:
            junk = [prose(rnd, 9).upper().replace(" ", "!! ") + "!!" for _ in range(5)]
            lines = lines[:1] + junk
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(good)))
    return rows, marks


def test_held_out_documents_and_line_counts(spark):
    rows, marks = corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    field = quality_crf.learn(docs, labels.where("doc_id < 110"))
    out = {r["doc_id"]: r for r in quality_crf.score(docs, field).collect()}
    assert all(out[i]["predicted"] == y for i, y in marks[110:])
    assert all(out[i]["n_bad_lines"] == 5 and out[i]["n_lines"] == 6 for i, y in marks[110:] if not y)


def test_edge_cases(spark):
    rows, marks = corpus(40)
    docs = documents(spark, rows + [(100, None), (101, ""), (102, "\n" * 1000), (103, "word \n" * 30000), (103, "one"), (None, "one")])
    field = quality_crf.learn(docs, spark.createDataFrame(marks + [(100, None)], "doc_id long, quality int"))
    out = quality_crf.score(docs, field).collect()
    assert len(out) == 46 and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[100]["score"] == by[101]["score"] == by[102]["score"] and by[100]["n_lines"] == 0
    unlearned = quality_crf.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality_crf.score(docs, unlearned).collect()} == {0.5}
    assert quality_crf.score(docs.where("doc_id = 999"), field).count() == 0


def test_long_documents_take_part_with_a_run_of_lines(spark, monkeypatch):
    rnd = random.Random(31)
    junk = "### $$$ click | here || 1234 5678"
    rows = [(i, "\n".join(junk if i % 2 else prose(rnd, 9) + "." for _ in range(20_000 if i < 2 else 5))) for i in range(12)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(12)], "doc_id long, quality int")
    seen = {}

    def fit(lines, label):
        seen["lines"], seen["sizes"] = len(lines.x), sorted(lines.at[1:] - lines.at[:-1])
        return quality_crf.neutral()

    monkeypatch.setattr(quality_crf, "fit", fit)
    quality_crf.learn(docs, labels)
    assert seen["sizes"][-2:] == [quality_crf.TRAIN_LINES] * 2 and seen["lines"] <= 12 * quality_crf.TRAIN_LINES
    monkeypatch.undo()
    field = quality_crf.learn(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in quality_crf.score(docs, field, keep_text=False).collect()}
    assert min(scored[i] for i in range(0, 12, 2)) > max(scored[i] for i in range(1, 12, 2))
