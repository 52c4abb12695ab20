"""The audit of filter orders against a replay of every order, document by document."""

import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import types as T

from campaignlens.llm import filter_audit
from tests.llm.helpers import documents, prose, words

LABELS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())
])


def failures(doc_id, text, everything):
    text = text or ""
    w = words(text)
    out = set()
    if len(w) < 50:
        out.add("A")
    if 100 * len(set(w)) < 65 * len(w):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
        out.add("C")
    if set(text) & set("#$%&*|"):
        out.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t in everything):
        out.add("E")
    return out


def replay(rows, labels):
    """``(part, order, step) -> counts`` by applying every order to every document."""
    everything = [(i, t) for i, t, *_ in rows]
    judged = []
    for i, text, _, source in rows:
        own = [(q, t) for d, q, t in labels if d is not None and d == i]
        judged.append((source or "", failures(i, text, everything), any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out = {}
    for part in {p for p, *_ in judged}:
        here = [j for j in judged if j[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(here)
            for step, f in enumerate(order, 1):
                removed = [j for j in left if f in j[1]]
                gone = [j for j in here if not any(j is x for x in left)]
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = {
                    "kept": len(left), "removed": len(removed), "redundant": sum(f in j[1] for j in gone),
                    "unique_fails": sum(j[1] == {f} for j in here),
                    "good_lost": sum(j[2] for j in removed), "toxic_lost": sum(j[3] for j in removed),
                }
        for (p, order, step), c in out.items():
            if p == part:
                c["shapley"] = shapley[order[step - 1]]
    return out


def audited(spark, rows, labels, docs=None):
    docs = documents(spark, rows) if docs is None else docs
    found = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    keys = [(r.part, r.filter_order, r.step) for r in found]
    assert len(keys) == len(set(keys))
    return {k: {c: r[c] for c in filter_audit.COUNTS} for k, r in zip(keys, found, strict=True)}


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(7)
    rows = []
    for i in range(60):
        text = prose(rnd, rnd.choice([10, 60, 80]), rnd.choice([20, 4000]))
        text += rnd.choice(["", "", " 50% off", " #1", " SHOUTING LOUDLY AT EVERYONE HERE"])
        rows.append((i, text, "en", rnd.choice(["x", "y", None, ""])))
    rows += [(100 + k, rows[3][1], "en", "x") for k in range(9)]  # copies
    rows += [(200, None, "en", "z"), (201, "", "en", None), (202, "", "en", "z")]
    rows += [(300, "same words again", "en", "x")] * 2  # a row twice
    rows += [(None, rows[3][1], "en", "y"), (None, "no id", "en", "y")]
    labels = [(i, rnd.randrange(2), rnd.randrange(2)) for i in range(0, 60, 2)] + [(0, 1, 0), (0, 0, 1), (999, 1, 1), (None, 1, 1)]
    labels += [(101, None, 1), (102, 1, None)]
    return rows, labels


def test_equals_a_replay_of_every_order(spark, corpus):
    rows, labels = corpus
    assert audited(spark, rows, labels) == replay(rows, labels)


def test_removal_step_is_the_first_failing_filter_of_the_order():
    orders, position, steps = filter_audit.removal_steps(4)
    for p, order in enumerate(orders):
        assert position[p].argsort().tolist() == list(order)
        for mask in range(16):
            failing = [k for k, f in enumerate(order) if mask >> f & 1]
            assert steps[mask, p] == (failing[0] if failing else 4)


def test_interactions_weigh_the_masks():
    counts = np.zeros((3, 4), np.int64)
    counts[0] = [5, 2, 3, 7]  # none, first, second, both
    found = filter_audit.interactions(counts, 2)
    assert found["removed"].tolist() == [[9, 3], [10, 2]]
    assert found["kept"].tolist() == [[8, 5], [7, 5]]
    assert found["redundant"].tolist() == [[0, 7], [0, 7]]
    assert found["unique_fails"].tolist() == [[2, 3], [3, 2]]
    assert found["shapley"].tolist() == [[11, 13], [13, 11]]


def test_empty_tables(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    only = audited(spark, [(1, "a b", "en", "s")], [])
    assert only["s", "ABCDE", 1]["removed"] == 1 and only["s", "ABCDE", 1]["good_lost"] == 0


def test_very_long_text_and_extra_columns(spark):
    rnd = random.Random(1)
    long = prose(rnd, 400_000, 10_000_000)
    rows = [(1, long, "en", "s"), (2, long, "en", "s"), (3, long + " x", "en", "s")]
    docs = documents(spark, rows).selectExpr("*", "1 AS mask", "map('a', 1) AS digest", "2 AS n", "3 AS part")
    found = audited(spark, rows, [(2, 1, 1)], docs)
    assert found["s", "EABCD", 1]["removed"] == 1 and found["s", "EABCD", 1]["good_lost"] == 1
    assert found["s", "EABCD", 5]["kept"] == 2


def test_a_text_shared_by_most_rows(spark):
    rows = [(i, "the same text for all", "en", f"s{i % 3}") for i in range(2000)] + [(5000, "other", "en", "s0")]
    found = audited(spark, rows, [])
    assert sum(found[f"s{k}", "EABCD", 1]["removed"] for k in range(3)) == 1999
    assert found["s0", "EABCD", 2]["removed"] == 2  # the first copy and the other text
