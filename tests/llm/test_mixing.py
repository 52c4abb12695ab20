import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from campaignlens.llm import mixing
from tests.llm.helpers import documents, words


def levels(sizes: dict, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0) -> dict:
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= cap * sizes[s]}
        if not over:
            out |= {s: w[s] * level for s in free}
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


def corpus(seed=0):
    rows = []
    for s, n in (("a", 40), ("b", 15), ("c", 90), ("d", 3), (None, 25), ("e", 60)):
        for i in range(n):
            rows.append((len(rows), "w " * ((i * 7 + seed) % 31), "en", s))
    return rows


def test_targets_and_copies(spark):
    rows = corpus()
    sizes = defaultdict(int)
    for _, text, _, s in rows:
        sizes[s] += len(words(text))
    want = levels(sizes)
    plan = mixing.mix_plan(documents(spark, rows)).collect()
    taken, longest = defaultdict(int), defaultdict(int)
    assert len(plan) == len(rows)
    for r in plan:
        text, source = rows[r["doc_id"]][1], rows[r["doc_id"]][3]
        assert r["size"] == len(words(text)) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[source] += r["taken"]
        longest[source] = max(longest[source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * longest[s]


def test_systematic_sampling_crosses_each_integer_once(spark):
    plan = mixing.mix_plan(documents(spark, corpus(3))).collect()
    by = defaultdict(list)
    for r in plan:
        by[r["source_size"], r["target"]].append(r["copies"])
    for (size, target), copies in by.items():
        rate = target / size if size else 0
        assert all(c in (math.floor(rate), math.ceil(rate)) for c in copies)
        assert abs(sum(copies) - rate * len(copies)) <= 1


def test_mix_repeats_rows_reruns_agree_and_columns_stay(spark):
    rows = corpus(1) + [(7, "x y z", "en", "a"), (7, "x y z", "en", "a"), (None, "u v", "en", "b"), (900, None, "en", "a"), (901, "", "en", "zero")]
    docs = documents(spark, rows).withColumn("size", F.lit("mine")).withColumn("target", F.lit(1)).withColumn("_s", F.lit(2))
    once, again = mixing.mix(docs), mixing.mix(docs.repartition(7))
    assert once.columns == docs.columns
    a, b = (sorted(map(str, x.collect())) for x in (once, again))
    assert a == b
    assert len(a) == sum(r["copies"] for r in mixing.mix_plan(docs).collect())


def test_empty_table_and_texts_without_words(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, " \n")])
    got = {r["doc_id"]: (r["size"], r["target"], r["taken"]) for r in mixing.mix_plan(docs).collect()}
    assert got == {1: (0, 0.0, 0), 2: (0, 0.0, 0), 3: (0, 0.0, 0)}
    assert mixing.mix_plan(docs.where("doc_id = 9")).count() == 0
    assert mixing.mix(docs.where("doc_id = 9")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(documents(spark, corpus()))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
