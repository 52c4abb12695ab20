import random

import pytest
from pyspark.sql import functions as F

from campaignlens.llm import graph, jaccard_groups
from tests.llm.helpers import components, documents, prose, shingles


def corpus() -> dict[int, str | None]:
    rnd = random.Random(5)
    texts: dict[int, str | None] = {}
    shared = prose(rnd, 25)
    for i in range(12):
        base = prose(rnd, rnd.choice([3, 8, 40, 120]))
        texts[len(texts)] = base
        for _ in range(rnd.randrange(4)):  # near copies at several distances, and exact ones
            w = base.split()
            for _ in range(rnd.choice([0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
            texts[len(texts)] = " ".join(w) + (" tail" if rnd.random() < 0.3 else "")
        texts[len(texts)] = shared + " " + prose(rnd, 20)
    chain = prose(rnd, 60).split()
    for k in range(6):  # each near the next only
        chain = chain[3:] + [f"c{k}{j}" for j in range(3)]
        texts[len(texts)] = " ".join(chain)
    texts |= {900: None, 901: "", 902: " \n\t ", 903: "One Two", 904: "one two", 905: "one two three"}
    return texts


def test_components_equal_all_pairs(spark):
    texts = corpus()
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in jaccard_groups.near_classes(documents(spark, list(texts.items()))).collect()
    }
    want = components(texts)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in texts.items()}
    assert len(set(want.values())) < len(texts) - 10  # there are links


def test_large_family_of_near_copies_is_joined_by_few_pairs(spark, monkeypatch):
    rnd = random.Random(2)
    base = prose(rnd, 100, 10**6).split()
    rows = []
    for i in range(150):
        w = list(base)
        w[rnd.randrange(100)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    seen = []
    real = jaccard_groups._verified

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(jaccard_groups, "_verified", counted)
    got = jaccard_groups.near_classes(documents(spark, rows))
    assert {r["component_id"] for r in got.collect()} == {0}
    assert sum(seen) < 150 * 149 / 8  # far fewer than all pairs


def test_keep_one_null_ids_repeated_rows_and_clashing_columns(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (3, text + " i"), (None, text), (7, ""), (8, ""), (None, None), (1, "other words here")]
    docs = documents(spark, rows).withColumn("n", F.lit(1)).withColumn("root", F.lit("r")).withColumn("key", F.lit(2.0))
    kept = jaccard_groups.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(3, text + " i"), (7, ""), (8, ""), (None, None), (1, "other words here")]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    docs = documents(spark, [(1, "x")]).where("doc_id = 2")
    assert jaccard_groups.near_classes(docs).count() == 0
    assert jaccard_groups.keep_one(docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_components_of_random_links(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert all(got[x] == find(x) for x in got)
    assert {x for a, b in links if a != b for x in (a, b)} == set(got)
