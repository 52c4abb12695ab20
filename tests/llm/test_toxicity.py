import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import toxicity
from campaignlens.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT
from tests.llm.helpers import documents, prose


def score_clause(classes, weights):
    """The grammar's meaning, stated on its own."""
    total = 0.0
    for i, (c, w) in enumerate(zip(classes, weights)):
        if c in (INSULT, THREAT) and w:
            f = toxicity.THREATENED if c == THREAT else 1.0
            if NEGATION in classes[max(0, i - toxicity.NEGATION_REACH) : i]:
                f *= toxicity.NEGATED
            if REPORT in classes[:i]:
                f *= toxicity.REPORTED
            if TARGET in classes[max(0, i - toxicity.TARGET_REACH) : i]:
                f *= toxicity.TARGETED
            if TARGET in classes[i + 1 : i + 1 + toxicity.TARGET_REACH]:
                f *= toxicity.TARGETED
            total += w * f
    return total


def test_composed_machine_equals_its_meaning():
    rnd = random.Random(1)
    machine, behind = toxicity.grammar(), toxicity.fading(TARGET, toxicity.TARGET_REACH, toxicity.TARGETED)
    for _ in range(300):
        classes = [rnd.choice([OTHER, OTHER, OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]) for _ in range(rnd.randint(1, 14))]
        weights = [rnd.random() * 3 if c in (INSULT, THREAT) else 0.0 for c in classes]
        assert toxicity.run_clause(machine, behind, classes, weights) == pytest.approx(score_clause(classes, weights))


def test_clauses_negation_and_report():
    lexicon = toxicity.Lexicon.of(toxicity.seed_terms())
    machine, behind = toxicity.grammar(), toxicity.fading(TARGET, toxicity.TARGET_REACH, toxicity.TARGETED)
    texts = ["You IDIOT, you", "he is not an idiot", "they wrote idiot", "idiot. moron\nscum", "nothing here", "", None, "idiotic"]
    f = toxicity.measure(pa.array(texts), lexicon, machine, behind)
    assert f[0, 0] == pytest.approx(3 * 1.5 * 1.5)
    assert f[1, 0] == pytest.approx(3 * toxicity.NEGATED * toxicity.TARGETED)
    assert f[2, 0] == pytest.approx(3 * toxicity.REPORTED * toxicity.TARGETED)
    assert f[3].tolist()[:2] == [3.0, 9.0] and f[3, 3] == 3
    assert not f[4:].any()


def labelled(spark, n=240):
    rnd = random.Random(3)
    rows, marks = [], []
    for i in range(n):
        toxic = i % 4 == 0
        w = prose(rnd, 40).split()
        if toxic:
            w[rnd.randrange(40)] = rnd.choice(["zorgu", "zorgix", "zorgast"])  # a beginning to be learned
        rows.append((i, " ".join(w) + "."))
        marks.append((i, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_learned_beginnings_generalise_to_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels.where("doc_id < 160"))
    out = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("predicted", F.lit("mine")), model).collect()}
    wrong = [i for i in range(160, 240) if out[i]["predicted"] != (i % 4 == 0)]
    assert not wrong
    again = toxicity.learn(docs, labels.where("doc_id < 160"))
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.lexicon.keys, again.lexicon.keys)


def test_edge_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "you moron " * 20000), (3, "you moron"), (None, "fine words")])
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    got = [(r["doc_id"], r["predicted"], r["score"]) for r in toxicity.score(docs, model).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for *_, s in got)
    assert {p for i, p, _ in got if i == 3} == {1} and {p for i, p, _ in got if i != 3} == {0}
    assert toxicity.score(docs.where("doc_id = 9"), model).count() == 0
