import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import nbest
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def proto():
    with open(nbest.MODEL_FILE, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def vocabulary(proto):
    return nbest.Vocabulary(proto)


def every_segmentation(v, unit):
    found = []

    def walk(at, ids, score):
        if at == 0:
            found.append((score, ids))
            return
        for start, piece, s in v.edges_to(unit, at):
            walk(start, piece + ids, score + s)

    walk(len(unit), (), 0.0)
    return sorted(found, key=lambda x: (-x[0], x[1]))


def units(n=120):
    rnd = random.Random(4)
    alphabet = list("abcdehint é漢▁\U0001f642.") + ["the", "ing"]
    return list(dict.fromkeys(" " + "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7))).replace(" ", "") for _ in range(n)))


def test_best_second_and_n_best_equal_enumeration(vocabulary):
    for s in nbest.segment(vocabulary, units()):
        at = np.concatenate([[0], np.cumsum(s.length)])
        for i, u in enumerate(s.units):
            every = every_segmentation(vocabulary, u)
            ids = tuple(s.flat[at[i] : at[i + 1]].tolist())
            assert s.score[i] == pytest.approx(every[0][0]) and (s.score[i], ids) in [(pytest.approx(a), b) for a, b in every[:3]]
            second = every[0][0] - every[1][0] if len(every) > 1 else float("inf")
            assert s.loss[i] == pytest.approx(second)
            assert [x for x, _ in vocabulary.search(u, 6)] == pytest.approx([x for x, _ in every[:6]])


def best_losses(v, unit, n):
    """Losses of the ``n`` best segmentations by a forward pass over scores alone."""
    ways = [[0.0]]
    for end in range(1, len(unit) + 1):
        every = [x + w for start, _, w in v.edges_to(unit, end) for x in ways[start]]
        ways.append(sorted(every, reverse=True)[:n])
    return [ways[-1][0] - x for x in ways[-1]]


@pytest.mark.parametrize("length", [301, 1001, 100_000])
@pytest.mark.parametrize("char", ["#", "-", ".", "x"])
def test_long_runs_of_one_character(vocabulary, char, length):
    unit = char * length
    found = vocabulary.search(unit, 3)
    assert [found[0][0] - s for s, _ in found] == pytest.approx(best_losses(vocabulary, unit, 3), abs=1e-6)
    assert len({ids for _, ids in found}) == 3
    scored = {i: float(s) for i, s in enumerate(vocabulary.score)}
    for s, ids in found:
        assert b"".join(vocabulary.raw[i] for i in ids).decode() == unit
        assert s == pytest.approx(sum(scored[i] for i in ids))
    (one,) = nbest.segment(vocabulary, [unit])
    assert tuple(one.flat.tolist()) == found[0][1] and one.loss[0] == pytest.approx(found[0][0] - found[1][0])


@pytest.mark.parametrize("unit", ["#" * 500, "." * 3000, " " + "the" * 200, "漢" * 300, "xé" * 400])
@pytest.mark.parametrize("n", [1, 3, 8])
def test_a_position_is_expanded_at_most_n_times(vocabulary, unit, n):
    expansions = 0

    def tick():
        nonlocal expansions
        expansions += 1

    found = vocabulary.search(unit, n, tick)
    assert expansions <= n * len(unit)
    assert [found[0][0] - s for s, _ in found] == pytest.approx(best_losses(vocabulary, unit, n), abs=1e-6)


def test_forward_scores_are_the_exact_rest(vocabulary):
    for u in units(40):
        best = vocabulary.forward(u)
        for end in range(1, len(u) + 1):
            assert best[end] == pytest.approx(every_segmentation(vocabulary, u[:end])[0][0])


def test_text_n_best_equal_products_of_units(proto):
    encoder = nbest.Encoder(nbest.Vocabulary(proto))
    text = "then thing abc the cat"
    parts = nbest.split_units(encoder.v, text)
    numbers = encoder.numbers([parts])[0]
    every = [every_segmentation(encoder.v, u) for u in parts]
    best = sum(e[0][0] for e in every)
    losses = sorted(best - sum(s for s, _ in c) for c in itertools.product(*[e[:5] for e in every]))
    got = encoder.alternatives(numbers, 5)
    assert [x for x, _ in got] == pytest.approx(losses[1:5])


TEXTS = [
    "Hello  world", "  two leading", "trailing  ", "tab\tand\nnew\r\nline", "▁literal ▁ mark", "漢字 \U0001f642 é", " ", "\n", "x" * 300,
    "lorem ipsum dolor " * 3000, "<0x41> </s> <unk>", "\x00\x01",
]


def test_round_trip_edge_cases_and_edits(spark, proto):
    rows = list(enumerate(TEXTS)) + [(100, None), (101, ""), (0, TEXTS[0])]
    docs = documents(spark, rows).withColumn("ids", F.lit("mine")).withColumn("score", F.lit(1))
    encoded = nbest.encode(docs, proto, n_best=4)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", *nbest.ADDED]
    out = nbest.decode(encoded, proto).collect()
    assert len(out) == len(rows)
    v = nbest.Vocabulary(proto)
    for r in out:
        assert r["decoded"] == (r["text"] or "")
        assert r["n_pieces"] == len(r["ids"]) and (r["n_pieces"] > 0) == bool(r["text"])
        last = 0.0
        for a in r["alternatives"]:
            ids = list(r["ids"])
            for e in sorted(a["edits"], key=lambda e: -e["start"]):
                ids[e["start"] : e["start"] + e["length"]] = e["ids"]
            assert nbest.decode_ids(v, ids) == r["text"] and len(ids) == a["n_pieces"]
            assert ids != r["ids"] and a["loss"] >= last
            last = a["loss"]


def test_empty_table_and_model_bytes(spark, proto):
    assert nbest.model_bytes(spark) == proto
    assert nbest.encode(documents(spark, [(1, "a")]).where("doc_id = 2"), proto).count() == 0
