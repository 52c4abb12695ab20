import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from campaignlens.llm import linededup
from tests.llm.helpers import documents, prose, removed_lines


def corpus() -> list[tuple[int, str | None]]:
    rnd = random.Random(9)
    stock = [prose(rnd, rnd.choice([1, 3, 9, 20, 60]), 80) for _ in range(25)]
    rows: list[tuple[int, str | None]] = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(1, 7)):
            w = rnd.choice(stock).split() if rnd.random() < 0.7 else prose(rnd, 12, 3000).split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(300)}"
            rnd.shuffle(w)
            lines.append(" ".join(w).upper() if rnd.random() < 0.2 else " ".join(w))
            if rnd.random() < 0.2:
                lines.append(rnd.choice(["", "  ", "\t"]))
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n")]


def found(spark, rows, **kwargs):
    gone = linededup.removals(documents(spark, rows), **kwargs)
    return {r["id"]: r["removed"] for r in gone.collect()}


def test_removed_lines_equal_all_pairs(spark):
    rows = corpus()
    want = {i: x for i, x in removed_lines(rows).items() if x}
    assert len(want) > 20
    assert found(spark, rows) == want
    # With a single offer per word the second pass does the rest.
    assert found(spark, rows, offers=1) == want


def test_family_without_a_match_at_the_first_offers(spark):
    """Lines whose earliest partners do not match need the second pass."""
    base = [f"b{i}" for i in range(20)]
    rows = [(i, " ".join(base[:16] + [f"x{i}{k}" for k in range(4)])) for i in range(14)]
    rows += [(50, " ".join(base[:17] + ["y1", "y2", "y3"])), (51, " ".join(base[:17] + ["y1", "y2", "z"]))]
    want = {i: x for i, x in removed_lines(rows).items() if x}
    assert found(spark, rows, offers=1) == want


def template(m):
    return [f"posted by user{i} on this forum under the usual terms and conditions of use" for i in range(m)]


def one_list(lines):
    """The posting list of a word that all lines post."""
    raw = np.frombuffer("\n".join(lines).encode(), np.uint8)
    w, at, _, line = linededup._line_sets(raw, np.array([0, len(raw)]), np.zeros(256, np.uint8))
    b1, b2 = linededup._sketch(w, at)
    zeros = np.zeros(len(line), np.int64)
    s1 = linededup._signatures(w, at)[0]
    return {"token": zeros, "n": np.diff(at), "doc": line.astype(np.int64), "line": zeros, "s1": s1, "at": zeros, "b1": b1, "b2": b2}


def test_one_word_of_20000_near_lines_in_bounded_memory():
    g = one_list(template(20_000))
    tracemalloc.start()
    x, y, more = map(np.concatenate, zip(*linededup._pairs_of_group(g, 80, 100, 8)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    count = np.bincount(y, minlength=20_000)
    assert count.tolist() == [min(i, 8) for i in range(20_000)] and (x < 8).all()
    assert sorted(set(more.tolist())) == list(range(9, 20_000))
    # The second pass makes the pairs of the entries that are asked for only.
    wanted = np.zeros(20_000, np.int32)
    wanted[[5, 19_000]] = 1
    pairs = [(a, b) for x, y, _ in linededup._pairs_of_group(g | {"wanted": wanted}, 80, 100, None) for a, b in zip(x.tolist(), y.tolist())]
    assert sorted(pairs) == sorted([(i, 5) for i in range(5)] + [(i, 19_000) for i in range(19_000)])


def test_long_lists_give_the_pairs_of_short_ones(monkeypatch):
    rnd = random.Random(3)
    g = one_list([" ".join(["a", "b", "c", "d", "e", "f"][: rnd.randint(2, 6)] + [f"x{rnd.randrange(9)}", f"y{i}"]) for i in range(400)])
    g["doc"] = g["doc"] // 3  # some places are shared
    for offers in (1, 3, None):
        got = []
        for bound in (512, 0):
            monkeypatch.setattr(linededup, "_SHORT", bound)
            x, y, more = map(np.concatenate, zip(*linededup._pairs_of_group(g, 50, 100, offers)))
            got.append((sorted(zip(x.tolist(), y.tolist())), set(more.tolist())))
        assert got[0][0] == got[1][0] and len(got[0][0]) > 100
        # A long list may say that there is more where there is not, never the reverse.
        assert got[0][1] <= got[1][1]


def test_family_of_a_template_and_places_shared_by_texts(spark):
    lines = template(2_000)
    random.Random(5).shuffle(lines)
    rows = [(i, line) for i, line in enumerate(lines)]
    assert found(spark, rows) == {i: [0] for i in range(1, 2_000)}
    rows = [(i, t) for i, t in corpus() if t] + [(None, t) for _, t in corpus() if t] + [(7, "w1 w2 w3 w4 w5 x"), (7, "w1 w2 w3 w4 w5")]
    docs = documents(spark, rows)
    got = [sorted((r["id"] or -1, r["key"], r["removed"]) for r in linededup.removals(docs, offers=o).collect()) for o in (1, 10_000)]
    assert got[0] == got[1] and got[0]


def test_dedup_rebuilds_texts_and_keeps_columns(spark):
    rows = [(1, "keep this line\nsecond line here"), (2, "Second LINE here\nown words only"), (3, None), (2, "other text of two")]
    docs = documents(spark, rows).withColumn("removed", F.lit("mine")).withColumn("key", F.lit(1))
    out = linededup.dedup(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"], r["removed"]) for r in out.collect()), key=str)
    want = [(1, rows[0][1], "mine"), (2, "own words only", "mine"), (3, None, "mine"), (2, "other text of two", "mine")]
    assert got == sorted(want, key=str)


def test_repeated_rows_null_ids_and_all_lines_removed(spark):
    rows = [(4, "same words in here"), (4, "same words in here"), (None, "same words in here"), (9, "a b c d e f")]
    got = linededup.dedup(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
        [(4, "same words in here"), (4, "same words in here"), (None, ""), (9, "a b c d e f")], key=str
    )


def test_report_counts_and_empty_table(spark):
    docs = documents(spark, [(1, "a b\nb a\n"), (2, None)])
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed"]) for r in linededup.report(docs).collect()}
    assert got == {1: (3, 1, [1]), 2: (0, 0, [])}
    assert linededup.report(docs.where("doc_id = 5")).count() == 0
    assert linededup.dedup(docs.where("doc_id = 5")).count() == 0
