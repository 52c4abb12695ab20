import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import scaled_sketch as S
from tests.llm.helpers import documents, jaccard, prose, words


def exact(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_sketch_keeps_hashes_below_the_fraction_and_merges():
    rnd = random.Random(1)
    a, b = prose(rnd, 3000, 10**6), prose(rnd, 200, 10**6)
    one, two, both, all_ = (S.sketches(pa.array([t]), fraction=f)[0] for t, f in ((a, 0.25), (b, 0.25), (a + " " + b, 0.25), (a, 1.0)))
    assert set(one) == {h for h in all_ if h < int(0.25 * 2**48)}
    assert len(np.setdiff1d(S.merge([one, two]), both)) == 0  # both has the few shingles across the seam besides
    assert S.containment(two, both) == 1.0 and S.likeness(two, both) < 0.2
    assert np.array_equal(S.from_text(S.to_text(one)), one)
    small = S.sketches(pa.array(["one two", "one two", "", None, "x"]), fraction=1e-9)
    assert [len(s) for s in small] == [1, 1, 0, 0, 1] and np.array_equal(small[0], small[1])
    assert np.array_equal(S.merge([small[0], one]), one) or small[0][0] < int(0.25 * 2**48)


def test_likeness_estimates():
    rnd = random.Random(2)
    base = prose(rnd, 2000, 10**6).split()
    for cut in (200, 1000, 1800):
        x, y = " ".join(base), " ".join(base[:cut])
        a, b = S.sketches(pa.array([x, y]))
        assert S.likeness(a, b) == pytest.approx(jaccard(exact(x), exact(y)), abs=0.06)
        assert S.containment(b, a) == pytest.approx(1.0)


def test_short_text_in_a_long_one(spark):
    rnd = random.Random(8)
    whole = prose(rnd, 900, 10**6).split()
    (big,) = S.sketches(pa.array([" ".join(whole)]))
    parts = [" ".join(whole[i : i + 5 + i % 3]) for i in range(0, 600, 10)]
    marks = S.sketches(pa.array(parts))
    assert {S.containment(m, big) for m in marks} == {1.0, None}
    other = S.sketches(pa.array([prose(rnd, 5, 10**6) for _ in range(60)]))
    assert {S.containment(m, big) for m in other} == {0.0, None}
    assert S.containment(marks[0], np.empty(0, np.uint64)) == 0.0
    # A short text follows the long one by descending id: the report knows.
    for i, part in enumerate([*parts[:4], prose(rnd, 5, 10**6)]):
        rows = S.edit_report(documents(spark, [(2, " ".join(whole)), (1, part)]), ranges=1).collect()
        assert {r["doc_id"]: r["next_holds"] for r in rows}[2] == (1.0 if i < 4 else 0.0)


def test_edit_report_equals_plain_python(spark):
    rnd = random.Random(3)
    rows = [(i * 3, prose(rnd, rnd.choice([0, 2, 7, 60, 300]), 10**6)) for i in range(80)]
    rows += [(1000, None), (1001, ""), (1002, "é\U0001f642 " * 40), (1003, rows[5][1])]
    out = {r["doc_id"]: r for r in S.edit_report(documents(spark, rows).withColumn("r", F.lit(1)), ranges=6).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    assert len(out) == len(rows)
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        r = out[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        marks = [S.sketches(pa.array([t]))[0] for t in (text, changed, following)]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (S.to_text(marks[0]), S.to_text(marks[1]))
        assert r["near_edited"] == S.likeness(marks[0], marks[1]) and r["near_next"] == S.likeness(marks[0], marks[2])
    assert out[1003]["fingerprint"] == out[rows[5][0]]["fingerprint"]


@pytest.mark.parametrize("rows", [[(1, "only one document here now")], [(None, "a b c"), (None, "d e f"), (2, "g")], [(5, "x"), (5, "x"), (5, "y")]])
def test_null_and_equal_ids(spark, rows):
    out = S.edit_report(documents(spark, rows), ranges=3).collect()
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1])
    ordered = sorted(rows, key=key)
    want = []
    for k, (i, text) in enumerate(ordered):
        want.append((i, hashlib.sha256(S.edited(text, ordered[(k + 1) % len(ordered)][1]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in out), key=str) == sorted(want, key=str)


def test_empty_table_and_general_operator(spark):
    docs = documents(spark, [(1, "a b c d e f"), (2, None)]).withColumn("fingerprint", F.lit("mine"))
    got = {r["doc_id"]: r["fingerprint"] for r in S.fingerprint(docs).collect()}
    assert got[2] == "" and len(got[1]) % 12 == 0 and got[1]
    assert S.edit_report(docs.where("doc_id = 3")).count() == 0
    assert S.fingerprint(docs.where("doc_id = 3")).count() == 0


def test_merged_sketches_and_containment_equal_plain_sets(spark):

    rnd = random.Random(21)
    rows = [(i, prose(rnd, rnd.randrange(1, 120), 300), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100, " ".join(r[1] for r in rows[:6]), "en", "big"), (101, None, "en", "s0"), (102, "", "en", "s1"), (103, rows[0][1], "en", None)]
    prints = S.fingerprint(documents(spark, rows))
    limit = int(S.FRACTION * (1 << 48))
    own = {r["doc_id"]: {int(h) for h in S.from_text(r["fingerprint"]) if h < limit} for r in prints.collect()}
    want: dict = {}
    for i, _, _, source in rows:
        want.setdefault(source, set()).update(own[i])
    groups = S.merged(prints, "source")
    got: dict = {}
    for r in groups.collect():
        got.setdefault(r["source"], set()).add(int(r["hash"], 16))
    assert got == {s: h for s, h in want.items() if h}
    found = {(r["doc_id"], r["source"]): (r["kept"], r["common"]) for r in S.containment_in(prints, groups).collect()}
    plain = {(i, s): (len(h), len(h & w)) for i, h in own.items() for s, w in want.items() if h & w}
    assert found == plain
    assert all(found[i, "big"][0] == found[i, "big"][1] for i in range(6) if own[i])
    both = groups.where("source = 's0'").select("hash").union(groups.where("source = 's1'").select("hash")).distinct()
    assert both.count() == len(want["s0"] | want["s1"])
