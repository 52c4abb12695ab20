import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from campaignlens.llm import repetition, textops
from tests.llm.helpers import WORD, documents, prose, words


def brute(w):
    best = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            k = 0
            while i != j and i + k < len(w) and j + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def texts():
    rnd = random.Random(6)
    out = [" ".join(rnd.choice("abc"[: rnd.randint(1, 3)]) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    passage = prose(rnd, 30, 10**6)
    out += [passage + "\n" + prose(rnd, 60, 10**6) + "\n" + passage, "x " * 70, "a\nb\na\n\n\na ", "# $x | <é>", "", None]
    return out


def test_longest_repeats_equal_all_pairs():
    column = pa.array(texts())
    raw, offsets = textops.text_buffers(column)
    h, _, _, at = textops.word_spans(raw, offsets)
    best = repetition.longest_repeats(h, at)
    for i, t in enumerate(texts()):
        assert best[at[i] : at[i + 1]].tolist() == brute(words(t))


def test_counts_and_verdicts(spark):
    rows = list(enumerate(texts())) + [(0, texts()[0])]
    docs = documents(spark, rows).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(1.5))
    # The result's own columns replace clashing ones.
    out = repetition.judge(docs.drop("kept"))
    assert out.count() == len(rows)
    for r in out.collect():
        t = r["text"] or ""
        w = words(t)
        triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        inside = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside),
        )
        best = brute(w)
        spans = {i + k for i, b in enumerate(best) if b >= repetition.REPEAT_WORDS for k in range(b)}
        assert r["covered_words"] == len(spans) and r["longest_repeat"] == max(best, default=0)
        base = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        assert r["base_failed"] == base
        repeats = len(spans) > repetition.MAX_COVERED * len(w) or max(best, default=0) > repetition.MAX_LONGEST * len(w)
        assert r["kept"] == (not base and not repeats)


def test_very_long_repetitive_text_and_empty_table(spark):
    docs = documents(spark, [(1, "ab cd " * 40000), (2, " ".join(map(str, range(50000))))])
    got = {r["doc_id"]: (r["longest_repeat"], r["n_repeat_words"], r["kept"]) for r in repetition.judge(docs).collect()}
    assert got == {1: (79998, 80000, False), 2: (0, 0, True)}
    assert repetition.judge(docs.where("doc_id = 3")).count() == 0


def test_union_of_spans():
    best = np.array([0, 3, 2, 1, 0, 4, 3, 2, 1])
    at = np.array([0, 5, 9])
    assert repetition.covered(best, at, 2).tolist() == [3, 4]
    assert repetition.covered(best, at, 3, 3).tolist() == [3, 4]
