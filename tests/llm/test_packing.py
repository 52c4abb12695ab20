"""Packing against a plain concatenation of the library's own ids."""

import random
import zlib
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campaignlens.llm import packing
from tests.llm.helpers import documents, prose

LIBRARY = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@pytest.fixture(scope="module")
def content(spark):
    return packing.vocabulary(spark)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(rows, texts, window):
    """Pieces cover every row's ids once and fill the windows without gaps."""
    rows = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    fill = {}
    for s, group in groupby(rows, key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at and r.length > 0
            at += r.length
        fill[s] = at
    assert sorted(fill) == list(range(len(fill)))
    assert all(fill[s] == window for s in range(len(fill) - 1)) and all(v <= window for v in fill.values())
    per_document = {}
    for r in rows:
        per_document.setdefault(r.doc_id, []).append(r)
    assert set(per_document) == set(texts)
    for i, found in per_document.items():
        ids, at = np.array(ids_of(texts[i]), "<u4"), 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("window", [7, 64, 1024])
def test_pieces_equal_a_plain_concatenation(spark, content, window):
    rnd = random.Random(3)
    texts = {i: prose(rnd, rnd.randrange(0, 90)) for i in range(40)}
    texts |= {50: None, 51: "", 52: "  \n\n ", 53: "<|endoftext|> a<|endoftext|>", 54: "é日本 \x00😀 it's 1,234"}
    check(packing.pack(documents(spark, list(texts.items())), content, window).collect(), texts, window)


def test_offsets_over_blocks_of_partitions(spark):
    totals = spark.createDataFrame([(p, p % 5 + 1) for p in range(0, 60, 2)], "part int, n long")
    found = {r.part: r.before for r in packing.offsets(totals, block=8).collect()}
    at = 0
    for p in range(0, 60, 2):
        assert found[p] == at
        at += p % 5 + 1


def test_long_texts_are_cut_between_tokens():
    rnd = random.Random(5)
    encoder = packing.Encoder(open(public_tokenizers.path(packing.VOCABULARY), "rb").read())
    text = "  ".join(prose(rnd, 30) + rnd.choice([".", "\n", " don't", "<|endoftext|>"]) for _ in range(60))
    parts = list(packing._text_parts(text, 100))
    assert len(parts) > 10 and "".join(parts) == text
    assert np.concatenate([encoder._encoding.encode_to_numpy(p, allowed_special="all") for p in parts]).tolist() == ids_of(text)[:-1]


def test_very_long_text(spark, content):
    rnd = random.Random(6)
    texts = {1: prose(rnd, 150_000), 2: "x" * 300_000, 3: "a b"}
    check(packing.pack(documents(spark, list(texts.items())), content).collect(), texts, packing.WINDOW)


def test_repeated_rows_null_ids_and_extra_columns(spark, content):
    docs = documents(spark, [(1, "one two"), (1, "one two"), (None, "three")])
    docs = docs.selectExpr("*", "1 AS part", "2 AS at", "3 AS n", "map(1, 2) AS ids")
    rows = packing.pack(docs, content, 4).collect()
    n = len(ids_of("one two"))
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * n
    assert sum(r.length for r in rows if r.doc_id is None) == len(ids_of("three"))


def test_empty_table(spark, content):
    assert packing.pack(documents(spark, []), content).collect() == []


def test_windows_hold_the_ids_and_their_records(spark, content):
    rnd = random.Random(8)
    texts = {i: prose(rnd, rnd.randrange(0, 60)) for i in range(60)}
    cut = packing.store(packing.pack(documents(spark, list(texts.items())).repartition(5), content, 32, keep_ids=True))
    assert cut.where(F.crc32("ids") != F.col("ids_crc32")).count() == 0
    sequences = {r.sequence_id: r for r in packing.windows(cut, 32).collect()}
    assert sorted(sequences) == list(range(len(sequences)))
    got = {}
    for s in sorted(sequences):
        ids = np.frombuffer(sequences[s].ids, "<u4").tolist()
        at = 0
        for r in sequences[s].records:
            assert r.offset == at
            got.setdefault(r.doc_id, {})[r.start] = ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    for i, text in texts.items():
        assert [x for start in sorted(got[i]) for x in got[i][start]] == ids_of(text)


def test_same_input_packs_alike(spark, content):
    docs = documents(spark, [(i, f"text number {i}") for i in range(30)])
    first = sorted(map(tuple, packing.pack(docs, content, 16).collect()))
    assert first == sorted(map(tuple, packing.pack(docs, content, 16).collect()))
