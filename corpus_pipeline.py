"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``campaignlens.llm``.

Every stage reads what its predecessor wrote.  All but the last return the
columns of ``documents``; the last returns each document's pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlens.llm import jaccard_groups, langid, linededup, mixing, nbest
from campaignlens.llm.common import WORD, prepare, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text resembles one of the corpus' languages.

    Rejected: null and empty texts, texts without letters, and texts long
    enough to judge whose best cosine is under the bound for their length
    (``langid.resembles``).  Very long texts are judged whole; equal texts and
    repeated rows alike; other columns are kept, whatever their names and types.
    """
    prepare(spark)
    prototypes = langid.learn(docs, F.lit(True))
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no clash with the added columns
    judged = langid.identify(plain, prototypes, text_col=f"c{names.index('text')}", with_size=True)
    kept = judged.where(langid.resembles())
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that match an earlier line; ``n_chars`` follows the text.

    A document all of whose lines go stays, with an empty text, so that later
    stages can tell; null and empty texts have no line to lose; of equal lines
    the earliest document's stays (ties as in ``linededup``); very long texts
    are read whole; an empty table stays empty.
    """
    prepare(spark)
    return linededup.dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Documents without words are linked with nothing and stay; of a group the
    smallest id stays, of repeated rows one; very long texts count whole.
    """
    prepare(spark)
    return jaccard_groups.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a document's row appears once for every copy taken.

    Documents without words (null, empty, or emptied by line dedup) have
    nothing to mix and are left out; equal and repeated rows are placed one by
    one; very long texts count with all their words; an empty table stays empty.
    """
    prepare(spark)
    return mixing.mix(docs.where(F.col("text").rlike(WORD)))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document's best segmentation, and its alternatives.

    Null and empty texts have no pieces; repeated rows are encoded alike; very
    long texts are segmented whole.
    """
    prepare(spark)
    encoded = nbest.encode(docs.select("doc_id", "lang", "source", "text"), nbest.model_bytes(spark), keep_text=False)
    return encoded.select("doc_id", "lang", "source", "n_pieces", "score", "ids", "alternatives")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("sentence_pieces", sentence_pieces),
]

# Language ID, line similarity and segmentation have no SQL form; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; every stage's result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
