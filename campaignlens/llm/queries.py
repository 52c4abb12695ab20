"""The registered queries of this package and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlens.llm import (
    conversation_repair,
    filter_audit,
    jaccard_groups,
    langid,
    linededup,
    mixing,
    nbest,
    packing,
    quality_crf,
    repetition,
    scaled_sketch,
    toxicity,
    urlrules,
)
from campaignlens.llm.common import crc_bucket, prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; prototypes from the documents that are not held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = langid.learn(docs, crc_bucket(F.col("doc_id"), 5) != 0)
    judged = langid.identify(docs.select("doc_id", "text"), prototypes, keep_text=False)
    return judged.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "cosine")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that match an earlier line of the corpus."""
    prepare(spark)
    report = linededup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return report.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies and words the mix takes of every document."""
    prepare(spark)
    plan = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.withColumn("target", F.round("target", 6))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's address."""
    prepare(spark)
    return urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op5_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, its N best segmentations, and whether decoding gives back the text."""
    prepare(spark)
    proto = nbest.model_bytes(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = nbest.decode(nbest.encode(docs, proto), proto)
    return decoded.withColumn("round_trip", F.coalesce("text", F.lit("")) == F.col("decoded")).drop("text", "decoded")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from the labelled rows that are not held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out))
    scored = toxicity.score(docs, model, keep_text=False)
    return scored.withColumn("held_out", held_out)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned from the labelled rows that are not held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    field = quality_crf.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out))
    scored = quality_crf.score(docs, field, keep_text=False)
    return scored.withColumn("held_out", held_out)


def op8_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    prepare(spark)
    return jaccard_groups.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, its repeats, and whether it is kept."""
    prepare(spark)
    return repetition.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op10_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likenesses."""
    prepare(spark)
    return scaled_sketch.edit_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every order of the five filters removes in every source."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in the packed sequences."""
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), packing.vocabulary(spark))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    prepare(spark)
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_url_rules": op4_url_rules,
    "op5_sentencepiece_nbest": op5_sentencepiece_nbest,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_jaccard_groups": op8_jaccard_groups,
    "op9_repetition_rules": op9_repetition_rules,
    "op10_scaled_sketch": op10_scaled_sketch,
    "op11_filter_audit": op11_filter_audit,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": linededup.oracle(),
    "op3_mix_sources": mixing.oracle(),
    "op4_url_rules": urlrules.oracle(),
    "op8_jaccard_groups": jaccard_groups.oracle(),
    "op11_filter_audit": filter_audit.oracle(),
    "op13_conversation_repair": conversation_repair.oracle(),
}
