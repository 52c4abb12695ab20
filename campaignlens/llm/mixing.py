"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the same expected number of copies, ``target /
source_size``.  Documents of a source stand in one order; the prefix sum of
expected copies plus one offset per source is a rising line, and a document is
emitted once for every integer the line crosses inside it.  The order is by
size, so the words taken differ from the target by about one document's size
at most.

The position of a document in its source comes from counts per *cell*
(source, size, two hash digits of the id) and a row number inside the cell, so
no task ever holds a whole source: windows run over a source's distinct sizes,
over the cells of one size, and inside one cell.

Defined cases: a null text has size 0; a null source is a source of its own
and ordered last; a source without words has target 0 and is never taken;
repeated rows are separate documents; an empty table gives an empty result;
``mix`` returns the columns of its input and nothing else, ``mix_plan`` only the
id and the added columns, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlens.llm.common import WORD, col, row_hash, store

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2.0
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words of a text as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _named(source: Column) -> Column:
    """A non-null key for a source; null and the text ``n`` stay apart."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def offset_of(source: Column, seed: str) -> Column:
    """The one random offset of a source, in [0, 1)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), _named(source)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """``source, source_size, target`` from one row per source ``(source, source_size)``.

    Weights repeat over the sources by code point, null last.  The target is
    ``min(cap, weight * level)`` with the one level at which the targets add
    up to ``share`` of all sizes: sorted by ``cap / weight``, sources are
    capped up to the first whose cap exceeds its part of what is left.  The
    windows see one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    up = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    onward = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = left / F.sum("_weight").over(onward)
    return (
        sizes.withColumn("_weight", w)
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_level", level)
        # The first source that is not capped fixes the level for it and all after it.
        .withColumn("_level", F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(everything))
        .select(
            "source",
            "source_size",
            F.least(
                F.col("_cap"), F.coalesce(F.col("_weight") * F.col("_level"), F.col("_cap"))
            ).alias("target"),
        )
    )


def _planned(
    docs: DataFrame,
    id_col: str,
    source_col: str,
    size: Column,
    carry: Sequence[str],
    weights: Sequence[float],
    share: float,
    max_repeats: float,
    seed: str,
) -> DataFrame:
    rows = docs.select(
        F.struct(*[col(c) for c in carry]).alias("_row"),
        row_hash(docs.select(*[col(c) for c in carry])).alias("_tie"),
        col(source_col).cast("string").alias("source"),
        size.alias("size"),
        F.coalesce(col(id_col).cast("string"), F.lit("")).alias("_id"),
    ).withColumn("_cell", F.substring(F.md5(F.col("_id")), 1, 2))
    rows = rows.withColumn("_s", _named(F.col("source")))
    cell = ["_s", "size", "_cell"]
    # Stored, so that the texts are read once for the counts and once for the rows.
    counts = store(rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"), F.first("source").alias("source")))
    by_size = counts.groupBy("_s", "size").agg(F.sum("_n").alias("_m"), F.first("source").alias("source"))
    sizes = by_size.groupBy("_s").agg(
        F.sum(F.col("_m") * F.col("size")).alias("source_size"), F.first("source").alias("source")
    )
    goals = targets(sizes.select("source", "source_size"), weights, share, max_repeats)
    # Documents before a size in its source, and before a cell in its size: a source's window holds its distinct
    # sizes only, however many documents it has.
    smaller = Window.partitionBy("_s").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_s", "size").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        by_size.withColumn("_below", F.coalesce(F.sum("_m").over(smaller), F.lit(0)))
        .drop("_m", "source")
        .join(goals.withColumn("_s", _named(F.col("source"))).drop("source"), "_s")
    )
    cells = (
        counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n", "source")
        .join(levels, ["_s", "size"])
        .withColumn("_before", F.col("_below") + F.col("_ahead"))
        .drop("_below", "_ahead")
    )
    inside = Window.partitionBy(*cell).orderBy("_id", "_tie")
    # Window and join have the same keys, so the documents move once.
    placed = rows.withColumn("_at", F.row_number().over(inside).cast("long")).join(cells, cell)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("_before") + F.col("_at")
    line = lambda i: F.floor(i.cast("double") * F.col("_rate") + F.col("_offset"))
    return (
        placed.withColumn("_rate", rate)
        .withColumn("_offset", offset_of(F.col("source"), seed))
        .withColumn("_copies", (line(place) - line(place - 1)).cast("int"))
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, ``size, source_size, target, copies, taken`` (texts are not moved)."""
    planned = _planned(
        docs, id_col, source_col, word_count(col(text_col)), [id_col], weights, share, max_repeats, seed
    )
    return planned.select(
        F.col("_row").getField(id_col).alias(id_col),
        "size",
        "source_size",
        "target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size")).cast("long").alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """The mixed documents: every column of ``docs``, one row per copy taken."""
    planned = _planned(
        docs, id_col, source_col, word_count(col(text_col)), docs.columns, weights, share, max_repeats, seed
    )
    repeated = planned.where(F.col("_copies") > 0).select(
        "_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    )
    return repeated.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def oracle(seed: str = SEED) -> str:
    """DuckDB SQL for ``mix_plan`` over ``documents`` with the default weights."""
    return f"""
WITH rows AS (
  SELECT doc_id, source, coalesce(cast(doc_id AS VARCHAR), '') AS id,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM documents),
sizes AS (
  SELECT source, cast(sum(size) AS BIGINT) AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM rows GROUP BY source),
caps AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio,
    sum(source_size) OVER () * 1.5::DOUBLE AS total FROM sizes),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM caps),
goals AS (
  SELECT source, source_size, least(cap, coalesce(weight *
    (SELECT max(level) FROM levels WHERE ratio > level), cap)) AS target FROM levels),
placed AS (
  SELECT r.doc_id, r.size, g.source_size, g.target,
    row_number() OVER (PARTITION BY r.source ORDER BY r.size, substr(md5(r.id), 1, 2), r.id) AS place,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('{seed}:' || coalesce('s' || r.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, cast(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
  cast(floor(place * rate + u) - floor((place - 1) * rate + u) AS INTEGER) AS copies,
  cast((floor(place * rate + u) - floor((place - 1) * rate + u)) * size AS BIGINT) AS taken
FROM placed"""
