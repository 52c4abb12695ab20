"""Filter interaction audit: what every order of the quality filters removes, from one pass over the texts.

A document's failures are a mask.  In an order of the filters it is removed at
the smallest position among the filters it fails: the min-plus product of the
mask matrix (0 where a filter fails, infinite elsewhere) with the matrix of
inverse permutations (the position of each filter in each order).  There are
two to the number of filters masks, so the table of removal steps is a
constant; documents enter only as weighted counts per part and mask, which are
scattered to the steps.

Filters: A few words, B few distinct words, C many capitals, D a symbol, E a
copy of a document with a smaller id (table-wide, removed or not).

Defined cases: a null text is empty; an empty text has no words, so it fails A
and, as a copy of every other empty text, E; very long texts are measured in
blocks and by a digest; rows that repeat an id with its text are neither
smaller nor larger than each other; a null id is no copy of anything and its
text makes no copies; a null source is the empty string; where an id has
several labels, a label holds if one of them says so; an empty table gives no
row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, prepare

# The filters' letters, thresholds and symbols.
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
_COPY_BIT = 1 << FILTERS.index("E")
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[65:91] = True
_WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def removal_steps(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All orders, each filter's position in them, and the removal step of every mask in every order.

    Positions and steps count from 0; a mask without failures has step ``n_filters``.
    """
    orders = list(permutations(range(n_filters)))
    position = np.argsort(np.array(orders), axis=1)  # the inverse permutations: (orders, filters)
    masks = np.arange(1 << n_filters)
    fails = (masks[:, None] >> np.arange(n_filters)) & 1 == 1
    cost = np.where(fails, 0, n_filters)  # (masks, filters), n_filters stands for infinity
    steps = np.min(cost[:, None, :] + position[None, :, :], axis=2)
    return orders, position, np.minimum(steps, n_filters)


def interactions(counts: np.ndarray, n_filters: int) -> dict[str, np.ndarray]:
    """The audit of one part from its weighted counts ``(weights, masks)``; arrays ``(orders, steps)``."""
    orders, _, steps = removal_steps(n_filters)
    order = np.array(orders)
    shape = (len(orders), n_filters + 1)
    cell = (np.arange(len(orders))[None, :] * shape[1] + steps).ravel()  # the removal cell of (mask, order)
    lost = [
        np.bincount(cell, np.repeat(w, len(orders)), shape[0] * shape[1]).reshape(shape)[:, :n_filters] for w in counts
    ]
    removed, good, toxic = (x.astype(np.int64) for x in lost)
    total = int(counts[0].sum())
    masks = np.arange(1 << n_filters)
    failing = np.array([counts[0][(masks >> f) & 1 == 1].sum() for f in range(n_filters)], np.int64)
    unique = np.array([counts[0][1 << f] for f in range(n_filters)], np.int64)
    by_filter = np.bincount(order.ravel(), removed.ravel(), n_filters).astype(np.int64)
    return {
        "kept": total - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": failing[order] - removed,
        "unique_fails": unique[order],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": by_filter[order],
    }


def text_masks(column: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that every text fails."""
    raw, offsets = textops.text_buffers(column)
    out = np.zeros(len(offsets) - 1, np.int32)
    for a, b in textops.blocks(offsets):
        bounds = offsets[a : b + 1]
        words, _, _, at = textops.word_spans(raw, bounds)
        n = np.diff(at)
        _, distinct_at = textops.distinct_by_row(words, textops.owners(at), b - a)
        block, cut = raw[bounds[0] : bounds[-1]], bounds - bounds[0]

        def per_row(hit: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(hit)])
            return run[cut[1:]] - run[cut[:-1]]

        points = per_row((block & 0xC0) != 0x80)
        fails = [
            n < MIN_WORDS,
            100 * np.diff(distinct_at) < DISTINCT_PERCENT * n,
            100 * per_row(_IS_CAPITAL[block]) > CAPITAL_PERCENT * points,
            per_row(_IS_SYMBOL[block]) > 0,
        ]
        out[a:b] = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
    return out


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``(doc_id, part, digest, mask)``: the filters a text fails by itself, and a 128-bit digest of the text."""
    prepare(docs.sparkSession)
    source = docs.select(
        col(id_col).alias("doc_id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"), col(text_col).alias("t")
    )
    schema = T.StructType([
        source.schema["doc_id"],
        T.StructField("part", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("mask", T.IntegerType()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = textops.text_buffers(batch.column(2))
            view = memoryview(np.ascontiguousarray(raw))
            digests = [
                hashlib.md5(view[a:b], usedforsecurity=False).digest()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(text_masks(batch.column(2)))],
                names=schema.names,
            )

    return map_batches(source, task, schema)


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents per part and mask, and those labelled good or toxic.

    ``rows`` come from ``measured``; ``labels`` are ``(doc_id, quality, toxic)``.
    Repeated rows are counted before any join, so copies of one document, one
    text or one source never meet in one task as rows.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    per_document = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    labelled = per_document.join(known, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    # A cell holds the equal texts of one part with equal labels: its count, and the rows with its smallest id.
    cells = labelled.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min("doc_id").alias("first_id"),
        F.min_by("n", "doc_id").alias("first_n"),
    )
    # One row per part and labels of a text, however many copies it has.
    least = F.min("first_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first_id") == F.col("_least"), F.col("first_n")).otherwise(F.lit(0))
    kept = F.col("nameless") + own
    split = cells.withColumn("_least", least).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), kept.alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(_COPY_BIT)).alias("mask"), (F.col("n") - kept).alias("n")),
        )),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def order_table(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """The audit ``(part, filter_order, step, kept, removed, ...)`` from ``(part, mask, n, good, toxic)``.

    A part has at most two to the number of filters masks, gathered in one row;
    the scatter over the orders runs in array form, a batch of parts at a time.
    """
    k = len(names)
    cells = F.array_sort(F.collect_list(F.struct("mask", *_WEIGHTS)))
    parts = counts.groupBy("part").agg(cells.alias("cells"))
    schema = T.StructType([
        T.StructField("part", T.StringType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
    ])
    orders, _, _ = removal_steps(k)
    labels = ["".join(names[f] for f in o) for o in orders]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_column = pa.array(np.repeat(np.array(labels, object), k), pa.string())
        step_column = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))
        for batch in batches:
            for part, cells_of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                weighted = np.zeros((len(_WEIGHTS), 1 << k), np.int64)
                for c in cells_of:
                    weighted[:, c["mask"]] = [c[w] for w in _WEIGHTS]
                found = interactions(weighted, k)
                columns = [pa.array([part] * len(order_column), pa.string()), order_column, step_column]
                columns += [pa.array(found[c].ravel(), pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(parts, task, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs (doc_id, text, source)`` with ``labels (doc_id, quality, toxic)``."""
    return order_table(mask_counts(measured(docs), labels))


def oracle() -> str:
    """DuckDB text of the registered query."""
    return r"""
WITH letters AS (SELECT unnest(['A','B','C','D','E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
least AS (SELECT text, min(doc_id) AS lo FROM texts GROUP BY text),
lab AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
        FROM labels GROUP BY doc_id),
docs AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (CASE WHEN len(w.w) < 50 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w.w)) < 65 * len(w.w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * len(w.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN w.doc_id > m.lo THEN 'E' ELSE '' END) AS fails
  FROM words w LEFT JOIN least m ON w.text = m.text LEFT JOIN lab l ON w.doc_id = l.doc_id),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, fails),
steps AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS f FROM orders, range(1, 6) r(s)),
cells AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN contains(fails, f) AND NOT before THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND before THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND NOT before THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND NOT before THEN toxic ELSE 0 END) AS toxic_lost,
    sum(n) AS total
  FROM (SELECT s.filter_order, s.step, s.f, m.*,
          len(translate(m.fails, substr(s.filter_order, 1, s.step - 1), '')) < len(m.fails) AS before
        FROM steps s, masks m) m
  GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step) AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM cells
"""
