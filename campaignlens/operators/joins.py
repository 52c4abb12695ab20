"""n:1 left join that spreads hot keys over several reducers (salting).

The right side is unique on the key (one row per customer); the left side
may hold a third of its rows under one key.  One rule holds at every size: a
key with more left rows than one shuffle partition gets on average
(``rows / partitions``) is hot and gets as many salts as it fills such
partitions.  At most ``partitions`` keys can be hot and their salts add up to
at most twice that, a bound set by the cluster's partition number and not by
the data, so the list is broadcast.  Left rows of a hot key get a salt from a
hash of the row, the right row of a hot key is repeated once per salt, and the
join runs on ``(key, salt)``: one shuffle, the left side evaluated once, and no
reducer receives much more than its share of a key.  Other keys keep salt 0.
Every row meets exactly its own right row, so the result is the plain left
join.  Rows without a key match nothing; they get a salt from a row hash too,
so they spread over all reducers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = "_rows"
HOT_SALTS = "_salts"
# Salts of the rows without a key; more than any cluster has reducers.
_NULL_SALTS = 1 << 20


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys_from_counts(counts: DataFrame, key: str, count_col: str, partitions: int | None = None) -> DataFrame:
    """Hot keys ``(key, _rows, _salts)`` from a per-key count table (one row per key).

    Callers that already hold per-key row counts (the fold table has one row
    per customer with its contract count) pass them here instead of counting
    the left side again.
    """
    n = partitions or shuffle_partitions(counts)
    counts = counts.where(F.col(key).isNotNull()).select(key, F.col(count_col).cast("long").alias(HOT_ROWS))
    filled = F.col(HOT_ROWS) * F.lit(n) / counts.select(F.sum(HOT_ROWS)).scalar()
    return counts.where(filled > 1).withColumn(HOT_SALTS, F.ceil(filled).cast("int"))


def hot_keys(left: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Keys holding more left rows than an average shuffle partition, with their salts."""
    return hot_keys_from_counts(left.groupBy(key).agg(F.count(F.lit(1)).alias("_c")), key, "_c", partitions)


def hot_key_left_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None = None,
                      partitions: int | None = None) -> DataFrame:
    """``left.join(right, key, "left")`` with hot keys salted by their size.

    ``right`` must be unique on ``key``.  Columns come out as the plain
    join's: the key, then the left columns, then the right columns.
    ``hot`` is an optional hot-key list from ``hot_keys`` or
    ``hot_keys_from_counts`` computed from a cheaper source than ``left``
    itself, for example the base table ``left`` was derived from by 1:1 joins.
    Any key list gives the same rows; the list only decides which keys are
    spread and how widely.
    """
    if hot is None:
        hot = hot_keys(left, key, partitions)
    hot = F.broadcast(hot.select(key, HOT_SALTS))  # at most one row per shuffle partition
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    # The row hash is evaluated for rows of hot keys, and of missing ones: they match nothing, so any salt will do.
    spread = F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(_NULL_SALTS))).otherwise(F.lit(0))
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col(HOT_SALTS).isNotNull(), F.pmod(row_hash, F.col(HOT_SALTS))).otherwise(spread).cast("int")
    ).drop(HOT_SALTS)
    salts = F.when(F.col(HOT_SALTS).isNotNull(), F.sequence(F.lit(0), F.col(HOT_SALTS) - 1)).otherwise(
        F.array(F.lit(0))
    )
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop(HOT_SALTS)
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")
