"""Group-disjoint stratified folds, class weights and id-level set operations.

Folds: every customer is one group.  Customers with a large share of a fold
are placed first, each into the emptiest fold.  The others are ordered by
(positives desc, contracts desc, md5(seed:id), id) with the distributed
rank, and dealt to folds in a snake (0..k-1, k-1..0, ...), or, after heavy
customers, in rounds that fill the room left in each fold.  Each stratum
(positives, contracts) is a contiguous run of that order, so each fold gets
its share of every stratum: label-balanced, and no customer spans two
folds.  A contract without a customer is a group of its own, so train and test
together hold every row.  The deal needs no group to sit in one task, whatever the size of
the dominant stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators.joins import hot_key_left_join, hot_keys_from_counts
from campaignlens.operators.rank import lookup, with_position
from campaignlens.sources.sinks import stage_roundtrip


def seeded_hash(c: str | Column, seed: int) -> Column:
    """Hex md5 of ``'{seed}:{value}'``; the same text in any SQL engine."""
    col = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


def snake_fold(position0: Column, k: int) -> Column:
    """Fold for a 0-based position when dealing back and forth over k folds."""
    r = position0 % k
    return F.when(F.floor(position0 / k) % 2 == 0, r).otherwise(F.lit(k - 1) - r).cast("int")


GROUP = "_group"


def group_key(group: str = S.CUSTOMER, key: str = S.KEY) -> Column:
    """A non-null group name: the customer, or the account where there is none."""
    own = F.concat(F.lit("account "), F.col(key).cast("string"))
    return F.coalesce(F.concat(F.lit("customer "), F.col(group).cast("string")), own)


# A group of more than this share of a fold is placed by itself, before the deal.
HEAVY_SHARE = 0.2
# Slots of one round of the deal.
DEAL_SLOTS = 1000


def place_heavy(heavy: Sequence[tuple[object, int, int]], k: int) -> tuple[dict, list[int]]:
    """Folds of the heavy groups ``(group, n_rows, n_pos)`` and the rows they bring to each fold.

    Largest first; each goes to the fold with the fewest rows so far, then the
    fewest positives, then the smallest number.
    """
    rows, positives, fold_of = [0] * k, [0] * k, {}
    for group, n, pos in heavy:
        f = min(range(k), key=lambda i: (rows[i], positives[i], i))
        fold_of[group] = f
        rows[f] += n
        positives[f] += pos
    return fold_of, rows


def room(loads: Sequence[int], rest: int) -> list[float]:
    """Rows each fold still takes when ``rest`` rows level the loads as far as they can."""
    order, level = sorted(loads), 0.0
    for i in range(len(order)):
        level = (sum(order[: i + 1]) + rest) / (i + 1)
        if i + 1 == len(order) or level <= order[i + 1]:
            break
    return [max(0.0, level - x) for x in loads]


def deal_slots(rooms: Sequence[float], slots: int = DEAL_SLOTS) -> list[int]:
    """Folds of a round of the deal, in turn: as many slots per fold as its share of the room, evenly spread.

    Shares are rounded to whole slots, the largest remainders first.
    """
    total = sum(rooms)
    exact = [r * slots / total for r in rooms]
    quota = [int(x) for x in exact]
    order = sorted(range(len(rooms)), key=lambda f: (-(exact[f] - quota[f]), f))
    for f in order[: slots - sum(quota)]:
        quota[f] += 1
    points = [((2 * j + 1) / (2 * q), f) for f, q in enumerate(quota) for j in range(q)]
    return [f for _, f in sorted(points)]


def customer_folds(
    df: DataFrame, k: int = S.N_FOLDS, seed: int = S.SPLIT_SEED, group: str = S.CUSTOMER, label: str = S.LABEL,
    key: str = S.KEY, heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """One row per group: ``(_group, group, n_rows, n_pos, fold)``; ``group`` is null for a lone contract.

    Groups with more rows than ``heavy_share`` of a fold (at most ``k /
    heavy_share`` of them) are placed first, the largest into the emptiest
    fold; the others are dealt in the order of their positives and rows, each
    fold as often as its room asks for.  Without heavy groups the deal is a
    snake.
    """
    per_group = stage_roundtrip(
        df.select(group_key(group, key).alias(GROUP), group, label)
        .groupBy(GROUP, group)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("n_pos")),
        "groups",
    )
    total = per_group.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    name = F.coalesce(F.col(group).cast("string"), F.col(GROUP))
    is_heavy = F.col("n_rows") * F.lit(float(k)) > F.lit(heavy_share * total)
    # At most k / heavy_share rows: every one holds more than that share of a fold.
    heavy = [
        (r[GROUP], r.n_rows, r.n_pos)
        for r in per_group.where(is_heavy).orderBy(F.desc("n_rows"), F.desc("n_pos"), seeded_hash(name, seed), GROUP).collect()
    ]
    order = [F.col("n_pos").desc(), F.col("n_rows").desc(), seeded_hash(name, seed).asc(), F.col(GROUP).asc()]
    columns = [GROUP, group, "n_rows", "n_pos"]
    if not heavy:
        ranked = with_position(per_group, order, name="_pos")
        return ranked.select(*columns, snake_fold(F.col("_pos") - 1, k).alias("fold"))
    fold_of, loads = place_heavy(heavy, k)
    rest = total - sum(loads)
    light = per_group.where(~is_heavy)
    placed = F.lit(None).cast("int")
    for g, f in fold_of.items():
        placed = F.when(F.col(GROUP) == F.lit(g), F.lit(f)).otherwise(placed)
    first = per_group.where(is_heavy).select(*columns, placed.alias("fold"))
    if not rest:
        return first
    turns = deal_slots(room(loads, rest))
    turn = lookup(turns, "int", ((F.col("_pos") - 1) % len(turns)).cast("int"))
    dealt = with_position(light, order, name="_pos").select(*columns, turn.alias("fold"))
    return first.unionByName(dealt)


def assign_folds(
    df: DataFrame, k: int = S.N_FOLDS, seed: int = S.SPLIT_SEED, group: str = S.CUSTOMER, label: str = S.LABEL
) -> DataFrame:
    """``df`` with a ``fold`` column; fold 0 is the test fold.

    The fold table has one row per group and is joined back on the group
    key (n:1, the same shape as the interaction merge).
    """
    return attach_folds(df, customer_folds(df, k, seed, group, label), group)


def attach_folds(df: DataFrame, folds: DataFrame, group: str = S.CUSTOMER, key: str = S.KEY) -> DataFrame:
    """Join the per-group fold table of ``customer_folds`` back (n:1, hot groups salted).

    The hot groups are read from the table's row counts instead of counting
    ``df`` again.
    """
    hot = hot_keys_from_counts(folds, GROUP, "n_rows")
    named = df.withColumn(GROUP, group_key(group, key))
    joined = hot_key_left_join(named, folds.select(GROUP, "fold"), GROUP, hot=hot)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], "fold")


def train_test(df_with_fold: DataFrame, test_fold: int = 0) -> dict[str, DataFrame]:
    """The four outputs of the split step as filters on the fold column."""
    test = df_with_fold.where(F.col("fold") == test_fold)
    train = df_with_fold.where(F.col("fold") != test_fold)
    return {
        "X_train": train.drop(S.LABEL),
        "X_test": test.drop(S.LABEL),
        "y_train": train.select(S.KEY, S.LABEL),
        "y_test": test.select(S.KEY, S.LABEL),
    }


def fold_balance(df_with_fold: DataFrame, label: str = S.LABEL, group: str = S.CUSTOMER) -> DataFrame:
    return df_with_fold.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(group).alias("n_customers"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"),
    )


def fold_leakage(df_with_fold: DataFrame, group: str = S.CUSTOMER) -> DataFrame:
    """Number of customers seen in more than one fold (must be 0); contracts without one cannot leak."""
    per = df_with_fold.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct("fold").alias("k"))
    return per.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(F.col("k") > 1).alias("n_customers_multi_fold"),
    )


def class_weights(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Balanced weights ``n / (n_classes * n_class)`` per label value."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # One pass over the rows: the window sees one row per label value.
    every = Window.partitionBy()
    total, n_classes = F.sum("n_class").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label, "n_class", (total / (n_classes * F.col("n_class"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = S.LABEL, name: str = "weight") -> DataFrame:
    """Attach the balanced weight per row (join with a frame of #classes rows)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(F.broadcast(w), on=label, how="left")


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).select(c).distinct()


def sample_exact(df: DataFrame, c: str, fraction: float, seed: int) -> DataFrame:
    """Exactly ``floor(n * fraction)`` distinct values, without replacement.

    Values are ordered by a seeded hash with the distributed rank and the
    first ``floor(n * fraction)`` are kept: reproducible, exact in size.
    """
    ids = distinct_values(df, c)
    n = ids.select(F.count(F.lit(1))).scalar()
    k = F.floor(n.cast("double") * F.lit(fraction))
    ranked = with_position(ids, [seeded_hash(c, seed).asc(), F.col(c).asc()], name="_pos")
    return ranked.where(F.col("_pos") <= k).select(c)


REPEAT_CHUNK = 1_000_000


def repeat_rows(df: DataFrame, times: str, name: str = "copy_no", chunk: int = REPEAT_CHUNK,
                num_partitions: int | None = None) -> DataFrame:
    """Each row ``times`` times, numbered 1..times (rows with times < 1 vanish).

    A row is first cut into chunks of at most ``chunk`` copies (one row per
    chunk, a small expansion), the chunk rows are hash-partitioned over
    ``num_partitions`` (default ``spark.sql.shuffle.partitions``; a numbered
    repartition, which AQE does not coalesce back), and each chunk expands
    in its own task.  A row asking for a third of all copies is thus
    produced by many tasks, never by one.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = F.col(times).cast("long")
    base = df.where(t >= 1)
    chunk_no = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(t / F.lit(chunk)).cast("long") - 1))
    chunked = base.select("*", chunk_no.alias("_chunk"))
    spread = chunked.repartition(n, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.col("_chunk")))
    lo = F.col("_chunk") * F.lit(chunk) + 1
    hi = F.least(t, (F.col("_chunk") + 1) * F.lit(chunk))
    return spread.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.sequence(lo, hi)).alias(name))


def month_spine(df: DataFrame, key: str, start: str, end: str, name: str = "billed_period_month_d") -> DataFrame:
    """Every distinct ``key`` with every month start in [start, end].

    A per-row generator over a fixed month list, not a join.
    """
    months = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 MONTH"))
    return distinct_values(df, key).select(key, F.explode(months).alias(name))
