"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


_NUMBER = r"^[+-]?(?:(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))$"
_INFINITY = r"^[+-]?(?i:inf|infinity)$"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_numeric(c: str | Column) -> Column:
    """Text to double the way a lenient numeric parse does it.

    Only decimal numbers and infinities count: the cast alone would also take
    Java suffixes (``1d``, ``2F``).  Unparsable text, ``NaN`` and numbers
    beyond the range of a double become null, so that they cannot poison
    ``avg``/``median``.
    """
    text = F.trim(col_(c).cast("string"))
    x = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    in_range = ~x.isin(float("inf"), float("-inf")) | text.rlike(_INFINITY)
    return F.when(~F.isnan(x) & in_range, x)


def missing_flag(c: str | Column) -> Column:
    """1 where the value is missing, else 0."""
    return col_(c).isNull().cast("int")


def membership_flag(c: str | Column, values: Sequence) -> Column:
    """1 where the value is in ``values``; null counts as not a member."""
    return F.coalesce(col_(c).isin(list(values)), F.lit(False)).cast("int")


def bucketize(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed interval buckets ``(edges[i], edges[i+1]] -> labels[i]``.

    Values outside every interval (and nulls) give null, as an interval cut
    does; ``Bucketizer`` is left-closed and rejects out-of-range values.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    x = col_(c)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def one_hot(
    c: str, levels: Sequence[str], drop_first: bool = True, prefix: str | None = None
) -> list[Column]:
    """Indicator columns ``{prefix}_{level}`` (int 0/1) for a categorical.

    ``levels`` is the domain in category order; the first one is skipped with
    ``drop_first``.  A missing value gives zeros in every indicator, and every
    level gets a column even if the data never shows it.
    """
    prefix = prefix or c
    kept = list(levels)[1:] if drop_first else list(levels)
    return [
        F.coalesce(F.col(c) == F.lit(level), F.lit(False)).cast("int").alias(f"{prefix}_{level}")
        for level in kept
    ]


def contains_pattern(c: str | Column, pattern: str) -> Column:
    """Case-insensitive regex search; a missing value does not match."""
    return F.coalesce(col_(c).rlike(f"(?i){pattern}"), F.lit(False))


def ratio_fill_zero(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with 0/0 -> 0.0 and x/0 -> +inf for x > 0.

    That is what a float division followed by filling NaN with 0 yields; it
    avoids the ANSI division-by-zero error.
    """
    n, d = col_(num).cast("double"), col_(den).cast("double")
    return (
        F.when(d != 0, n / d)
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .otherwise(F.lit(0.0))
    )


def clip(c: str | Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col_(c), F.lit(lo)), F.lit(hi))
