"""Label history per customer: 0 -> 1 transitions across contracts.

Contracts of a customer are ordered by lifetime (then account, to make the
order total).  A customer has a 0 -> 1 transition between consecutive
contracts exactly when some 0 comes before some 1 (take the last 0 before
that 1: its successor is a 1).  So the per-customer flag is a plain
aggregate, ``min(order of 0s) < max(order of 1s)``, with partial
aggregation and no per-customer sort, however many contracts one customer
holds.  The row-level previous label uses the distributed lag.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens import schemas as S
from campaignlens.operators.joins import hot_key_left_join, hot_keys_from_counts
from campaignlens.operators.rank import with_previous

ORDER_COLUMNS = ["contract_lifetime_days", S.KEY]
CONTRACT_VIEW = S.CONTRACT_VIEW


def _order_key():
    """(missing lifetime last, lifetime, account) as one ``decimal(38,0)``.

    The int lifetime shifted by 2^31 is below 10^10 and the long account
    shifted by 2^63 below 10^20, so ``missing * 10^30 + lifetime' * 10^20 +
    account'`` keeps the lexicographic order exactly.  A decimal is a
    fixed-width aggregation buffer, so ``min``/``max`` over it are hash
    aggregates (a struct key would force a sort-based aggregate).
    """
    dec = "decimal(38,0)"

    def big(n: int) -> Column:
        return F.lit(Decimal(n)).cast(dec)

    life = F.col("contract_lifetime_days").cast("int")
    missing = F.when(life.isNull(), F.lit(1)).otherwise(F.lit(0)).cast(dec) * big(10 ** 30)
    life_part = (F.coalesce(life, F.lit(0)).cast("long") + F.lit(2 ** 31)).cast(dec) * big(10 ** 20)
    key_part = F.col(S.KEY).cast("long").cast(dec) + big(2 ** 63)
    return (missing + life_part + key_part).cast(dec)


def customer_transitions(core: DataFrame, label: str = S.LABEL, with_rows: bool = False) -> DataFrame:
    """``(customer_id, has_transition_0_to_1)`` with the flag as 0/1.

    ``with_rows`` adds ``n_rows``, the customer's contract count (same
    aggregate), which the joins back to the contracts use to find hot
    customers without another pass.
    """
    key = _order_key()
    agg = core.where(F.col(S.CUSTOMER).isNotNull()).groupBy(S.CUSTOMER).agg(
        F.min(F.when(F.col(label) == 0, key)).alias("_first0"),
        F.max(F.when(F.col(label) == 1, key)).alias("_last1"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    flag = F.coalesce(F.col("_first0") < F.col("_last1"), F.lit(False)).cast("int")
    return agg.select(S.CUSTOMER, flag.alias("has_transition_0_to_1"), *(["n_rows"] if with_rows else []))


def label_shift(core: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Each contract with the previous contract's label of the same customer
    and the row-level 0 -> 1 flag.  A contract without a customer stays, with
    no previous label."""
    base = core.select(S.KEY, S.CUSTOMER, "contract_lifetime_days", label)
    order = [F.col("contract_lifetime_days").isNull(), F.col("contract_lifetime_days"), F.col(S.KEY)]
    shifted = with_previous(base, [S.CUSTOMER], order, [label], prefix="prev_")
    previous = F.when(F.col(S.CUSTOMER).isNotNull(), F.col(f"prev_{label}"))
    flag = F.coalesce((previous == 0) & (F.col(label) == 1), F.lit(False)).cast("int")
    return shifted.select(
        S.KEY, S.CUSTOMER, "contract_lifetime_days", label,
        previous.alias("prev_label"), flag.alias("transition_0_to_1"),
    )


def _contracts_with_flag(core: DataFrame) -> DataFrame:
    """Every contract with its customer's flag (n:1, hot customers salted)."""
    flags = customer_transitions(core, with_rows=True)
    hot = hot_keys_from_counts(flags, S.CUSTOMER, "n_rows")
    return hot_key_left_join(core.select(*CONTRACT_VIEW), flags.drop("n_rows"), S.CUSTOMER, hot=hot)


def transition_contracts(core: DataFrame) -> DataFrame:
    """Contract view right-joined with the customer flag (every contract kept).

    Written as the contracts' left join with the per-customer flag, so a
    customer with a third of the contracts is spread by salting.
    """
    joined = _contracts_with_flag(core)
    rest = [c for c in CONTRACT_VIEW if c != S.CUSTOMER]
    return joined.select(S.CUSTOMER, "has_transition_0_to_1", *rest)


def transition_members(core: DataFrame) -> DataFrame:
    """Contracts of customers with a transition (no id list).

    A semi join with the movers equals the left join with the one-row-per-
    customer flag filtered on the flag; the left join is salted for hot
    customers.
    """
    return _contracts_with_flag(core).where(F.col("has_transition_0_to_1") == 1).select(*CONTRACT_VIEW)
