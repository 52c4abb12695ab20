"""Per-customer 0 -> 1 transitions against a brute-force sort and scan."""

import random

from campaignlens.operators import labels


def _brute(rows):
    by = {}
    for key, cust, life, y in rows:
        if cust is not None:
            by.setdefault(cust, []).append((life is None, life if life is not None else 0, key, y))
    out = {}
    for cust, items in by.items():
        items.sort()
        ys = [it[3] for it in items]
        out[cust] = int(any(a == 0 and b == 1 for a, b in zip(ys, ys[1:])))
    return out


def test_transitions_equal_brute_force_with_extreme_keys(spark):
    rnd = random.Random(5)
    lives = [None, -2**31, -5, 0, 7, 365, 2**31 - 1]
    keys = sorted({rnd.randrange(-2**62, 2**62) for _ in range(400)}) + [-2**63, 2**63 - 1]
    rows = [(k, rnd.choice(["a", "b", "c", None]), rnd.choice(lives), rnd.randint(0, 1)) for k in keys]
    df = spark.createDataFrame(rows, "rating_account_id long, customer_id string, contract_lifetime_days int, "
                                     "has_done_upselling int")
    got = {r.customer_id: r.has_transition_0_to_1 for r in labels.customer_transitions(df).collect()}
    assert got == _brute(rows)


def test_label_shift_keeps_contracts_without_customer(spark):
    rows = [(1, "a", 10, 0), (2, "a", 20, 1), (3, None, 5, 0), (4, None, 6, 1), (5, "b", None, 1)]
    df = spark.createDataFrame(
        rows, "rating_account_id long, customer_id string, contract_lifetime_days int, has_done_upselling int"
    )
    got = {r.rating_account_id: (r.prev_label, r.transition_0_to_1) for r in labels.label_shift(df).collect()}
    assert got == {1: (None, 0), 2: (0, 1), 3: (None, 0), 4: (None, 0), 5: (None, 0)}
