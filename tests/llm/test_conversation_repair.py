"""Branch and bound against enumeration and a forward pass; the whole report against plain Python."""

import hashlib
import random
import re
import zlib
from functools import cmp_to_key

import pytest
from pyspark.sql import types as T

from campaignlens.llm import conversation_repair as cr

LAYOUT = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def enumerated(rows):
    """Least (cost, audit) by trying every edit of every row with up to two inserts before it and at the end."""
    best = None

    def go(i, roles, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for inserts in ("", "u", "a", "ua", "au"):
            more, now = cost + 2 * len(inserts), audit + "I" * len(inserts)
            if i == len(rows):
                if LEGAL.match(roles + inserts) and (best is None or (more, now) < best):
                    best = (more, now)
                continue
            initial, must_go, cut = rows[i]
            go(i + 1, roles + inserts, more + 3, now + "D")
            if not must_go:
                go(i + 1, roles + inserts + (initial or "?"), more + cut, now + "K")
                for role in "ua":
                    go(i + 1, roles + inserts + role, more + cut + 2, now + "R")

    go(0, "", 0, "")
    return best


def forward(rows):
    """Least (cost, audit) by a pass over (row, state) that keeps the best path of every state."""
    best = {cr.START: (0, "")}
    for row in rows:
        step = {}
        for state, (cost, audit) in best.items():
            for edits, c, nxt in cr._choices(state, row):
                path = (cost + c, audit + edits)
                step[nxt] = min(step.get(nxt, path), path)
        best = step
    return min((c + cr.ENDS[s][0], a + cr.ENDS[s][1]) for s, (c, a) in best.items())


def some_rows(rnd, n, initials="sua "):
    return [(rnd.choice(initials), rnd.random() < 0.2, False) if rnd.random() < 0.6 else (rnd.choice("ua"), False, rnd.random() < 0.5)
            for _ in range(n)]


def test_search_equals_enumeration():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4):
        for k in range(120 if n < 4 else 40):
            rows = some_rows(rnd, n, "sua " if k % 2 else "s ")
            assert cr.search(rows, cr.START, cr.ENDS) == enumerated(rows), rows


def test_search_equals_a_forward_pass_and_expands_few_nodes():
    rnd = random.Random(2)
    for n in (10, 50, 400, 2000):
        for initials in ("ua", "sua ", "s", "su"):
            rows = some_rows(rnd, n, initials)
            expanded = 0

            def tick():
                nonlocal expanded
                expanded += 1

            assert cr.search(rows, cr.START, cr.ENDS, tick) == forward(rows)
            assert expanded <= 12 * (n + 2)


def test_bounds_never_exceed_the_rest():
    rnd = random.Random(3)
    for _ in range(200):
        rows = some_rows(rnd, rnd.randrange(1, 8))
        bounds = cr.suffix_bounds(rows, cr.ENDS)
        for i in range(len(rows) + 1):
            for s in cr.STATES:
                assert bounds[i][s] <= cr.search(rows[i:], s, cr.ENDS)[0]


def test_blocks_chain_to_the_whole():
    rnd = random.Random(4)
    for _ in range(60):
        rows = some_rows(rnd, rnd.randrange(2, 30))
        cuts = sorted(rnd.sample(range(len(rows) + 1), 2))
        parts = [rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]]
        table = cr.block_table(parts[0])
        for p in parts[1:]:
            table = cr.chain(table, cr.block_table(p))
        assert cr.finish(table) == cr.search(rows, cr.START, cr.ENDS)


def in_order(a, b):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest())

    return (key(a) > key(b)) - (key(a) < key(b))


def plain_report(rows, damage=True):
    """The report of a list of conversation rows."""
    spaces = " \t\n\x0b\x0c\r"
    by_conv = {}
    for conv, turn, role, text in rows:
        mine = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in by_conv.items():
        mine.sort(key=cmp_to_key(in_order))
        turns = {t for t, *_ in mine if t is not None}
        seen, judged = set(), []
        count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in mine:
            last = text.rstrip(spaces)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = forward(judged)
        fixed, at, state = [], 0, "a"
        for edit in audit:
            if edit in "IR":
                state = "a" if state == "u" else "u"
                fixed.append(("user" if state == "u" else "assistant", "" if edit == "I" else mine[at][2]))
            elif edit == "K":
                state = mine[at][1][:1]
                fixed.append(mine[at][1:])
            at += edit != "I"
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **count, "illegal": illegal, "cost": cost,
            "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest(),
            "_rows": fixed,
        }
    return out


def reported(spark, rows, damage=True):
    table = spark.createDataFrame(rows, LAYOUT).repartition(4)
    found = cr.damaged(table) if damage else cr.whole(table)
    cr.prepare(spark)
    got = cr.repaired_digests(found, cr.solve(found)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in got}


def without_rows(report):
    return {c: {k: v for k, v in r.items() if k != "_rows"} for c, r in report.items()}


def conversation_rows(rnd, convs, longest=9):
    rows = []
    for c in range(convs):
        for t in range(rnd.randrange(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rnd.choice(["Yes.", "No!", "Why?", "cut off", "", " \n", None, "é.\n ", f"text {t}.", "x "])
            rows.append((c if rnd.random() < 0.97 else None, t if rnd.random() < 0.9 else None, role, text))
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_report_equals_plain_python(spark, damage):
    rows = conversation_rows(random.Random(11), 120)
    rows += rows[:10]  # repeated rows
    assert reported(spark, rows, damage) == without_rows(plain_report(rows, damage))


def test_long_conversation_spans_tasks_and_blocks(spark, monkeypatch):
    rnd = random.Random(12)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", "", f"{t}!"])) for t in range(1500)]
    rows += conversation_rows(rnd, 20)
    table = spark.createDataFrame(rows, LAYOUT)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = cr.store(cr.solved_pieces(cr.cells(cr.damaged(table))))
        assert pieces.where("conv_id = 7 AND NOT closed").count() > 2
        assert reported(spark, rows) == without_rows(plain_report(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_copies_of_one_row(spark):
    rows = [(1, 3, "user", "same.")] * 3000 + [(1, 4, "assistant", "ok.")] + [(None, None, None, None)] * 500
    assert reported(spark, rows) == without_rows(plain_report(rows))
    cells = cr.cells(cr.damaged(spark.createDataFrame(rows, LAYOUT)))
    assert cells.count() <= 3


def test_conversation_without_rows_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = reported(spark, [(gone, 0, "user", "x")])
    empty = hashlib.sha256(b"").hexdigest()
    assert found == {gone: {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                            "repaired_sha256": empty}}
    assert reported(spark, []) == {}


def test_repaired_rows_and_extra_columns(spark):
    rows = conversation_rows(random.Random(13), 40) + [(900, 0, "user", "long " * 200_000 + ".")]
    table = spark.createDataFrame(rows, LAYOUT).selectExpr("*", "1 AS times", "2 AS cost", "map(1, 2) AS audit", "3 AS digest")
    got = {}
    for r in cr.repair(table).orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: r["_rows"] for c, r in plain_report(rows, damage=False).items() if r["_rows"]}
    for found in got.values():
        assert LEGAL.match("".join(role[:1] for role, _ in found))
