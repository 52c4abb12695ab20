"""Repair of conversation structure at the least cost, by depth-first branch and bound.

A conversation should read ``(s?(ua)+)?`` in role initials: an optional system
turn, then user and assistant in turn.  Edits: keep a row (K, 0), give it the
role user or assistant (R, 2), delete it (D, 3; the only choice for blank and
duplicate rows), insert an empty user or assistant row (I, 2); a truncated row
that stays costs 1 more.  Wanted are the least cost and, among equal costs,
the audit (the edits' initials in order) that comes first in ASCII.

The search keeps an explicit stack of prefixes.  A prefix is cut when its cost
plus a lower bound of the rest exceeds the incumbent, or equals it with a
later audit; a table per node (row, grammar state) drops a prefix that reaches
a node with a worse (cost, audit) than an earlier one.  The bound is the exact
rest cost under a looser grammar in which a system turn may stand alone, so
the search rarely leaves the optimal path, and it ends only when every open
prefix is cut: then the incumbent is proved optimal.

Scale.  Rows become small cells (no text) that are counted before any shuffle,
so copies of one row never meet as rows.  Cells are dealt over the tasks by
ranges of (conversation, turn), so one long conversation spans many tasks; a
task solves its blocks of a conversation for every entry and exit state, and
the blocks are chained.  Texts are shuffled once, for the digest of the
repaired conversation, which runs through it row by row.

Defined cases: a null role or text is one space, in the key of the damage a
null id or turn too; a null conversation id is a conversation; rows of one
turn (null turns first) are ordered by role, then by the text's MD5; repeated
rows count as duplicates; empty and very long texts are judged whole; a role
other than system, user and assistant cannot be kept; a conversation without
rows has zeros, no edits and the digest of nothing; an empty table gives no
row; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.llm.common import col, map_batches, prepare, store

# The edits' costs.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# What is missing at the end of a conversation in each state.
MISSING = ("", "II", "I", "")
ENDS = {s: (INSERT * len(MISSING[s]), MISSING[s]) for s in STATES}
# Rows of a block: longer conversations are solved block by block.
BLOCK = 512
_INF = 1 << 60

# A row of a block: role initial, whether it must go, whether it is truncated.
Row = tuple[str, bool, bool]
Path = tuple[int, str]


@lru_cache(maxsize=4096)
def _choices(state: int, row: Row) -> list[tuple[str, int, int]]:
    """``(edits, cost, next state)`` for one row.

    Inserts stand right before the row they serve: an insert before a deleted
    row can follow it at the same cost and gives an earlier audit.  Inserting
    before a row that gets a new role costs more than deleting the row, but for
    a row after the system turn, which must be followed by a pair.
    """
    initial, must_go, truncated = row
    out = [("D", DELETE, state)]
    if must_go:
        return out
    extra = TRUNCATED if truncated else 0
    if initial == "s" and state == START:
        out.append(("K", extra, SYSTEM))
    if initial in ("u", "a"):
        reached = USER if initial == "u" else ASSISTANT
        if (initial == "a") == (state == USER):
            out.append(("K", extra, reached))
        else:
            out.append(("IK", INSERT + extra, reached))
    elif state == SYSTEM:
        out.append(("IR", INSERT + REROLE + extra, ASSISTANT))
    new = ASSISTANT if state == USER else USER
    if initial != "ua"[new - USER]:
        out.append(("R", REROLE + extra, new))
    return out


# The states of the looser grammar, where a system turn counts like a finished pair.
_LOOSE = (START, ASSISTANT, USER, ASSISTANT)


def suffix_bounds(rows: list[Row], ends: dict[int, Path]) -> list[list[int]]:
    """Lower bounds of the cost from (row, state) to the end: exact costs in the looser grammar.

    Where only one exit state will do (a block of a longer conversation), all
    four states are told apart.
    """
    merged = _LOOSE if len(ends) > 1 else tuple(STATES)
    last = [_INF] * 4
    for s, (cost, _) in ends.items():
        last[merged[s]] = min(last[merged[s]], cost)
    bounds = [[last[merged[s]] for s in STATES]]
    for row in reversed(rows):
        after = bounds[-1]
        now = [min(cost + after[nxt] for _, cost, nxt in _choices(s, row)) for s in STATES]
        bounds.append([now[merged[s]] for s in STATES])
    bounds.reverse()
    return bounds


def search(rows: list[Row], entry: int, ends: dict[int, Path], count: Callable[[], None] | None = None) -> Path | None:
    """The least ``(cost, audit)`` from state ``entry`` through ``rows`` to one of ``ends``; null if there is none.

    ``ends`` maps an exit state to the cost and audit of what must follow.
    ``count`` is called for every node expanded.
    """
    bounds = suffix_bounds(rows, ends)
    best: Path | None = None
    seen: dict[tuple[int, int], Path] = {}
    stack: list[tuple[int, int, int, str]] = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bounds[i][state]
        if least >= _INF:
            continue
        if best is not None and (least > best[0] or (least == best[0] and audit > best[1][: len(audit)])):
            continue
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[i, state] = (cost, audit)
        if count is not None:
            count()
        if i == len(rows):
            if state in ends:
                more, tail = ends[state]
                whole = (cost + more, audit + tail)
                if best is None or whole < best:
                    best = whole
            continue
        nodes = [(i + 1, nxt, cost + c, audit + edits) for edits, c, nxt in _choices(state, rows[i])]
        # The most promising prefix on top: least bound, then earliest audit.
        nodes.sort(key=lambda n: (n[2] + bounds[n[0]][n[1]], n[3]), reverse=True)
        stack.extend(nodes)
    return best


def block_table(rows: list[Row]) -> dict[tuple[int, int], Path]:
    """The least path of a block for every entry and exit state that it can join."""
    table = {}
    for a in STATES:
        for b in STATES:
            path = search(rows, a, {b: (0, "")})
            if path is not None:
                table[a, b] = path
    return table


def chain(head: dict[tuple[int, int], Path], block: dict[tuple[int, int], Path]) -> dict[tuple[int, int], Path]:
    """Paths through ``head`` and then ``block``."""
    out: dict[tuple[int, int], Path] = {}
    for (a, m), (c1, t1) in head.items():
        for (n, b), (c2, t2) in block.items():
            if m == n:
                path = (c1 + c2, t1 + t2)
                if (a, b) not in out or path < out[a, b]:
                    out[a, b] = path
    return out


def finish(table: dict[tuple[int, int], Path]) -> Path:
    """The whole conversation's path: from the start, with what is missing at the end."""
    return min((cost + ENDS[b][0], audit + ENDS[b][1]) for (a, b), (cost, audit) in table.items() if a == START)


# -- rows and cells ---------------------------------------------------------------------------------------------

_SPACES = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, times)`` after the damage; dropped rows have ``times`` 0, repeated ones 2."""
    plain = conversations.select(col("conv_id").alias("conv_id"), col("turn").alias("turn"), col("role").alias("role"), col("text").alias("text"))
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return plain.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def whole(conversations: DataFrame) -> DataFrame:
    """``damaged``'s layout without any damage: the conversations as they are."""
    space = F.lit(" ")
    return conversations.select(
        col("conv_id").alias("conv_id"), col("turn").alias("turn"), F.coalesce(col("role"), space).alias("role"),
        F.coalesce(col("text"), space).alias("text"), F.lit(1).alias("times"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


_KEYS = ["conv_id", "turn", "role", "digest"]
_OK, _BLANK, _CUT = range(3)


def cells(rows: DataFrame) -> DataFrame:
    """Equal rows as one cell ``(conv_id, turn, role, digest, kind, copies, first)``, without texts.

    ``first`` tells that no earlier row of the conversation has the same role
    and text.  A dropped row leaves a cell without copies, so that its
    conversation is known.
    """
    final = F.substring(F.rtrim(F.col("text"), F.lit(_SPACES)), -1, 1)
    kind = F.when(final == "", _BLANK).when(final.isin(".", "!", "?"), _OK).otherwise(_CUT)
    gone = F.col("times") == 0
    none = rows.schema["turn"].dataType
    named = rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).otherwise(F.lit(None).cast(none)).alias("turn"),
        F.when(~gone, F.col("role")).otherwise("").alias("role"),
        F.when(~gone, _digest(F.col("text"))).otherwise(F.lit(b"")).alias("digest"),
        F.when(~gone, kind).otherwise(_BLANK).alias("kind"),
        "times",
    )
    counted = store(named.groupBy(*_KEYS, "kind").agg(F.sum("times").alias("copies")))
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")))
    firsts = counted.where("copies > 0").groupBy("conv_id", "role", "digest", "kind").agg(earliest.alias("e"))
    marks = firsts.select("conv_id", F.col("e.turn").alias("turn"), "role", "digest", "kind", F.lit(0).cast("long").alias("copies"), F.lit(1).alias("first"))
    both = counted.withColumn("first", F.lit(0)).unionByName(marks)
    return both.groupBy(*_KEYS, "kind").agg(F.sum("copies").alias("copies"), F.max("first").alias("first"))


# -- solving ----------------------------------------------------------------------------------------------------

_LEGAL = {"su", "ua", "au"}
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


class _Piece:
    """A conversation, or the part of one that came to this task, read cell by cell."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.count = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = None
        self.turns = 0
        self.first = self.last = None
        self.rows: list[Row] = []
        self.table: dict[tuple[int, int], Path] | None = None

    def add(self, turn: object, role: str, kind: int, copies: int, first: int) -> None:
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.count["illegal"] += 1
        self.last = initial
        self.count["illegal"] += copies - 1
        kept = 1 if first and kind != _BLANK else 0
        self.count["blank" if kind == _BLANK else "duplicate"] += copies - kept
        self.count["truncated"] += int(kept and kind == _CUT)
        if kept:
            self._row((initial, False, kind == _CUT))
        for _ in range(copies - kept):
            self._row((initial, True, False))

    def _row(self, row: Row) -> None:
        if len(self.rows) == BLOCK:
            self.close_block()
        self.rows.append(row)

    def close_block(self) -> None:
        block = block_table(self.rows)
        self.table = block if self.table is None else chain(self.table, block)
        self.rows = []

    def solve(self) -> Path:
        if self.table is None:
            return search(self.rows, START, ENDS)
        self.close_block()
        return finish(self.table)


_RESULT = ("gaps", *_COUNTS, "cost")


def _piece_schema(conv: T.StructField, turn: T.StructField) -> T.StructType:
    return T.StructType([
        conv, T.StructField("part", T.IntegerType()), T.StructField("closed", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("low", turn.dataType), T.StructField("high", turn.dataType), T.StructField("turns", T.LongType()),
        T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
        T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())),
    ])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 1 + sum(map(len, row.get("audits") or ())) // 1000
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def solved_pieces(found: DataFrame) -> DataFrame:
    """Cells in ranges of (conversation, turn); every conversation, or its part in a task, solved.

    Only the first and the last conversation of a task can go on in another
    one: these are left open, with their paths for all entry and exit states.
    """
    order = ["conv_id", "turn", "role", "digest"]  # nulls first
    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _piece_schema(found.schema["conv_id"], found.schema["turn"])
    layout = _arrow(schema)

    def row(piece: _Piece, part: int, edge: bool) -> dict:
        if edge:
            piece.close_block()
            pairs = [(a, b) for a in STATES for b in STATES]
            paths = [piece.table.get(p, (-1, "")) for p in pairs]
        else:
            paths = [piece.solve()]
        return {
            "conv_id": piece.conv_id, "part": part, "closed": not edge, **piece.count, "low": piece.low,
            "high": piece.high, "turns": piece.turns, "first": piece.first, "last": piece.last,
            "costs": [p[0] for p in paths], "audits": [p[1] for p in paths],
        }

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        piece, edge = None, True
        for batch in batches:
            for conv, turn, role, kind, copies, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None or conv != piece.conv_id:
                    if piece is not None:
                        yield row(piece, part, edge)
                        edge = False
                    piece = _Piece(conv)
                piece.add(turn, role, kind, copies, first)
        if piece is not None:
            yield row(piece, part, True)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(pieces(batches), layout)

    return map_batches(ranged.select("conv_id", "turn", "role", "kind", "copies", "first"), task, schema)


def chained(pieces: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, ..., cost, audit)`` from stored pieces; open ones are joined in order."""
    span = (F.col("high") - F.col("low") + 1 - F.col("turns")).cast("long")
    closed = pieces.where("closed").select(
        "conv_id", F.coalesce(span, F.lit(0)).alias("gaps"), *_COUNTS, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit")
    )
    schema = T.StructType([
        pieces.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in _RESULT], T.StructField("audit", T.StringType()),
    ])
    layout = _arrow(schema)
    pairs = [(a, b) for a in STATES for b in STATES]

    def join(parts: list[dict]) -> dict:
        count = {c: sum(p[c] for p in parts) for c in _COUNTS}
        turns, high, last, table = 0, None, None, None
        for p in parts:
            turns += p["turns"] - int(p["low"] is not None and p["low"] == high)
            high = high if p["high"] is None else p["high"]
            if p["first"] is not None:
                count["illegal"] += int(last is not None and last + p["first"] not in _LEGAL)
                last = p["last"]
            block = {k: (c, a) for k, c, a in zip(pairs, p["costs"], p["audits"], strict=True) if c >= 0}
            table = block if table is None else chain(table, block)
        low = next((p["low"] for p in parts if p["low"] is not None), None)
        cost, audit = finish(table)
        gaps = 0 if low is None else int(high - low) + 1 - turns
        return {"conv_id": parts[0]["conv_id"], "gaps": gaps, **count, "cost": cost, "audit": audit}

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts: list[dict] = []
        for batch in batches:
            for p in batch.to_pylist():
                if parts and parts[0]["conv_id"] != p["conv_id"]:
                    yield join(parts)
                    parts = []
                parts.append(p)
        if parts:
            yield join(parts)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(joined(batches), layout)

    # At most two open pieces per task of the ranges.
    open_ = pieces.where("NOT closed").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return closed.unionByName(map_batches(open_, task, schema))


# -- applying the edits -----------------------------------------------------------------------------------------


class _Repair:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _next_role(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._next_role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._next_role(), text
        elif edit == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
            yield role, text


def _with_edits(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows and, before each conversation's rows, its result; hashed by conversation and sorted."""
    kept = [c for c in solved.columns if c != "conv_id"]
    heads = solved.withColumn("_tag", F.lit(0))
    lines = rows.where("times > 0").select(
        "conv_id", F.lit(1).alias("_tag"), "turn", "role", _digest(F.col("text")).alias("digest"), "text", "times"
    )
    both = heads.unionByName(lines, allowMissingColumns=True)
    order = ["conv_id", "_tag", "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "_tag", "role", "text", "times", *kept)


def repaired_digests(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``solved`` with ``repaired_sha256``: the SHA-256 of the repaired ``role:text`` lines."""
    kept = [c for c in solved.columns if c != "conv_id"]
    schema = T.StructType([*solved.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    layout = _arrow(schema)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        head = repair = digest = None
        lines = 0

        def feed(found: Iterator[tuple[str, str]]) -> None:
            nonlocal lines
            for role, text in found:
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1

        def close() -> dict:
            feed(repair.inserts())
            return head | {"repaired_sha256": digest.hexdigest()}

        for batch in batches:
            for r in batch.to_pylist():
                if r["_tag"] == 0:
                    if head is not None:
                        yield close()
                    head = {c: r[c] for c in ("conv_id", *kept)}
                    repair, digest, lines = _Repair(head["audit"]), hashlib.sha256(), 0
                else:
                    for _ in range(r["times"]):
                        feed(repair.row(r["role"], r["text"]))
        if head is not None:
            yield close()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(results(batches), layout)

    return map_batches(_with_edits(rows, solved), task, schema)


def repaired_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``(conv_id, position, role, text)``: the repaired conversations."""
    schema = T.StructType([
        solved.schema["conv_id"], T.StructField("position", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ])
    layout = _arrow(schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        repair, conv, n = None, None, 0
        for batch in batches:
            for r in batch.to_pylist():
                found: list[tuple[object, str, str]] = []
                if r["_tag"] == 0:
                    if repair is not None:
                        found += [(conv, *x) for x in repair.inserts()]
                    after = [dict(zip(("conv_id", "role", "text"), x, strict=True)) for x in found]
                    for k, x in enumerate(after):
                        yield x | {"position": n + k}
                    repair, conv, n = _Repair(r["audit"]), r["conv_id"], 0
                    continue
                for _ in range(r["times"]):
                    for role, text in repair.row(r["role"], r["text"]):
                        yield {"conv_id": conv, "position": n, "role": role, "text": text}
                        n += 1
        if repair is not None:
            for role, text in repair.inserts():
                yield {"conv_id": conv, "position": n, "role": role, "text": text}
                n += 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(lines(batches), layout)

    return map_batches(_with_edits(rows, solved.select("conv_id", "audit")), task, schema)


def solve(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per conversation (stored)."""
    prepare(rows.sparkSession)
    return store(chained(store(solved_pieces(cells(rows)))))


def repair(conversations: DataFrame) -> DataFrame:
    """The conversations ``(conv_id, turn, role, text)`` repaired: ``(conv_id, position, role, text)``."""
    rows = whole(conversations)
    return repaired_rows(rows, solve(rows))


def repair_report(conversations: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of every conversation after the damage."""
    rows = damaged(conversations)
    return repaired_digests(rows, solve(rows))


def oracle() -> str:
    """DuckDB text of the registered query: the same edits by a forward pass over (row, state)."""
    return r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
keyed AS (SELECT k, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], CAST([1, 2, 3, 4, 5, 6, 7, 8] AS BIGINT[])),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)) AS crc
  FROM (SELECT DISTINCT k FROM source)),
hit AS (SELECT s.*, xor(crc, CAST(4294967295 AS BIGINT)) % 20 AS h FROM source s JOIN keyed USING (k)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(1, 3) r(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
  FROM damaged),
counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM ranked),
lined AS (
  SELECT *, left(role, 1) AS ini, final = '' AS blank, final <> '' AND nth > 1 AS dup,
    final NOT IN ('', '.', '!', '?') AND nth = 1 AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    coalesce(CAST(conv_id AS VARCHAR), ' ') AS c
  FROM counted),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate,
    count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM lined GROUP BY c),
walk AS (
  SELECT c, CAST(0 AS BIGINT) AS pos, 0 AS state, struct_pack(cost := 0, audit := '', body := '') AS best FROM counts
  UNION ALL
  SELECT c, pos, state, min(struct_pack(cost := cost, audit := audit, body := body)) AS best
  FROM (
    SELECT l.c, l.pos,
      CASE WHEN e.edit = 'D' THEN w.state WHEN e.edit = 'IR' THEN 3 WHEN e.edit = 'R' THEN CASE WHEN w.state = 2 THEN 3 ELSE 2 END
           WHEN l.ini = 's' THEN 1 WHEN l.ini = 'u' THEN 2 ELSE 3 END AS state,
      w.best.cost + CASE e.edit WHEN 'D' THEN 3 WHEN 'K' THEN 0 WHEN 'IR' THEN 4 ELSE 2 END
        + CASE WHEN l.cut AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost,
      w.best.audit || e.edit AS audit,
      w.best.body || CASE WHEN e.edit = 'D' THEN '' ELSE
        CASE WHEN w.best.body = '' THEN '' ELSE chr(10) END
        || CASE WHEN e.edit = 'IK' THEN CASE WHEN l.ini = 'u' THEN 'assistant:' ELSE 'user:' END || chr(10) ELSE '' END
        || CASE WHEN e.edit = 'IR' THEN 'user:' || chr(10) || 'assistant' WHEN e.edit = 'R' THEN CASE WHEN w.state = 2 THEN 'assistant' ELSE 'user' END ELSE l.role END
        || ':' || l.text END AS body
    FROM walk w JOIN lined l ON l.c = w.c AND l.pos = w.pos + 1,
      (VALUES ('D'), ('K'), ('IK'), ('R'), ('IR')) e(edit)
    WHERE e.edit = 'D' OR (NOT l.blank AND NOT l.dup AND CASE e.edit
      WHEN 'K' THEN (l.ini = 's' AND w.state = 0) OR (l.ini = 'u' AND w.state <> 2) OR (l.ini = 'a' AND w.state = 2)
      WHEN 'IK' THEN (l.ini = 'u' AND w.state = 2) OR (l.ini = 'a' AND w.state <> 2)
      WHEN 'IR' THEN w.state = 1 AND l.ini NOT IN ('u', 'a')
      ELSE l.ini <> CASE WHEN w.state = 2 THEN 'a' ELSE 'u' END END)
  ) step GROUP BY c, pos, state),
ended AS (
  SELECT w.c, min(struct_pack(cost := best.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
    audit := best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    body := best.body || CASE state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:'
      WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END)) AS best
  FROM walk w JOIN counts k ON w.c = k.c AND w.pos = k.n GROUP BY w.c)
SELECT s.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate,
  coalesce(k.truncated, 0) AS truncated, coalesce(k.illegal, 0) AS illegal,
  CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost, coalesce(e.best.audit, '') AS audit,
  sha256(coalesce(e.best.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM source) s
LEFT JOIN counts k ON k.c = coalesce(CAST(s.conv_id AS VARCHAR), ' ') LEFT JOIN ended e ON e.c = k.c
"""
