"""Global order without a single-task window, by value buckets.

``Window.orderBy`` without ``partitionBy`` moves every row into one task.
Instead the rows get a bucket from the values of their sort key: every sort
column has numeric codes that never decrease along the order, a histogram of
equal-width code buckets is counted, and a bucket with too many rows is counted
again inside its own range, or, where all its codes are equal, by the next code
or column.  Neighbouring small buckets are joined, so that every group of
buckets is a contiguous run of the order of about equal size.  Positions,
prefix sums and previous rows are then windows inside the groups plus what the
histogram says about the groups before.

A row's group depends on its values and on the counted histogram alone, so a
lost executor recomputes the same rows; nothing is sampled and nothing leaves
the JVM.  The histogram holds at most ``CELLS`` counts a round, whatever the
input.  The input is stored once, with its codes; the rounds read the codes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.operators.joins import shuffle_partitions
from campaignlens.sources.sinks import stage_roundtrip

# Counts collected in one round of the histogram.
CELLS = 1 << 16
# Parts that a bucket is cut into for every run that it is too large by.
FINE = 16
# Groups per shuffle partition, so that a hash of the group number deals them evenly.
GROUPS_PER_PARTITION = 4
# Rounds after which a bucket stays as large as it is (ranges shrink by the width each round).
ROUNDS = 64
# Bytes of a string that one code holds exactly, and codes of a string.
_BYTES, _CHUNKS = 6, 4
# Length code of a string with more bytes than its codes hold.
_LONG = _BYTES * _CHUNKS + 1
# Codes of infinite, NaN and missing values lie outside those of all other numbers.
_LARGE, _NAN, _MISSING = 4e307, 5e307, 8e307


@dataclass
class Order:
    """One sort column: its expression, its direction and where missing values go."""

    value: Column
    descending: bool = False
    nulls_last: bool = False


def parse_order(order: Sequence[Column | Order]) -> list[Order]:
    """Sort columns as ``Order``; a plain column sorts ascending with missing values first."""
    out = []
    for c in order:
        node = c._jc.node() if isinstance(c, Column) else None
        if node is not None and node.getClass().getSimpleName() == "SortOrder":
            inner = type(c)(SparkContext._active_spark_context._jvm.org.apache.spark.sql.Column(node.child()))
            text = str(c)
            out.append(Order(inner, " DESC " in text[-24:], "NULLS LAST" in text[-24:]))
        else:
            out.append(Order(c) if isinstance(c, Column) else c)
    return out


def _sort_column(o: Order) -> Column:
    if o.descending:
        return o.value.desc_nulls_last() if o.nulls_last else o.value.desc_nulls_first()
    return o.value.asc_nulls_last() if o.nulls_last else o.value.asc_nulls_first()


def _number_codes(value: Column, dtype: T.DataType) -> tuple[list[Column], bool]:
    """Numbers that never decrease with ``value``, and whether values with equal numbers are equal."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        x = value.cast("double")

        def near(y: Column) -> Column:
            # least and greatest skip missing values, so those are told apart first.
            inside = F.when(y.isNotNull(), F.greatest(F.least(y, F.lit(_LARGE)), F.lit(-_LARGE)))
            return F.when(F.isnan(y), F.lit(_NAN)).otherwise(inside)

        # The largest numbers meet at the bound; a scaled copy tells them apart.
        return [near(x), near(x * F.lit(2.0**-10))], True
    if isinstance(dtype, T.IntegralType):
        return _halves(value.cast("long")), True
    if isinstance(dtype, T.DecimalType):
        return [value.cast("double")], dtype.precision <= 15
    if isinstance(dtype, T.BooleanType):
        return [value.cast("int").cast("double")], True
    if isinstance(dtype, T.DateType):
        return [F.unix_date(value).cast("double")], True
    if isinstance(dtype, T.TimestampType):
        return _halves(F.unix_micros(value)), True
    if isinstance(dtype, T.TimestampNTZType):
        hours = F.unix_date(value.cast("date")).cast("double") * 24 + F.hour(value)
        return [hours, F.minute(value) * 60 + F.date_part(F.lit("SECOND"), value).cast("double")], True
    return [], False


def _halves(value: Column) -> list[Column]:
    """A 64-bit integer as two numbers that a double holds exactly."""
    return [F.shiftright(value, 32).cast("double"), value.bitwiseAND(F.lit((1 << 32) - 1)).cast("double")]


def _byte_code(value: Column, start: int) -> Column:
    """``_BYTES`` bytes of a string from byte ``start`` (0-based) as one number."""
    digits = F.rpad(F.hex(F.substring(value.cast("binary"), start + 1, _BYTES)), 2 * _BYTES, "0")
    return F.conv(digits, 16, 10).cast("double")


def _text_codes(value: Column) -> list[Column]:
    """The first bytes of a string in chunks, then its length (one number for all longer ones)."""
    length = F.octet_length(value.cast("binary"))
    return [*(_byte_code(value, k * _BYTES) for k in range(_CHUNKS)), F.least(length, F.lit(_LONG)).cast("double")]


def _codes(df: DataFrame, order: Sequence[Order]) -> tuple[list[Column], set[int]]:
    """The codes of the sort columns, in order, and those after which equal codes need not mean equal values.

    Rows are compared code by code.  Where a column's codes cannot tell its
    values apart (very long strings, wide decimals, other types) the later
    columns decide nothing, and rows that agree so far stay in one run.
    """
    types = [f.dataType for f in df.select(*[o.value.alias(f"c{i}") for i, o in enumerate(order)]).schema.fields]
    out: list[Column] = []
    vague: set[int] = set()
    for o, t in zip(order, types):
        text = isinstance(t, (T.StringType, T.BinaryType))
        raw, exact = (_text_codes(o.value), True) if text else _number_codes(o.value, t)
        missing = F.lit(_MISSING if o.nulls_last else -_MISSING)
        out += [F.coalesce(-c if o.descending else c, missing) for c in raw]
        if text:
            vague.add(len(out) - 1)
        if not exact:
            break
    return out or [F.lit(0.0)], vague


@dataclass
class _Cell:
    """A bucket of the histogram: rows, sums and the range of every code in it."""

    n: int
    sums: list
    low: list[float]
    high: list[float]
    code: int = 0
    parts: int = 1

    def cut(self, most: int, width: int, vague: set[int]) -> None:
        """Choose the code and the number of parts; one part if it is small enough or all its codes are equal."""
        self.parts = 1
        if self.n <= most:
            return
        width = max(2, min(width, FINE * -(-self.n // most)))
        for code in range(self.code, len(self.low)):
            low, high = self.low[code], self.high[code]
            if code in vague and _LONG in (abs(low), abs(high)):
                return
            if low < high and width / (high - low) < _LARGE:
                self.code, self.parts = code, width
                return


def _array(values: Sequence, kind: str) -> str:
    """SQL of an array that the optimiser folds into one constant."""
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<{kind}>)"


def lookup(values: Sequence, kind: str, index: Column) -> Column:
    """``values[index]`` of a constant list."""
    return F.element_at(F.expr(_array(values, kind)), index + 1)


def _children(cells: Sequence[_Cell], cell: str) -> str:
    """SQL of the next round's cell number for a row of ``cell``."""
    base = [0]
    for c in cells:
        base.append(base[-1] + c.parts)
    low = [c.low[c.code] for c in cells]
    scale = [c.parts / (c.high[c.code] - c.low[c.code]) if c.parts > 1 else 0.0 for c in cells]

    def at(values: Sequence, kind: str) -> str:
        return repr(values[0]) + ("D" if kind == "double" else "") if len(values) == 1 else f"element_at({_array(values, kind)}, {cell} + 1)"

    used = sorted({c.code for c in cells if c.parts > 1})
    code = f"_code{used[0]}"
    if len(used) > 1:
        code = f"CASE {at([c.code for c in cells], 'int')} " + " ".join(f"WHEN {j} THEN _code{j}" for j in used) + " ELSE 0D END"
    step = f"floor(({code} - {at(low, 'double')}) * {at(scale, 'double')})"
    return f"cast({at(base[:-1], 'int')} + least(greatest({step}, 0), {at([c.parts for c in cells], 'int')} - 1) as int)"


def _counts(n_codes: int, values: Sequence[str]) -> list[Column]:
    """Rows, sums and code ranges as three aggregates: ``n``, ``sums``, ``low`` and ``high``."""
    def each(f: str) -> str:
        return ", ".join(f"{f}(_code{j})" for j in range(n_codes))

    sums = ", ".join(f"'s{i}', sum(`{v}`)" for i, v in enumerate(values))
    return [
        F.expr("count(1) AS n"), F.expr(f"array({each('min')}) AS low"), F.expr(f"array({each('max')}) AS high"),
        F.expr(f"named_struct({sums}) AS sums" if values else "1 AS sums"),
    ]


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _cell(row, n_values: int, code: int = 0) -> _Cell:
    sums = [v or 0 for v in row["sums"]] if n_values else []
    return _Cell(row["n"], sums, list(row["low"]), list(row["high"]), code)


@dataclass
class Grouped:
    """Rows with ``_g``, the number of a contiguous run of the order, and what lies before each run."""

    rows: DataFrame
    order: list[Column]
    before_n: list[int]
    before: list[list]

    def window(self):
        return Window.partitionBy("_g").orderBy(*self.order)

    def offset_n(self) -> Column:
        return lookup(self.before_n or [0], "bigint", F.col("_g"))

    def offset(self, i: int, dtype: str) -> Column:
        return lookup([b[i] for b in self.before] or [0], dtype, F.col("_g"))


def grouped(
    df: DataFrame, order: Sequence[Column], values: Sequence[str] = (), groups: int | None = None
) -> Grouped:
    """``df`` cut into contiguous runs of ``order`` of about equal size, with running totals of ``values``."""
    keys = parse_order(order)
    groups = groups or GROUPS_PER_PARTITION * shuffle_partitions(df)
    code_list, vague = _codes(df, keys)
    n_codes = len(code_list)
    # Rows and codes are stored once; the rounds read the codes only.
    rows = stage_roundtrip(df.withColumns({f"_code{j}": c for j, c in enumerate(code_list)}), "order")
    sort = [_sort_column(o) for o in keys]
    first = rows.agg(*_counts(n_codes, values)).first()
    total = first["n"]
    if not total:
        return Grouped(rows.select(*map(_named, df.columns), F.lit(0).alias("_g")), sort, [], [])
    cells = [_cell(first, len(values))]
    most = max(1, -(-total // groups))
    node = "0"
    for round_ in range(ROUNDS):
        heavy = sum(c.n > most for c in cells)
        for c in cells:
            c.cut(most, CELLS // max(heavy, 1), vague)
        if all(c.parts == 1 for c in cells):
            break
        rows = rows.selectExpr("*", f"{_children(cells, node)} AS _cell{round_}")
        node = f"_cell{round_}"
        # Only the cells that were cut are counted again; a filter would copy the whole chain of lookups.
        parent = [i for i, c in enumerate(cells) for _ in range(c.parts)]
        again = f"element_at({_array([int(cells[p].parts > 1) for p in parent], 'int')}, {node} + 1) = 1"
        counts = rows.groupBy(F.expr(f"CASE WHEN {again} THEN {node} END AS _c")).agg(*_counts(n_codes, values))
        counted = {r["_c"]: r for r in counts.collect()}
        nxt = []
        for i, p in enumerate(parent):
            if cells[p].parts == 1:
                nxt.append(cells[p])
            elif i in counted:
                nxt.append(_cell(counted[i], len(values), cells[p].code))
            else:
                nxt.append(_Cell(0, [0] * len(values), [0.0] * n_codes, [0.0] * n_codes))
        cells = nxt
    group_of, before_n, before, size = [], [], [], 0
    run_n, run = 0, [0] * len(values)
    for c in cells:
        if not before_n or (size and size + c.n > most):
            before_n.append(run_n)
            before.append(list(run))
            size = 0
        group_of.append(len(before_n) - 1)
        size += c.n
        run_n += c.n
        run = [a + b for a, b in zip(run, c.sums)]
    group = "0" if len(cells) == 1 else f"element_at({_array(group_of, 'int')}, {node} + 1)"
    return Grouped(rows.select(*map(_named, df.columns), F.expr(f"cast({group} as int) AS _g")), sort, before_n, before)


def with_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", num_partitions: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row in ``order`` (a ``row_number``).

    ``order`` must be a total order (end it with a unique column) for the
    positions to be deterministic.  ``num_partitions`` is the number of runs
    wanted, by default a few per shuffle partition.
    """
    g = grouped(df, order, (), num_partitions)
    position = g.offset_n() + F.row_number().over(g.window())
    return g.rows.withColumn(name, position.cast("long")).drop("_g")


def with_prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    values: Sequence[str],
    position: str = "position",
    prefix: str = "cum_",
    num_partitions: int | None = None,
    previous: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """Add the position and inclusive running sums of ``values`` (numbers without nulls) in ``order``.

    ``previous`` names columns whose value in the row before is added as
    ``prev_<name>``, null where that row differs in the columns ``within``.
    """
    g = grouped(df, order, values, num_partitions)
    so_far = g.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {position: (g.offset_n() + F.row_number().over(g.window())).cast("long")}
    for i, v in enumerate(values):
        kind = "bigint" if isinstance(df.schema[v].dataType, T.IntegralType) else "double"
        cols[f"{prefix}{v}"] = g.offset(i, kind) + F.sum(F.col(f"`{v}`")).over(so_far)
    out = g.rows.withColumns(cols)
    if previous:
        out = _with_lag(g, out, order, within, previous).withColumns(
            {f"prev_{c}": F.col(f"_prev.v{i}") for i, c in enumerate(previous)}
        ).drop("_prev")
    return out.drop("_g")


def _with_lag(g: Grouped, rows: DataFrame, order: Sequence[Column], group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``rows`` with ``_prev``: ``names`` of the row before as a struct ``v0, v1, ...``, null at the head of a group.

    The first row of a run takes the last row of the run before, read from a
    frame of one row per run: a bounded frame, broadcast.  Runs are never
    empty, so the run before is the next lower number.
    """
    every = [*group, *names]
    here = F.struct(*[_named(c).alias(f"v{i}") for i, c in enumerate(every)])
    keys = parse_order(order)
    if all(not o.descending and not o.nulls_last for o in keys):
        key = F.struct(*[o.value.alias(f"k{i}") for i, o in enumerate(keys)])
        last = g.rows.groupBy("_g").agg(F.max(F.struct(key.alias("k"), here.alias("h"))).alias("m")).select("_g", F.col("m.h").alias("h"))
    else:
        after = F.lead(F.lit(1)).over(g.window())
        last = g.rows.select("_g", here.alias("h"), after.alias("a")).where("a IS NULL").drop("a")
    tails = F.broadcast(last.select((F.col("_g") + 1).alias("_g"), F.col("h").alias("_tail")))
    joined = rows.withColumn("_lag", F.lag(here).over(g.window())).join(tails, "_g", "left")
    before = F.coalesce("_lag", "_tail")
    same = before.isNotNull()
    for i, c in enumerate(group):
        same = same & before[f"v{i}"].eqNullSafe(_named(c))
    found = F.struct(*[before[f"v{len(group) + i}"].alias(f"v{i}") for i in range(len(names))])
    return joined.withColumn("_prev", F.when(same, found)).drop("_lag", "_tail")


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
    prefix: str = "prev_",
    num_partitions: int | None = None,
) -> DataFrame:
    """``lag(v)`` per group in ``order`` without one task per group.

    The runs follow ``(group..., order...)``, so a hot group spans several of
    them.  A previous row of another group gives null.
    """
    whole = [_named(c) for c in group] + list(order)
    g = grouped(df, whole, (), num_partitions)
    lagged = _with_lag(g, g.rows, whole, group, values)
    return lagged.withColumns({f"{prefix}{v}": F.col(f"_prev.v{i}") for i, v in enumerate(values)}).drop("_g", "_prev")
