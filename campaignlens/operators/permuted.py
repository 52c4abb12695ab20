"""Rows with one column at a time permuted, as counted feature vectors.

A copy shifts its column along the rows' positions, so row ``p`` of it takes the
value of row ``p - shift``.  Positions are cut into blocks of ``BLOCK_ROWS``;
every row sends its values once to its own block and each value to the block
of the row that takes it, so all copies need one shuffle of the rows and no
join.  A task holds one block, makes its copies and counts equal rows, which
are summed over the blocks afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 16

_PIECES = "block long, kind int, at binary, value binary"


def _numbers(column: pa.Array) -> np.ndarray:
    """Doubles, with NaN for what is missing."""
    return column.to_numpy(zero_copy_only=False).astype(float)


def _pieces(n: int, width: int, moved: Sequence[int], shifts: Sequence[int], size: int):
    """What the rows of a batch ``(position, columns...)`` send: their own columns (kind -1) and the values of each copy."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(0).to_numpy()
            x = np.stack([_numbers(batch.column(1 + c)) for c in range(width)], axis=1)
            out: dict[str, list] = {"block": [], "kind": [], "at": [], "value": []}
            for kind in range(-1, len(moved)):
                to = p if kind < 0 else (p + shifts[kind]) % n
                order = np.argsort(to)
                blocks, first = np.unique(to[order] // size, return_index=True)
                for b, rows in zip(blocks, np.split(order, first[1:])):
                    value = x[rows] if kind < 0 else x[rows, moved[kind]]
                    for name, v in zip(out, (b, kind, (to[rows] - b * size).astype(np.int32).tobytes(), value.tobytes())):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["block"], pa.int64()), pa.array(out["kind"], pa.int32()), pa.array(out["at"], pa.binary()), pa.array(out["value"], pa.binary()),
            ], names=list(out))

    return cut


def counted_copies(x: np.ndarray, taken: np.ndarray, moved: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(copy, rows, n)`` for the rows themselves (copy -1) and each copy: its distinct rows and how often they occur.

    ``taken`` (rows x copies) are the permuted values.  Rows are told apart by
    one number made of the ranks of their values; where that would not fit 63
    bits they are left uncounted.
    """
    ranks, theirs, step = [], {}, [1]
    for c in range(x.shape[1]):
        kinds = [k for k, m in enumerate(moved) if m == c]
        distinct, rank = np.unique(np.concatenate([x[:, c], *[taken[:, k] for k in kinds]]), return_inverse=True)
        ranks.append(rank[: len(x)])
        theirs |= {k: rank[(j + 1) * len(x): (j + 2) * len(x)] for j, k in enumerate(kinds)}
        step.append(step[-1] * len(distinct))
    whole = sum(r * s for r, s in zip(ranks, step)) if step[-1] < 1 << 62 else None
    for k in range(-1, len(moved)):
        first, n = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
        if whole is not None:
            key = whole if k < 0 else whole + (theirs[k] - ranks[moved[k]]) * step[moved[k]]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
        rows = x[first]
        if k >= 0:
            rows[:, moved[k]] = taken[first, k]
        yield k, rows, n


def permuted_counts(
    numbered: DataFrame, position: str, n: int, columns: Sequence[str], label: str, shifts: dict[str, int], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(copy, columns..., tp, fp)``: the distinct feature vectors of the rows (copy -1) and of the copies in the order of ``shifts``.

    ``numbered`` has positions from 0 to ``n - 1``; ``tp`` and ``fp`` are the
    rows of a vector with label 1 and 0.  Rows without a label count as neither.
    """
    names = [label, *columns]
    moved = [names.index(c) for c in shifts]
    blocks = -(-n // block_rows)
    rows = numbered.select(F.col(position).cast("long"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    pieces = rows.mapInArrow(_pieces(n, len(names), moved, list(shifts.values()), block_rows), _PIECES)

    def copies(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        size = min(block_rows, n - key[0] * block_rows)
        x, taken = np.empty((size, len(names))), np.empty((size, len(moved)))
        for kind, at, value in zip(group["kind"], group["at"], group["value"]):
            at, value = np.frombuffer(at, dtype=np.int32), np.frombuffer(value)
            if kind < 0:
                x[at] = value.reshape(len(at), -1)
            else:
                taken[at, kind] = value
        found = list(counted_copies(x, taken, moved))
        out = pd.DataFrame(np.concatenate([r for _, r, _ in found]), columns=[f"c{i}" for i in range(len(names))])
        out["copy"] = np.concatenate([np.full(len(r), k) for k, r, _ in found])
        out["n"] = np.concatenate([c for _, _, c in found])
        return out

    schema = ", ".join([*[f"c{i} double" for i in range(len(names))], "copy int", "n long"])
    # A block holds megabytes: a numbered deal, which is not coalesced.
    counted = pieces.repartition(blocks, "block").groupBy("block").applyInPandas(copies, schema)
    y = F.nanvl("c0", F.lit(None)).cast("int")
    return counted.groupBy("copy", *[F.col(f"c{i + 1}").alias(c) for i, c in enumerate(columns)]).agg(
        F.sum(F.col("n") * y).alias("tp"), F.sum(F.col("n") * (F.lit(1) - y)).alias("fp")
    )
