"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct five-word shingle whose 48-bit hash lies below a
fixed fraction of the hash range, so its size follows the text and sketches of
very unequal texts estimate containment as well as likeness.  A text whose
shingles all lie above the threshold keeps its smallest hash; what part of it a
longer text holds is unknown from the sketches, and the report tells it from
all shingles of both texts.  Sketches merge:
the sketch of a union is the union of the sketches, cut at the threshold again.
A fingerprint writes the kept hashes in ascending order, 12 hex digits each.

Words are the runs outside white space, taken as they are; a text with fewer
than five words has its whole sequence as one shingle.

Defined cases: a null text is an empty one; texts without words have an empty
fingerprint, two of them are alike (1.0), and nothing else is like them (0.0);
equal texts have equal fingerprints; columns named like the added ones are left
out of the results; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, parts, prepare

WIDTH = 5
FRACTION = 0.25
_BITS = 48
_DIGITS = _BITS // 4


def sketches(column: pa.Array, width: int = WIDTH, fraction: float = FRACTION) -> list[np.ndarray]:
    """Kept hashes of every text of an Arrow column, ascending."""
    limit = np.uint64(int(fraction * (1 << _BITS)))
    out: list[np.ndarray] = []
    for a, b, words, at in textops.word_blocks(column):
        h, owner = textops.window_hashes(words, at, width)
        h = h >> np.uint64(64 - _BITS)
        low = h < limit
        kept, ends = textops.distinct_by_row(h[low], owner[low], b - a)
        for i in range(b - a):
            out.append(kept[ends[i] : ends[i + 1]])
        bare = np.flatnonzero((np.diff(ends) == 0) & (np.diff(at) > 0))
        if len(bare):
            mine = np.isin(owner, bare)
            least = np.full(b - a, np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(least, owner[mine], h[mine])
            for i in bare:
                out[a + i] = least[i : i + 1].copy()
    return out


def merge(found: list[np.ndarray], fraction: float = FRACTION) -> np.ndarray:
    """The sketch of the union of the texts (of their shingle sets)."""
    every = reduce(np.union1d, found, np.empty(0, np.uint64)).astype(np.uint64)
    low = every[every < np.uint64(int(fraction * (1 << _BITS)))]
    return low if len(low) else every[:1]


def to_text(kept: np.ndarray) -> str:
    return kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BITS // 8 :].tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    digits = _DIGITS
    return np.array([int(fingerprint[i : i + digits], 16) for i in range(0, len(fingerprint), digits)], np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of the shingle sets."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    common = _common(a, b)
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float | None:
    """Estimated part of the first text's shingles that the second also has.

    None (unknown) where the first sketch is a smallest hash above the threshold
    that the second text may have without keeping it.
    """
    if not len(a):
        return 1.0
    if not len(b):
        return 0.0
    common = _common(a, b)
    return None if not common and _bare(a, fraction) and b[0] < a[0] else common / len(a)


def _bare(sketch: np.ndarray, fraction: float) -> bool:
    """Whether a sketch holds a text's smallest hash for want of one below the threshold."""
    return bool(len(sketch)) and bool(sketch[0] >= np.uint64(int(fraction * (1 << _BITS))))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def fingerprint(docs: DataFrame, text_col: str = "text", width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the column ``fingerprint`` added."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != "fingerprint"]
    at = kept.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [to_text(s) for s in sketches(batch.column(at), width, fraction)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "fingerprint"]
            )

    chosen = docs.select(*[col(c) for c in kept])
    return map_batches(chosen, task, chosen.withColumn("fingerprint", F.lit("")).schema)


def hash_rows(fingerprints: DataFrame, keys: Sequence[str], fraction: float = FRACTION) -> DataFrame:
    """``(keys..., hash)``: a row for every kept hash below the threshold; a text's stand-in hash above it has none."""
    each = F.explode(F.regexp_extract_all("fingerprint", F.lit(f".{{{_DIGITS}}}"), F.lit(0)))
    limit = f"{int(fraction * (1 << _BITS)):0{_DIGITS}x}"
    return fingerprints.select(*[col(k) for k in keys], each.alias("hash")).where(F.col("hash") < limit)


def merged(fingerprints: DataFrame, by: str, fraction: float = FRACTION) -> DataFrame:
    """``(by, hash)``: the sketch of the union of each group's texts, a row per hash.

    A group may be a third of the corpus, so its sketch is never gathered in one
    row; hashes that repeat inside a task are dropped before the shuffle.
    Merged sketches merge again: their union, without repeats, is the sketch of
    all their texts.
    """
    return hash_rows(fingerprints, [by], fraction).distinct()


def containment_in(
    fingerprints: DataFrame, groups: DataFrame, id_col: str = "doc_id", by: str = "source", fraction: float = FRACTION
) -> DataFrame:
    """``(id, by, kept, common, held)``: how much of every text the groups of ``merged`` hold.

    Only pairs with a common hash have a row; ``held`` estimates the part of the
    text's shingles that some text of the group has.  Texts without a hash
    below the threshold have no row: nothing can be said of them.
    """
    mine = hash_rows(fingerprints, [id_col], fraction).distinct()
    sizes = mine.groupBy(col(id_col)).agg(F.count(F.lit(1)).alias("kept"))
    met = mine.join(groups, "hash").groupBy(col(id_col), col(by)).agg(F.count(F.lit(1)).alias("common"))
    return met.join(sizes, id_col).select(
        col(id_col), col(by), "kept", "common", (F.col("common") / F.col("kept")).alias("held")
    )


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _key(id_col: str) -> Column:
    return F.coalesce(col(id_col).cast("long"), F.lit(-(1 << 63)))


def _bounds(docs: DataFrame, id_col: str, ranges: int) -> list[int]:
    """Ids at which ranges of about equal size begin, descending; the first is the largest id."""
    points = [i / ranges for i in range(1, ranges)]
    row = (
        docs.select(_key(id_col).alias("k"))
        .agg(F.max("k").alias("top"), F.percentile_approx("k", points or [0.5], F.lit(100 * ranges)).alias("q"))
        .first()
    )
    if row is None or row["top"] is None:
        return []
    return sorted({row["top"], *(row["q"] if points else [])}, reverse=True)


def edit_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    fraction: float = FRACTION,
    ranges: int | None = None,
) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    The next document is the following one by descending id (null ids last,
    equal ids by text); after the last comes the first.  Ids are cut into
    ranges at exact ids; every range is one sorted run, and the first document
    of a range is also sent to the range before it, so each text is shuffled
    once and no task sees more than its ranges.  The number of ranges follows
    the shuffle partitions (a proven bound of what the driver gets).
    """
    spark = docs.sparkSession
    prepare(spark)
    bounds = _bounds(docs, id_col, ranges or 4 * parts(spark))
    starts = np.array(bounds[::-1], np.int64)  # ascending

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("k").to_numpy(zero_copy_only=False)
            # The range that begins at bounds[r] holds the ids from there down to the next bound.
            r = len(starts) - 1 - np.searchsorted(starts, key, side="left")
            first = np.flatnonzero(key == starts[len(starts) - 1 - r])
            rows = np.concatenate([np.arange(len(key)), first])
            guard = np.zeros(len(rows), bool)
            guard[len(key) :] = True
            r = np.concatenate([r, (r[first] - 1) % len(starts)])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(r, pa.int32()), pa.array(guard)], names=[*taken.schema.names, "r", "guard"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that still waits for its next one
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            own = sketches(batch.column("text"), width, fraction)
            ids, ranges_, guards = (batch.column(c).to_pylist() for c in ("id", "r", "guard"))
            pairs = []
            for row in zip(ids, texts, own, ranges_, guards, strict=True):
                if last is not None and last[3] == row[3]:
                    pairs.append((last, row))
                last = None if row[4] else row
            changed = [edited(a[1], b[1]) for a, b in pairs]
            marks = sketches(pa.array(changed, pa.string()), width, fraction)
            out = {c: [] for c in _REPORT.names}
            bare = []  # containments to be told from the texts
            for (a, b), text, mark in zip(pairs, changed, marks, strict=True):
                out["id"].append(a[0])
                out["n_chars"].append(len(a[1]))
                out["edited_sha256"].append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                out["fingerprint"].append(to_text(a[2]))
                out["edited_fingerprint"].append(to_text(mark))
                out["near_edited"].append(likeness(a[2], mark))
                out["near_next"].append(likeness(a[2], b[2]))
                for name, sketch, part in (("edited_holds", mark, text), ("next_holds", b[2], b[1])):
                    if _bare(sketch, fraction):
                        bare.append((name, len(out[name]), part, a[1]))
                    out[name].append(containment(sketch, a[2], fraction))
            every = sketches(pa.array([t for *_, part, whole in bare for t in (part, whole)], pa.string()), width, 1.0)
            for (name, at, _, _), part, whole in zip(bare, every[::2], every[1::2], strict=True):
                out[name][at] = containment(part, whole, 1.0)
            yield pa.RecordBatch.from_pydict(out, schema=_REPORT)

    rows = docs.select(col(id_col).cast("long").alias("id"), _key(id_col).alias("k"), col(text_col).alias("text"))
    if not bounds:
        bounds = [0]
        starts = np.array([0], np.int64)
    placed = rows.mapInArrow(place, "id long, k long, text string, r int, guard boolean")
    run = placed.repartition("r").sortWithinPartitions("r", "guard", F.desc("k"), F.asc_nulls_first("text"))
    report = run.mapInArrow(compare, _REPORT_DDL)
    return report.withColumnRenamed("id", id_col)


_REPORT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("edited_holds", pa.float64()),
        ("next_holds", pa.float64()),
    ]
)
_REPORT_DDL = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_holds double, next_holds double"
)
