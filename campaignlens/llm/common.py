"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.llm import textops
from campaignlens.session import ensure_checkpoint_dir

# Bytes of one Arrow batch handed to Python.  Bounds a worker's memory when texts are long.
ARROW_BATCH_BYTES = 4 << 20
# The class of white space in the definition of a word.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder from the session, and Arrow batches bounded by bytes."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_map(dtype: T.DataType) -> bool:
    """Whether a type holds a map, which Spark neither hashes nor compares."""
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType)) or (isinstance(dtype, T.ArrayType) and has_map(dtype.elementType))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; columns that hold maps count with their JSON text."""
    plain = [col(f.name) for f in df.schema.fields if not has_map(f.dataType)]
    maps = [F.to_json(F.struct(col(f.name).alias("m"))) for f in df.schema.fields if has_map(f.dataType)]
    return F.xxhash64(*plain, *maps)


def crc_bucket(id_column: Column, buckets: int) -> Column:
    """``crc32`` of the id as text, modulo ``buckets``; null ids fall in bucket 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % buckets, F.lit(0)).cast("int")


def store(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet next to the session's checkpoints and read back.

    Cuts the lineage like ``checkpoint()`` (a lost executor recomputes nothing
    below), but later reads take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_counts(
    df: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int
) -> np.ndarray:
    """How many of the 64-bit hashes that ``hashes`` makes of a table's batches fall in each of ``2**bits`` buckets.

    Every task sums its own buckets and sends them in pieces; the pieces are
    summed as they stream into the tasks that own them.  The result has a fixed
    size whatever the input.
    """
    size, piece = 1 << bits, 1 << min(bits, 14)
    mask = np.uint64(size - 1)
    layout = pa.schema([("piece", pa.int32()), ("counts", pa.binary())])

    def rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        """Pieces with a count, each in the narrowest type that holds it."""
        some = {i: s.astype(np.min_scalar_type(int(s.max()))) for i, s in sums.items() if s.any()}
        return pa.RecordBatch.from_arrays(
            [pa.array(list(some), pa.int32()), pa.array([s.tobytes() for s in some.values()], pa.binary())],
            schema=layout,
        )

    def read(counts: bytes) -> np.ndarray:
        return np.frombuffer(counts, f"u{len(counts) // piece}").astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for h in hashes(batches):
            if len(h) * 8 > size:
                total += np.bincount((h & mask).astype(np.int64), minlength=size)
            else:
                np.add.at(total, (h & mask).astype(np.int64), 1)
        if total.any():
            yield rows({i: total[i * piece : (i + 1) * piece] for i in range(size // piece)})
        textops.give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + read(counts)
        if sums:
            yield rows(sums)

    ddl = "piece int, counts binary"
    out = np.zeros(size, np.int64)
    for r in df.mapInArrow(count, ddl).repartition("piece").mapInArrow(add, ddl).collect():
        out[r["piece"] * piece : (r["piece"] + 1) * piece] = read(bytes(r["counts"]))
    return out


def map_batches(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` that also takes columns whose names hold dots or back quotes."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    fields = [T.StructField(f"r{i}", f.dataType, True) for i, f in enumerate(schema.fields)]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in task(b.rename_columns(names) for b in batches):
            yield out.rename_columns([f.name for f in fields])
        textops.give_back()

    return plain.mapInArrow(renamed, T.StructType(fields)).toDF(*schema.names)
