"""Packing by concatenate and cut: documents form one long run of token ids, cut into windows of equal length.

Every document becomes its ids and one closing id.  Pass one tokenises each
input partition and numbers its tokens locally; the partitions' token totals
are summed up from left to right, so every document gets a global offset
without any ordering shuffle.  Pass two cuts the documents at the multiples of
the window length.  A document that crosses a cut lies in several pieces; a
piece is the boundary record of one document in one window (where it starts
there, how long it is, which part of the document it is).

Only the last window can be shorter than the others, so padding is under one
window for the whole corpus.

Defined cases: a null or empty text is one closing id; a very long text is
tokenised in parts that end before a single space between letters or digits (the ids are
the same) and fills many windows; equal texts and repeated rows are packed like
any other row; null ids stay null; an empty table gives no piece; other columns
are not read, whatever their names.  The order is that of the input's
partitions, so the same files with the same split settings pack alike.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.llm.common import col, map_batches, prepare, store

WINDOW = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
# Characters of one tokenised part of a long text.
PART_CHARS = 1 << 18
# Input partitions whose totals are summed in one group.
BLOCK = 1024
_CUT = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


def vocabulary(spark: SparkSession, path: str | None = None) -> bytes:
    """The tokenizer file's bytes; a local path is read by the driver, any other by Spark."""
    path = path or public_tokenizers.path(VOCABULARY)
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _byte_of_letter() -> dict[str, int]:
    """Byte of every letter of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts under a byte-level BPE vocabulary file whose ids follow the order of its merges.

    The merges run in ``tiktoken``; special tokens written out in a text become
    their ids, as the file's own library does by default.
    """

    def __init__(self, content: bytes) -> None:
        file = json.loads(content)
        vocab, letter = file["model"]["vocab"], _byte_of_letter()
        added = {a["content"]: a["id"] for a in file["added_tokens"]}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in file["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("the vocabulary's ids do not follow its merges")
        ranks = {bytes(letter[c] for c in token): i for token, i in vocab.items() if token not in added}
        self._encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.special = set(added)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        found = [self._encoding.encode_to_numpy(part, allowed_special=self.special) for part in _text_parts(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)


def _text_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Parts of a long text; a cut before a single space between letters or digits lies between two tokens."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def tokenise(
    docs: DataFrame, content: bytes, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """``(doc_id, part, at, n, ids)``: every document's ids with the closing one, numbered inside its partition.

    ``part`` is the input partition, ``at`` the tokens of the documents before
    it there, ``ids`` little-endian unsigned 32-bit numbers.
    """
    prepare(docs.sparkSession)
    source = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = T.StructType([
        source.schema["doc_id"],
        T.StructField("part", T.IntegerType()),
        T.StructField("at", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at = Encoder(shared.value), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows = [np.append(encoder.ids(t.as_py()), np.uint32(end_id)) for t in batch.column(1)]
            n = np.array([len(r) for r in rows], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(n), part, np.int32)),
                    pa.array(starts),
                    pa.array(n),
                    pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()),
                ],
                names=schema.names,
            )

    return map_batches(source, task, schema)


def offsets(totals: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(part, before)``: tokens of all earlier partitions, from ``(part, n)`` with one row per partition.

    Two levels: partitions are summed inside blocks, then the blocks' totals
    are; no task sees more than one block, or one row per block.
    """
    inside = Window.partitionBy("_block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    named = totals.withColumn("_block", F.floor(F.col("part") / block))
    blocks = named.groupBy("_block").agg(F.sum("n").alias("n"))
    lead = blocks.select("_block", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("_lead"))
    local = named.select("part", "_block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("_local"))
    return local.join(lead, "_block").select("part", (F.col("_lead") + F.col("_local")).alias("before"))


def placed(tokens: DataFrame) -> DataFrame:
    """Stored ``tokenise`` rows with ``first``, the global number of their first token."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    # One row of two numbers per input partition (at most the splits of the scan).
    before = F.broadcast(offsets(totals))
    return tokens.join(before, "part").select("doc_id", (F.col("before") + F.col("at")).alias("first"), "n", "ids")


def _spans(first: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start in the document, length and global start of every piece."""
    low, high = first // window, (first + n - 1) // window
    count = high - low + 1
    row = np.repeat(np.arange(len(n)), count)
    number = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.maximum(number * window, first[row])
    end = np.minimum((number + 1) * window, (first + n)[row])
    return row, begin - first[row], end - begin, begin


def pieces(placed_tokens: DataFrame, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """The boundary records: one row per document and window it lies in.

    ``start`` counts the document's ids before the piece, ``offset`` the
    window's; ``ids_crc32`` is the checksum of the piece's ids.
    """
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [placed_tokens.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names]]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            row, start, length, begin = _spans(first, n, window)
            raw = [memoryview(v.as_buffer()) for v in batch.column(3)]
            cut = [raw[r][4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            crc = np.fromiter(map(zlib.crc32, cut), np.int64, len(cut))
            columns = [batch.column(0).take(pa.array(row))]
            columns += [pa.array(x) for x in (start, length, crc, n[row], begin // window, begin % window)]
            if keep_ids:
                columns.append(pa.array([bytes(c) for c in cut], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(placed_tokens.select("doc_id", "first", "n", "ids"), task, schema)


def windows(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(sequence_id, ids, records)`` from ``pieces(..., keep_ids=True)``: the training sequences.

    ``records`` lists ``(offset, length, doc_id, start)`` in order.  A window
    whose pieces come to one task is put together there; only windows that
    cross tasks are shuffled, at most ``window`` records each.
    """
    doc_type = cut.schema["doc_id"].dataType
    records = T.ArrayType(T.StructType([
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_id", doc_type),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]))
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("records", records)])
    arrow_records = pa.list_(pa.struct([
        ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", _arrow_type(cut, "doc_id")),
        ("start", pa.int64()), ("ids", pa.binary()),
    ]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: dict[int, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), arrow_records)], names=schema.names
            )

        open_: dict[int, list] = {}
        filled: dict[int, int] = {}
        for batch in batches:
            whole: dict[int, list] = {}
            for r in batch.to_pylist():
                s = r.pop("sequence_id")
                open_.setdefault(s, []).append(r)
                filled[s] = filled.get(s, 0) + r["length"]
                if filled[s] == window:
                    whole[s] = open_.pop(s)
                    del filled[s]
                elif len(open_) > _OPEN:  # rows out of order: hand the oldest over to the shuffle
                    old = next(iter(open_))
                    whole[old] = open_.pop(old)
                    del filled[old]
            if whole:
                yield rows(whole)
        if open_:
            yield rows(open_)

    held = map_batches(cut.select("sequence_id", "offset", "length", "doc_id", "start", "ids"), task, schema)
    held = store(held)
    length = F.aggregate("records", F.lit(0).cast("long"), lambda a, r: a + r["length"])
    whole = held.where(length == window)
    rest = held.where(length < window).groupBy("sequence_id").agg(F.flatten(F.collect_list("records")).alias("records"))
    ordered = whole.unionByName(rest).withColumn("records", F.array_sort("records"))
    ids = F.aggregate("records", F.lit(b""), lambda a, r: F.concat(a, r["ids"]))
    shown = F.transform("records", lambda r: F.struct(*[r[c].alias(c) for c in ("offset", "length", "doc_id", "start")]))
    return ordered.select("sequence_id", ids.alias("ids"), shown.alias("records"))


# Unfinished windows that one task keeps.
_OPEN = 64


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def pack(
    docs: DataFrame,
    content: bytes,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Boundary records of all documents; tokens are made once and stored between the passes."""
    tokens = store(tokenise(docs, content, id_col, text_col, end_id))
    return pieces(placed(tokens), window, keep_ids)
