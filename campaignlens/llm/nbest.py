"""SentencePiece encoding and decoding with N-best segmentations.

The lattice of a text has an edge for every vocabulary piece that matches at a
position, weighted by the piece's stored score; a character that no piece
covers has an edge to its UTF-8 bytes.  Forward Viterbi scores are the exact
heuristic of a backward A-star search over that lattice; every position is
expanded at most N times and ways are parent links, so the N best segmentations
take time and memory linear in the text's length, however many score alike.

No piece spans the start of a run of spaces or (in this vocabulary) joins a
letter to another character, so a text's lattice is a chain of independent
lattices, one per *unit*: spaces and the letters or the other characters after
them.  Units
are segmented once per task: the forward and backward passes run over many
units at a time as arrays, and tell how much each unit's second-best
segmentation loses.  A text's N best differ from its best only in the N - 1
units that lose least, so the search runs on those alone.

As in SentencePiece, a text is preceded by one space and spaces belong to the
pieces after them.  Decoding gives back the exact text.  Edge scores add up;
equal scores go to the longer last piece, in the search to the way whose
front is closer to the start.

Defined cases: null and empty texts have no pieces, score 0 and no
alternatives, and decode to an empty text; very long texts are segmented whole,
unit by unit; a literal U+2581 is encoded as bytes; columns named like the added ones are left out; repeated rows are encoded
alike; an empty table gives an empty result.  The model file's bytes are read
by the driver (a path with a scheme: through Spark) and broadcast; no executor
needs the file.
"""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, prepare

N_BEST = 3
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
_NONE = -1
# Stored scores below this mark pieces without a rank (runs of spaces): they count like an unknown character.
_UNRANKED = -1e8
_UNKNOWN_PENALTY = 10.0
# Units are padded to one of these sizes; longer ones are segmented one by one.
_SIZES = (4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 64)
# Text bytes whose new units are segmented together.
_BLOCK = 2 << 20
# Units that a task remembers (about 250 bytes each).
_CACHE = 200_000
_TABLE_BITS = 18


def model_bytes(spark: SparkSession, path: str = MODEL_FILE) -> bytes:
    """The model file's content (a vocabulary, a few hundred kB); a plain path is a file of the driver's machine."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


class Vocabulary:
    """Pieces with a space for the mark, their scores, and a hash table for arrays of characters."""

    def __init__(self, proto: bytes) -> None:
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = model.get_piece_size()
        self.score = np.array([model.get_score(i) for i in range(n)], float)
        self.byte_ids = [_NONE] * 256
        self.pieces: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece.replace(_MARK, " ")] = i
                self.raw[i] = piece.replace(_MARK, " ").encode()
        if _NONE in self.byte_ids:
            raise ValueError("the model has no byte fallback; exact decoding needs it")
        if any(" " in p.lstrip(" ") for p in self.pieces):
            raise ValueError("a piece spans words; units would not be independent")
        self.longest = max(map(len, self.pieces))
        used = self.score[list(self.pieces.values())]
        self.unknown = float(used[used > _UNRANKED].min()) - _UNKNOWN_PENALTY
        self.score[self.score <= _UNRANKED] = self.unknown
        self.units = re.compile(self._unit_pattern())
        self._build()

    def _unit_pattern(self) -> str:
        """Units: spaces and the letters after them, or spaces and the other characters after them.

        A vocabulary with a piece that joins a letter and another character has
        units that end at spaces only.  White space that no piece has stands alone.
        """
        alphabet = {c for p in self.pieces for c in p}
        breaks = "".join(c for c in "\n\t\r" if c not in alphabet)
        lone = f"[{breaks}]|" if breaks else ""
        stripped = [p.lstrip(" ") for p in self.pieces]
        if any(a.isalpha() != b.isalpha() for p in stripped for a, b in zip(p, p[1:])):
            return rf" *[^ {breaks}]+|{lone} +"
        others = re.escape("".join(sorted(c for c in alphabet if not c.isalpha() and c != " ")))
        return rf" *[^ {breaks}{others}]+| *[{others}]+|{lone} +"

    def _build(self) -> None:
        """A hash table of a few slots a bucket, and a smaller map that most other strings fail."""
        names = list(self.pieces)
        h = np.array([self.hash_of(p) for p in names], np.uint64)
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces share a hash")
        slot = self._slot(h, _TABLE_BITS)
        order = np.argsort(slot, kind="stable")
        place = np.arange(len(slot)) - np.searchsorted(slot[order], slot[order], side="left")
        self.keys = np.zeros((int(place.max()) + 1, 1 << _TABLE_BITS), np.uint64)
        self.ids = np.full(self.keys.shape, _NONE, np.int32)
        self.keys[place, slot[order]] = h[order]
        self.ids[place, slot[order]] = np.array([self.pieces[names[i]] for i in order], np.int32)
        self.maybe = np.zeros(1 << (_TABLE_BITS + 2), bool)
        self.maybe[self._slot(h, _TABLE_BITS + 2)] = True
        self.piece_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])])

    @staticmethod
    def _slot(h: np.ndarray, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    @staticmethod
    def hash_of(piece: str) -> np.uint64:
        codes = np.array([ord(c) for c in piece], np.uint64)
        p, _ = textops.powers(len(codes) + 1)
        with np.errstate(over="ignore"):
            return np.sum(textops.splitmix(codes) * p[: len(codes)], dtype=np.uint64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes that are pieces, and the pieces."""
        at = np.flatnonzero(self.maybe[self._slot(h, _TABLE_BITS + 2)])
        some = h[at]
        slot = self._slot(some, _TABLE_BITS)
        found = np.full(len(at), _NONE, np.int32)
        for keys, ids in zip(self.keys, self.ids, strict=True):
            hit = keys[slot] == some
            found[hit] = ids[slot[hit]]
        known = found != _NONE
        return at[known], found[known]

    def edges_to(self, unit: str, end: int) -> list[tuple[int, tuple[int, ...], float]]:
        """``(start, ids, score)`` of every edge that ends at a position; longer pieces first."""
        out = []
        for start in range(max(0, end - self.longest), end):
            i = self.pieces.get(unit[start:end])
            if i is not None:
                out.append((start, (i,), float(self.score[i])))
        if not any(start == end - 1 for start, _, _ in out):
            out.append((end - 1, self.edge(unit, end - 1, end), self.unknown))
        return out

    def edge(self, unit: str, start: int, end: int) -> tuple[int, ...]:
        """The ids of the edge between two positions: a piece, or a character's bytes."""
        i = self.pieces.get(unit[start:end])
        return (i,) if i is not None else tuple(self.byte_ids[b] for b in unit[start:end].encode())

    def forward(self, unit: str) -> array:
        """Viterbi scores: the best sum of edges from the start to every position."""
        best = array("d", [0.0])
        for end in range(1, len(unit) + 1):
            best.append(max(best[start] + w for start, _, w in self.edges_to(unit, end)))
        return best

    def search(self, unit: str, n: int, count: Callable[[], None] | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations ``(score, ids)``, best first, by backward A-star search.

        A node is a way from a position to the unit's end, a link to the way it
        extends.  The forward score of its position is exactly what the best
        rest brings, so nodes leave the heap in the order of the best whole
        segmentation through them, and a node at the start is the next best
        one.  A position is expanded at most ``n`` times: the ways that come to
        it later are no better than ``n`` others with the same rest.  Equal
        values go to the smaller position, so among segmentations that score
        alike one is finished before the others are begun.  ``count`` is
        called for every expansion.
        """
        best = self.forward(unit)
        place, link, worth = array("q", [len(unit)]), array("q", [-1]), array("d", [0.0])
        heap = [(-best[len(unit)], len(unit), 0)]
        expanded = array("q", bytes(8 * (len(unit) + 1)))
        edges: dict[int, list[tuple[int, tuple[int, ...], float]]] = {}
        found: list[int] = []
        while heap and len(found) < n:
            _, at, way = heapq.heappop(heap)
            if expanded[at] == n:
                continue
            expanded[at] += 1
            if at == 0:
                found.append(way)
                continue
            if count is not None:
                count()
            if at not in edges:
                edges[at] = self.edges_to(unit, at)
            for start, _, w in edges[at]:
                if expanded[start] < n:
                    place.append(start)
                    link.append(way)
                    worth.append(worth[way] + w)
                    heapq.heappush(heap, (-(worth[-1] + best[start]), start, len(place) - 1))
        out = []
        for way in found:
            total, ids = 0.0, []
            while link[way] >= 0:
                start, way = place[way], link[way]
                piece = self.edge(unit, start, place[way])
                # Added up from the left like the forward scores, so no segmentation seems better than the best.
                total += float(self.score[piece[0]]) if self._is_piece(unit, start, place[way]) else self.unknown
                ids += piece
            out.append((total, tuple(ids)))
        return sorted(out, key=lambda x: -x[0])

    def _is_piece(self, unit: str, start: int, end: int) -> bool:
        return unit[start:end] in self.pieces


@dataclass
class Segmented:
    """Best segmentations of some units: pieces one after another, their number, the score, and what the
    second best loses (infinite without one)."""

    units: list[str]
    flat: np.ndarray
    length: np.ndarray
    score: np.ndarray
    loss: np.ndarray


def best_of(v: Vocabulary, unit: str) -> tuple[float, tuple[int, ...], float]:
    """Score, pieces and loss of the second best of one unit."""
    two = v.search(unit, 2)
    return *two[0], two[0][0] - two[1][0] if len(two) > 1 else float("inf")


def _one_by_one(v: Vocabulary, units: list[str]) -> Segmented:
    found = [best_of(v, u) for u in units]
    return Segmented(
        units,
        np.array([i for _, ids, _ in found for i in ids], np.int32),
        np.array([len(ids) for _, ids, _ in found], np.int64),
        np.array([s for s, _, _ in found], float),
        np.array([x for _, _, x in found], float),
    )


def _together(v: Vocabulary, units: list[str], size: int) -> Iterator[Segmented]:
    """Units of up to ``size`` characters, together: forward and backward scores as arrays.

    Shorter units are padded; nothing behind a unit's end counts, since its
    backward scores start there.  Units with characters outside the vocabulary
    are then done one by one.
    """
    m = len(units)
    reach = min(v.longest, size)
    length_of = np.array([len(u) for u in units])
    padded = "".join([u.ljust(size, "\0") for u in units])
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, size).T.astype(np.uint64)
    p, q = textops.powers(size + 1)
    with np.errstate(over="ignore"):
        run = np.zeros((size + 1, m), np.uint64)
        np.cumsum(textops.splitmix(codes) * p[:size, None], axis=0, dtype=np.uint64, out=run[1:])
    rows = np.arange(m)
    forward = np.full((size + 1, m), -np.inf)
    forward[0] = 0.0
    last = np.zeros((size + 1, m), np.int8)
    last_piece = np.full((size + 1, m), _NONE, np.int32)
    strange = np.zeros(m, bool)
    edges = []
    for end in range(1, size + 1):
        for length in range(min(end, reach), 0, -1):
            start = end - length
            with np.errstate(over="ignore"):
                h = (run[end] - run[start]) * q[start]
            at, piece = v.find(h)
            if length == 1 and len(at) < m:
                unknown = np.ones(m, bool)
                unknown[at] = False
                strange |= unknown & (end <= length_of)
            if not len(at):
                continue
            w = v.score[piece]
            edges.append((end, length, at, w))
            value = forward[start, at] + w
            better = value > forward[end, at]
            to = at[better]
            forward[end, to] = value[better]
            last[end, to] = length
            last_piece[end, to] = piece[better]
    backward = np.full((size + 1, m), -np.inf)
    backward[length_of, rows] = 0.0
    for end, length, at, w in reversed(edges):
        start = end - length
        backward[start, at] = np.maximum(backward[start, at], backward[end, at] + w)
    at = np.where(strange, 0, length_of)
    chosen = np.zeros((size + 1, m), np.int8)  # length of the best path's edge that ends here
    path: list[np.ndarray] = []
    while True:
        live = np.flatnonzero(at > 0)
        if not len(live):
            break
        pieces = np.full(m, _NONE, np.int32)
        pieces[live] = last_piece[at[live], live]
        path.append(pieces)
        step = last[at[live], live]
        chosen[at[live], live] = step
        at[live] -= step
    second = np.full(m, -np.inf)  # the best path with an edge that the best one lacks
    for end, length, at, w in edges:
        through = forward[end - length, at] + w + backward[end, at]
        through[chosen[end, at] == length] = -np.inf
        second[at] = np.maximum(second[at], through)
    fine = np.flatnonzero(~strange)
    if len(fine):
        steps = np.array(path[::-1]).T[fine]
        score = forward[length_of[fine], fine]
        yield Segmented(
            [units[i] for i in fine.tolist()], steps[steps != _NONE], (steps != _NONE).sum(axis=1), score, score - second[fine]
        )
    if len(fine) < m:
        yield _one_by_one(v, [units[i] for i in np.flatnonzero(strange).tolist()])


def segment(v: Vocabulary, units: Sequence[str]) -> Iterator[Segmented]:
    """Best segmentations of distinct units."""
    long_ = [u for u in units if len(u) > _SIZES[-1]]
    if long_:
        yield _one_by_one(v, long_)
    by_size: dict[int, list[str]] = {}
    for u in units:
        if len(u) <= _SIZES[-1]:
            by_size.setdefault(_SIZES[bisect_left(_SIZES, len(u))], []).append(u)
    for size, group in by_size.items():
        step = 800_000 // (size * min(size, v.longest))
        for i in range(0, len(group), step):
            yield from _together(v, group[i : i + step], size)


class Encoder:
    """Units segmented so far, by number; they are forgotten when there are too many."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.flat = np.empty(0, np.int32)
        self.length = np.empty(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.score, self.loss = np.empty(0), np.empty(0)
        self.others: dict[tuple[int, int], list[tuple[float, tuple[int, ...]]]] = {}

    def numbers(self, units: list[list[str]]) -> list[np.ndarray]:
        """The units of some texts as numbers; new ones are segmented."""
        if len(self.names) > _CACHE:
            self._clear()
        fresh = set().union(*units).difference(self.number)
        if fresh:
            found = list(segment(self.v, list(fresh)))
            for s in found:
                self.number.update(zip(s.units, range(len(self.names), len(self.names) + len(s.units)), strict=True))
                self.names += s.units
            for name in ("flat", "length", "score", "loss"):
                setattr(self, name, np.concatenate([getattr(self, name), *[getattr(s, name) for s in found]]))
            self.at = np.concatenate([[0], np.cumsum(self.length)])
        return [np.array(list(map(self.number.__getitem__, text)), np.int64) for text in units]

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of a sequence of units, and where each unit's begin."""
        length = self.length[numbers]
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        take = np.arange(ends[-1]) - np.repeat(ends[:-1] - self.at[numbers], length)
        return self.flat[take], ends

    def alternatives(self, numbers: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, tuple[int, ...]]]]]:
        """The ``n - 1`` segmentations after the best: ``(loss, [(unit position, ids)])``.

        Only the ``n - 1`` units that lose least can differ (earlier units
        first where they lose alike).
        """
        loss = self.loss[numbers]
        if n < 2 or not len(loss):
            return []
        kept = min(n - 1, len(loss))
        edge = np.partition(loss, kept - 1)[kept - 1]
        below = np.flatnonzero(loss < edge)
        few = np.concatenate([below, np.flatnonzero(loss == edge)[: kept - len(below)]])
        few = few[np.isfinite(loss[few])]
        found: list[tuple[float, list[tuple[int, tuple[int, ...]]]]] = [(0.0, [])]
        for at in sorted(few.tolist()):
            options = self._others(int(numbers[at]), n)
            found = heapq.nsmallest(
                n,
                [f for f in found] + [(c + loss_, e + [(at, ids)]) for c, e in found for loss_, ids in options],
                key=lambda x: (x[0], len(x[1]), x[1]),
            )
        return found[1:]

    def _others(self, number: int, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Segmentations of a unit after its best: ``(loss, ids)``."""
        if (number, n) not in self.others:
            best = tuple(self.flat[self.at[number] : self.at[number + 1]].tolist())
            found = self.v.search(self.names[number], n + 1)
            self.others[number, n] = [(float(self.score[number]) - s, ids) for s, ids in found if ids != best][:n]
        return self.others[number, n]


_VOCABULARIES: dict[bytes, Vocabulary] = {}


def _vocabulary(proto: bytes) -> Vocabulary:
    """The worker's vocabulary, built once."""
    if proto not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[proto] = Vocabulary(proto)
    return _VOCABULARIES[proto]


def split_units(v: Vocabulary, text: str | None) -> list[str]:
    return v.units.findall(" " + text) if text else []


def decode_ids(v: Vocabulary, ids: Sequence[int]) -> str:
    """The text of a sequence of pieces."""
    raw = v.raw
    return b"".join([raw[i] for i in ids])[1:].decode("utf-8", "replace")


ADDED = ("n_pieces", "score", "ids", "alternatives")
_ALTERNATIVE = "array<struct<loss: double, n_pieces: int, edits: array<struct<start: int, length: int, ids: array<int>>>>>"
_EDIT = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
_ALTERNATIVES = pa.list_(pa.struct([("loss", pa.float64()), ("n_pieces", pa.int32()), ("edits", pa.list_(_EDIT))]))


def encode(
    docs: DataFrame, proto: bytes, text_col: str = "text", n_best: int = N_BEST, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_pieces, score, ids`` of the best segmentation and ``alternatives`` added.

    An alternative gives its loss against the best, its number of pieces and
    its edits: ``length`` pieces from ``start`` on are replaced by ``ids``.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    kept = [c for c in docs.columns if c.lower() not in ADDED and (keep_text or c != text_col)]
    chosen = docs.select(*[col(c) for c in kept])
    new = {
        "n_pieces": F.lit(0).cast("long"),
        "score": F.lit(0.0),
        "ids": F.array().cast("array<int>"),
        "alternatives": F.array().cast(_ALTERNATIVE),
    }

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(shared.value))
        for batch in batches:
            raw, offsets = textops.text_buffers(batch.column(batch.num_columns - 1))
            for a, b in textops.blocks(offsets, _BLOCK):
                texts = batch.column(batch.num_columns - 1).slice(a, b - a).to_pylist()
                numbers = encoder.numbers([split_units(encoder.v, t) for t in texts])
                flat, sizes, scores, others = [], [], [], []
                for each in numbers:
                    ids, ends = encoder.ids(each)
                    flat.append(ids)
                    sizes.append(len(ids))
                    scores.append(float(encoder.score[each].sum()))
                    others.append([_as_edits(x, ends) for x in encoder.alternatives(each, n_best)])
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                every = np.concatenate(flat) if flat else np.empty(0, np.int32)
                columns = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                columns += [
                    pa.array(sizes, pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(every.astype(np.int32))),
                    pa.array(others, _ALTERNATIVES),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])
        del encoder
        textops.give_back()

    source = docs.select(*[col(c) for c in kept], col(text_col).alias("_text"))
    return map_batches(source, task, chosen.withColumns(new).schema)


def _as_edits(alternative: tuple[float, list[tuple[int, tuple[int, ...]]]], ends: np.ndarray) -> dict:
    loss, changes = alternative
    edits = [
        {"start": int(ends[at]), "length": int(ends[at + 1] - ends[at]), "ids": list(ids)} for at, ids in changes
    ]
    total = int(ends[-1]) + sum(len(e["ids"]) - e["length"] for e in edits)
    return {"loss": loss, "n_pieces": total, "edits": edits}


def decode(encoded: DataFrame, proto: bytes, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its pieces added as ``name``; null pieces give a null text."""
    prepare(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(proto)
    chosen = encoded.select(*[col(c) for c in encoded.columns if c.lower() != name.lower()])
    at = chosen.columns.index(ids_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, decode_column(v, batch.column(at))], names=[*batch.schema.names, name]
            )

    return map_batches(chosen, task, chosen.withColumn(name, F.lit("")).schema)


def decode_column(v: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The texts of a column of piece lists; bytes that are not UTF-8 are replaced."""
    bounds = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = bounds - bounds[0]
    if ids.null_count:
        sizes = np.array([0 if x is None else x for x in pc.list_value_length(ids).to_pylist()], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
    length = v.piece_at[flat + 1] - v.piece_at[flat]
    ends = np.concatenate([[0], np.cumsum(length)])
    take = np.arange(ends[-1]) + np.repeat(v.piece_at[flat] - ends[:-1], length)
    raw = v.piece_bytes[take]
    at = ends[bounds]
    # The space that encoding puts before a text is left out of each row.
    keep = np.ones(len(raw), bool)
    keep[at[:-1][np.diff(at) > 0]] = False
    at = at - np.concatenate([[0], np.cumsum(np.diff(at) > 0)])
    wide = textops.binary_column(raw[keep], at)
    try:
        texts = wide.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([x.as_py().decode("utf-8", "replace") for x in wide], pa.string())
    return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string())) if ids.null_count else texts
