"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad.  A line's potential is linear
in its own features and in those of the lines before and after it; a 2 x 2
table scores neighbouring labels.  Forward-backward gives each line's
probability of being good, and a document's quality is the mean of those,
weighted by line length, mapped to the label's probability by a logistic
function.

Training takes labelled documents: at most about ``train_rows`` of them (picked
by a hash of the id) with at most ``train_lines`` lines, both documented
bounds.  A line first has its document's label; lines of bad documents that a
plain line classifier finds good are then relabelled (each bad document keeps
its worst line), and the field is fitted to those labels by gradient ascent.

Defined cases: a null text, an empty one and one without a word have no line
and get quality 0 before the logistic map; null labels are not learned from;
without labels of both kinds a fixed neutral model scores 0.5; repeated rows
are scored alike; columns named like the added ones are left out of the result;
an empty table gives an empty result.  Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, prepare
from campaignlens.llm.toxicity import fit_logistic

TRAIN_ROWS = 8_000
# Lines that a document brings to training; a longer one brings a run of its lines picked by a hash of its id.
TRAIN_LINES = 64
THRESHOLD = 0.3
RELABEL = 0.5
STEPS = 250


def _byte_class(members: bytes | range) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


_CLASSES = {
    "upper": _byte_class(range(65, 91)),
    "letter": ~textops.NOT_LETTER,
    "digit": _byte_class(range(48, 58)),
    "symbol": _byte_class(b"#*$%&<>@^~_=+{}[]\\/"),
    "bar": _byte_class(b"|"),
    "bang": _byte_class(b"!?"),
    "stop": _byte_class(b".,;:"),
    "wide": _byte_class(range(128, 192)),  # continuation bytes
}
FEATURES = (
    "words", "word_length", "upper", "digit", "symbol", "bar", "bang", "stop", "closed", "opened", "stutter",
    "distinct", "same_as_before",
)


@dataclass(frozen=True)
class Lines:
    """Features of the lines with a word, their lengths in code points, and line offsets per text."""

    x: np.ndarray
    length: np.ndarray
    at: np.ndarray


def line_features(raw: np.ndarray, bounds: np.ndarray) -> Lines:
    lo, hi = int(bounds[0]), int(bounds[-1])
    cuts, line_at = textops.line_bounds(raw, bounds)
    words, starts, ends, word_at = textops.word_spans(raw, bounds)
    line_of = np.searchsorted(cuts[1:], starts, side="right")
    n_lines = len(cuts) - 1
    count = np.bincount(line_of, minlength=n_lines)
    has = np.flatnonzero(count > 0)
    rows = np.searchsorted(line_at[1:], has, side="right")
    at = np.searchsorted(rows, np.arange(len(bounds))).astype(np.int64)
    if not len(has):
        return Lines(np.zeros((0, len(FEATURES))), np.zeros(0), at)
    block = raw[lo:hi]
    a, b = cuts[has] - lo, cuts[has + 1] - lo
    total = {}
    for name, members in _CLASSES.items():
        run = np.concatenate([[0], np.cumsum(members[block])])
        total[name] = (run[b] - run[a]).astype(float)
    n = count[has].astype(float)
    length = (b - a) - total["wide"]
    first = np.searchsorted(line_of, has, side="left")
    last = np.searchsorted(line_of, has, side="right") - 1
    word_chars = np.concatenate([[0], np.cumsum(ends - starts)])
    equal = np.zeros(len(words))
    equal[1:] = (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])
    stutter = np.concatenate([[0], np.cumsum(equal)])
    order = np.lexsort((words, line_of))
    fresh = np.ones(len(words))
    w, o = words[order], line_of[order]
    fresh[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    distinct = np.concatenate([[0], np.cumsum(fresh)])
    # A line's hash is an ordered sum over its words.
    with np.errstate(over="ignore"):
        place = (np.arange(len(words)) - first[np.searchsorted(has, line_of)]).astype(np.uint64)
        mixed = np.concatenate([[np.uint64(0)], np.cumsum(textops.splitmix(words + place), dtype=np.uint64)])
        mark = mixed[last + 1] - mixed[first]
    same = np.zeros(len(has))
    same[1:] = (mark[1:] == mark[:-1]) & (rows[1:] == rows[:-1])
    final = block[ends[last] - 1 - lo]
    initial = block[starts[first] - lo]
    x = np.stack(
        [
            np.log1p(n),
            (word_chars[last + 1] - word_chars[first]) / n / 10.0,
            total["upper"] / np.maximum(total["letter"], 1),
            total["digit"] / np.maximum(length, 1),
            total["symbol"] / n,
            total["bar"] / n,
            total["bang"] / n,
            total["stop"] / n,
            _CLASSES["stop"][final] | _CLASSES["bang"][final],
            _CLASSES["upper"][initial] | (initial >= 128),
            (stutter[last + 1] - stutter[first]) / n,
            (distinct[last + 1] - distinct[first]) / n,
            same,
        ],
        axis=1,
    ).astype(float)
    x[:, 4:8] = np.minimum(x[:, 4:8], 3.0)
    return Lines(x, np.maximum(length, 1.0), at)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Own features, those of the line before and after (zeros at the ends), edge marks and a constant."""
    x, n = lines.x, len(lines.x)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    filled = np.flatnonzero(np.diff(lines.at) > 0)
    first[lines.at[filled]] = True
    last[lines.at[filled + 1] - 1] = True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0.0, 0.0
    return np.concatenate([x, before, after, first[:, None], last[:, None], np.ones((n, 1))], axis=1)


def marginals(potential: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected label pairs of neighbours summed over all texts.

    ``potential`` is the log-odds input for good, ``table[i, j]`` the log score
    of label ``j`` after ``i`` (0 bad, 1 good).  All texts advance together, the
    longer ones first.
    """
    n = len(potential)
    counts = np.diff(at)
    pairs = np.zeros((2, 2))
    if not n:
        return np.zeros(0), pairs
    order = np.argsort(-counts, kind="stable")
    begin, counts = at[:-1][order], counts[order]
    longest = int(counts[0])
    live = np.searchsorted(-counts, -np.arange(longest), side="left")  # texts with more than t lines
    p = np.clip(potential, -30, 30)
    emit = np.stack([np.ones(n), np.exp(p)], axis=1)
    emit /= emit.sum(axis=1, keepdims=True)
    move = np.exp(table)
    forward, backward = np.empty((n, 2)), np.ones((n, 2))
    for t in range(longest):
        now = begin[: live[t]] + t
        f = emit[now] * (forward[now - 1] @ move) if t else emit[now].copy()
        forward[now] = f / f.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        now = begin[: live[t + 1]] + t
        later = emit[now + 1] * backward[now + 1]
        b = later @ move.T
        backward[now] = b / b.sum(axis=1, keepdims=True)
        joint = forward[now][:, :, None] * move[None] * later[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs


@dataclass(frozen=True)
class Field:
    """Weights of the potentials, the label table, and the logistic map of a document's quality."""

    weights: np.ndarray
    table: np.ndarray
    map: np.ndarray


def neutral() -> Field:
    return Field(np.zeros(3 * len(FEATURES) + 3), np.zeros((2, 2)), np.zeros(4))


def fit_field(inputs: np.ndarray, at: np.ndarray, good: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and label table that maximise the labels' likelihood (Adam, a small ridge)."""
    w, table = np.zeros(inputs.shape[1]), np.zeros((2, 2))
    y = good.astype(int)
    inner = np.ones(len(y), bool)
    inner[at[:-1][np.diff(at) > 0]] = False  # the first line of a text has no line before
    later = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later - 1], y[later]), 1)
    theta = np.concatenate([w, table.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, table = theta[:-4], theta[-4:].reshape(2, 2)
        p, pairs = marginals(inputs @ w, at, table)
        g = np.concatenate([inputs.T @ (y - p), (seen - pairs).ravel()]) / max(len(y), 1) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _by_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0.0], np.cumsum(values)])
    return run[at[1:]] - run[at[:-1]]


def quality(p: np.ndarray, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities; 0 for a text without lines."""
    weight = _by_text(length, at)
    return np.where(weight > 0, _by_text(p * length, at) / np.maximum(weight, 1e-9), 0.0)


def _map_inputs(q: np.ndarray, lines: np.ndarray) -> np.ndarray:
    q = np.clip(q, 0, 1)
    odds = np.log((q + 0.01) / (1.01 - q))
    return np.stack([np.ones(len(q)), q, odds, (lines > 0) * 1.0], axis=1)


def fit(lines: Lines, label: np.ndarray) -> Field:
    """The field from the lines of labelled texts and the texts' labels."""
    if not len(lines.x) or label.min() == label.max():
        return neutral()
    owner = textops.owners(lines.at)
    good = label[owner].astype(float)
    own = np.concatenate([np.ones((len(lines.x), 1)), lines.x], axis=1)
    plain = 1.0 / (1.0 + np.exp(-np.clip(own @ fit_logistic(own, good), -30, 30)))
    worst = np.full(len(label), np.inf)
    np.minimum.at(worst, owner, plain)
    relabel = (good == 0) & (plain > RELABEL) & (plain > worst[owner])
    good[relabel] = 1.0
    inputs = with_neighbours(lines)
    weights, table = fit_field(inputs, lines.at, good)
    p, _ = marginals(inputs @ weights, lines.at, table)
    x = _map_inputs(quality(p, lines.length, lines.at), np.diff(lines.at))
    return Field(weights, table, fit_logistic(x, label.astype(float), penalty=0.1))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
    train_lines: int = TRAIN_LINES,
) -> Field:
    """A field fitted to labelled documents (``labels`` holds the rows to learn from).

    About ``train_rows`` documents, picked by a hash of the id, take part with
    up to ``train_lines`` neighbouring lines each; scoring reads every line.
    """
    prepare(docs.sparkSession)
    known = labels.where(col(label_col).isNotNull()).select(
        col(id_col).alias("_id"), col(label_col).cast("int").alias("y")
    )
    n = known.count()
    share = min(1.0, train_rows / n) if n else 1.0
    key = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("quality")), F.lit(1 << 20))
    picked = known.where(key < int(share * (1 << 20)) if share < 1 else F.lit(True))
    picked = picked.groupBy("_id").agg(F.max("y").alias("y"))  # of several labels the largest
    # At most about train_rows ids: a proven bound.
    sample = docs.join(F.broadcast(picked), col(id_col) == F.col("_id")).select("_id", "y", col(text_col).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = textops.text_buffers(batch.column("text"))
            lines = line_features(raw, offsets)
            x = np.concatenate([lines.x, lines.length[:, None]], axis=1)
            ids = batch.column("_id").cast(pa.string())
            runs = []
            for i, (name, first, end) in enumerate(zip(ids.to_pylist(), lines.at[:-1].tolist(), lines.at[1:].tolist(), strict=True)):
                if end - first > train_lines:
                    first += zlib.crc32(name.encode()) % (end - first - train_lines + 1)
                    end = first + train_lines
                runs.append(x[first:end].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([ids, batch.column("y"), pa.array(runs, pa.binary())], names=["id", "y", "x"])

    # Bounded by train_rows x train_lines lines of 56 bytes: 29 MB.
    rows = sample.mapInArrow(task, "id string, y int, x binary").collect()
    rows.sort(key=lambda r: (r["id"], r["y"]))
    width = len(FEATURES) + 1
    each = [np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, width).astype(float) for r in rows]
    if not each:
        return neutral()
    every = np.concatenate(each)
    at = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    return fit(Lines(every[:, :-1], every[:, -1], at), np.array([r["y"] for r in rows]))


ADDED = ("score", "predicted", "line_quality", "n_lines", "n_bad_lines")


def score(docs: DataFrame, field: Field, text_col: str = "text", threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted``, the weighted line quality and line counts added."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(field)
    kept = [c for c in docs.columns if c.lower() not in ADDED and (keep_text or c != text_col)]
    chosen = docs.select(*[col(c) for c in kept])
    new = dict(zip(ADDED, (F.lit(0.0), F.lit(0), F.lit(0.0), F.lit(0).cast("long"), F.lit(0).cast("long")), strict=True))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw, offsets = textops.text_buffers(batch.column(batch.num_columns - 1))
            out: list[list[np.ndarray]] = [[] for _ in ADDED]
            for a, b in textops.blocks(offsets):
                lines = line_features(raw, offsets[a : b + 1])
                p, _ = marginals(with_neighbours(lines) @ model.weights, lines.at, model.table)
                n = np.diff(lines.at)
                q = quality(p, lines.length, lines.at)
                s = 1.0 / (1.0 + np.exp(-np.clip(_map_inputs(q, n) @ model.map, -30, 30)))
                bad = _by_text((p < 0.5) * 1.0, lines.at).round().astype(np.int64)
                for values, v in zip(out, (s, (s >= threshold).astype(np.int32), q, n, bad), strict=True):
                    values.append(v)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            kinds = (pa.float64(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            columns += [pa.array(np.concatenate(v) if v else [], k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *ADDED])

    source = docs.select(*[col(c) for c in kept], col(text_col).alias("_text"))
    return map_batches(source, task, chosen.withColumns(new).schema)
