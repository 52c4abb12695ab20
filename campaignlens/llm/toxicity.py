"""Toxicity by a weighted finite-state grammar over clauses.

Words of a text are read as classes: insult, threat, target, negation, report,
other.  Five small transducers, each a table of states and gains, are composed
into one machine (states are tuples, gains multiply): the insult and threat
transducers let a term's weight through, the negation transducer damps it for a
few words, the reported-speech transducer damps it to the end of the clause,
the target transducer raises it for a few words.  The machine runs over each
clause that holds a term, forwards, and the target transducer once more
backwards for targets that follow.  A clause's score is the sum of the weights
it lets through; a text's score is a logistic function of its clauses' scores.

Terms come from a short fixed list and from labelled texts: words and word
beginnings (3 to 8 bytes) whose document frequency in toxic texts stands out
against the clean ones, weighted by their log odds.  At most about
``train_rows`` labelled rows are learned from, picked by a hash of the id; the
bound is a parameter.

Defined cases: a null text, an empty one and one without a term have no matched
clause and the score of such texts; labels that are null are not learned from;
without labelled rows only the fixed list counts; repeated rows are scored
alike; columns named like the added ones are left out of the result; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, prepare

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# The seed words of each class (English, German, French, Spanish).
SEED_WORDS = {
    INSULT: "idiot stupid moron scum loser pathetic worthless disgusting trash clown dummkopf abschaum imbécile crétin estúpido imbécil",
    THREAT: "kill hurt destroy murder töten umbringen tuer détruire matar destruir",
    TARGET: "you your yourself he she they them du dich ihr euch tu toi vous tú usted ustedes",
    NEGATION: "not never no nicht kein nie niemals ne pas jamais nunca jamás",
    REPORT: "said says wrote called claimed quoted sagte schrieb behauptete dit écrit affirme dijo escribió afirma",
}
SEED_WEIGHT = 3.0
PREFIXES = (3, 4, 5, 6, 7, 8)
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
NEGATION_REACH, TARGET_REACH = 3, 4
NEGATED, REPORTED, TARGETED, THREATENED = 0.25, 0.5, 1.5, 1.5
# A learned term: least share of toxic texts, least log odds, most terms.
LEAST_SHARE = 0.004
LEAST_ODDS = 1.5
MAX_TERMS = 2_000
CANDIDATES = 50_000
_CLAUSE_END = np.zeros(256, bool)
_CLAUSE_END[list(b".!?;\n")] = True
FEATURES = ("clause_max", "clause_sum", "clause_rate", "clauses")


@dataclass(frozen=True)
class Transducer:
    """``step[state, class]`` is the next state, ``gain[state, class]`` the factor on a term's weight."""

    step: np.ndarray
    gain: np.ndarray


def fading(trigger: int, reach: int, factor: float) -> Transducer:
    """After ``trigger`` the factor holds for ``reach`` words; 0 reach means to the end of the clause."""
    states = reach + 1 if reach else 2
    step = np.zeros((states, 6), int)
    gain = np.ones((states, 6))
    for s in range(states):
        step[s, :] = s if not reach else max(s - 1, 0)
        step[s, trigger] = states - 1
        if s:
            gain[s, [INSULT, THREAT]] = factor
    return Transducer(step, gain)


def passing(term: int, factor: float) -> Transducer:
    """Lets the weights of one class through with ``factor``; one state."""
    gain = np.ones((1, 6))
    gain[0, term] = factor
    return Transducer(np.zeros((1, 6), int), gain)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that runs both: states are pairs, gains multiply."""
    n, m = len(a.step), len(b.step)
    i, j = np.divmod(np.arange(n * m), m)
    return Transducer(a.step[i] * m + b.step[j], a.gain[i] * b.gain[j])


def grammar() -> Transducer:
    machine = compose(passing(INSULT, 1.0), passing(THREAT, THREATENED))
    machine = compose(machine, fading(NEGATION, NEGATION_REACH, NEGATED))
    machine = compose(machine, fading(REPORT, 0, REPORTED))
    return compose(machine, fading(TARGET, TARGET_REACH, TARGETED))


def run_clause(machine: Transducer, behind: Transducer, classes: Sequence[int], weights: Sequence[float]) -> float:
    """Sum of the weights the machine lets through; ``behind`` reads the clause from its end."""
    after = [1.0] * len(classes)
    state = 0
    for i in range(len(classes) - 1, -1, -1):
        after[i] = behind.gain[state, classes[i]]
        state = behind.step[state, classes[i]]
    total, state = 0.0, 0
    for c, w, late in zip(classes, weights, after, strict=True):
        if w:
            total += w * machine.gain[state, c] * late
        state = machine.step[state, c]
    return total


@dataclass(frozen=True)
class Lexicon:
    """Term hashes in ascending order, with class and weight."""

    keys: np.ndarray
    classes: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(terms: dict[int, tuple[int, float]]) -> Lexicon:
        keys = np.array(sorted(terms), np.uint64)
        return Lexicon(
            keys,
            np.array([terms[int(k)][0] for k in keys], np.int64),
            np.array([terms[int(k)][1] for k in keys], float),
        )

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of each hash (``OTHER`` and 0 where unknown)."""
        if not len(self.keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h))
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        known = self.keys[at] == h
        return np.where(known, self.classes[at], OTHER), np.where(known, self.weights[at], 0.0)


def _salted(h: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return textops.splitmix(h + np.uint64(1000 + size))


def word_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(word numbers, hashes)`` of whole words and of their beginnings."""
    out = [(np.arange(len(whole)), whole)]
    if not len(starts):
        return out
    lo = int(starts[0])
    for size in PREFIXES:
        long_ = np.flatnonzero(ends - starts > size)
        for part in np.array_split(long_, max(1, int(ends[-1] - lo) // (4 * textops.BLOCK_BYTES))):
            if len(part):
                base, top = int(starts[part[0]]), int(ends[part[-1]])
                s = starts[part] - base
                out.append((part, _salted(textops.hash_spans(raw[base:top], s, s + size, True), size)))
    return out


def seed_terms() -> dict[int, tuple[int, float]]:
    terms = {}
    for cls, words in SEED_WORDS.items():
        raw, offsets = textops.text_buffers(pa.array([words]))
        h, *_ = textops.word_spans(raw, offsets, True, textops.NOT_LETTER)
        for x in h.tolist():
            terms[x] = (cls, SEED_WEIGHT if cls in (INSULT, THREAT) else 0.0)
    return terms


def measure(column: pa.Array, lexicon: Lexicon, machine: Transducer, behind: Transducer) -> np.ndarray:
    """``FEATURES`` of every text: largest and summed clause score, score per 100 words, matched clauses."""
    raw, offsets = textops.text_buffers(column)
    out = np.zeros((len(column), len(FEATURES)))
    for a, b in textops.blocks(offsets):
        whole, starts, ends, at = textops.word_spans(raw, offsets[a : b + 1], True, textops.NOT_LETTER)
        if not len(whole):
            continue
        classes, weights = np.zeros(len(whole), np.int64), np.zeros(len(whole))
        for words, h in word_features(raw, starts, ends, whole):
            c, w = lexicon.find(h)
            # A word has its heaviest term's weight; classes without weight come from whole words only.
            better = (w > weights[words]) | ((classes[words] == OTHER) & (c != OTHER))
            classes[words[better]], weights[words[better]] = c[better], w[better]
        terms = np.flatnonzero(weights > 0)
        if not len(terms):
            continue
        lo = int(offsets[a])
        breaks = np.concatenate([[0], np.cumsum(_CLAUSE_END[raw[lo : int(offsets[b])]])])
        owner = textops.owners(at)
        clause = breaks[starts - lo] + owner  # a new text is a new clause
        first = np.searchsorted(clause, clause[terms], side="left")
        last = np.searchsorted(clause, clause[terms], side="right")
        new = np.concatenate([[True], first[1:] != first[:-1]])
        for f, e in zip(first[new].tolist(), last[new].tolist(), strict=True):
            value = run_clause(machine, behind, classes[f:e].tolist(), weights[f:e].tolist())
            row = out[a + owner[f]]
            row[0] = max(row[0], value)
            row[1] += value
            row[3] += 1
        out[a:b, 2] = 100.0 * out[a:b, 1] / np.maximum(np.diff(at), 1)
    return out


def design(features: np.ndarray) -> np.ndarray:
    """Inputs of the logistic function."""
    top, total, rate, clauses = features.T
    return np.stack(
        [np.ones(len(top)), np.log1p(top), np.log1p(total), np.log1p(rate), np.log1p(clauses), (clauses > 0) * 1.0], axis=1
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 60) -> np.ndarray:
    """Penalised logistic regression by Newton's method (the first column is the intercept)."""
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_rows: int) -> DataFrame:
    """``y, text`` of at most about ``train_rows`` labelled documents."""
    known = labels.where(col(label_col).isNotNull()).select(
        col(id_col).alias("_id"), col(label_col).cast("int").alias("y")
    )
    n = known.count()
    share = min(1.0, train_rows / n) if n else 1.0
    key = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("toxic")), F.lit(1 << 20))
    picked = known.where(key < int(share * (1 << 20)) if share < 1 else F.lit(True))
    picked = picked.groupBy("_id").agg(F.max("y").alias("y"))  # of several labels the largest
    # At most about train_rows ids: a proven bound.
    return docs.join(F.broadcast(picked), col(id_col) == F.col("_id")).select("y", col(text_col).alias("text"))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Lexicon and weights from labelled documents (``labels`` holds the rows to learn from)."""
    prepare(docs.sparkSession)
    sample = _labelled(docs, labels, id_col, text_col, label_col, train_rows).persist()
    totals = {r["y"]: r["c"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("c")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    terms = seed_terms()
    if toxic and clean:
        terms = _learn_terms(sample, toxic, clean) | terms
    lexicon = Lexicon.of(terms)
    weights = np.array([-2.0, 1.0, 0.0, 0.0, 0.0, 1.0])
    if toxic and clean:
        weights = _learn_weights(sample, lexicon)
    sample.unpersist()
    return Model(lexicon, weights)


def _features_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Label and distinct term hashes of every text of a batch ``(y, text)``."""
    raw, offsets = textops.text_buffers(batch.column("text"))
    ys = batch.column("y").to_pylist()
    for i, y in enumerate(ys):
        whole, starts, ends, _ = textops.word_spans(raw, offsets[i : i + 2], True, textops.NOT_LETTER)
        yield y, np.unique(np.concatenate([h for _, h in word_features(raw, starts, ends, whole)]))


def _counted(sample: DataFrame, only: np.ndarray | None) -> DataFrame:
    """``term, c``: documents that hold a term, counted per task first; ``only`` limits the terms."""
    shared = None if only is None else sample.sparkSession.sparkContext.broadcast(only)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [h for _, h in _features_of(batch)]
            if shared is not None:
                found = [h[np.isin(h, shared.value)] for h in found]
            if found:
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["term", "c"])

    return sample.mapInArrow(task, "term long, c long").groupBy("term").agg(F.sum("c").alias("c"))


def _learn_terms(sample: DataFrame, toxic: int, clean: int) -> dict[int, tuple[int, float]]:
    least = max(4, int(LEAST_SHARE * toxic))
    held = (
        _counted(sample.where("y = 1"), None).where(F.col("c") >= least).orderBy(F.desc("c"), "term").limit(CANDIDATES).collect()
    )
    keys = np.array([r["term"] for r in held], np.int64).view(np.uint64)
    in_clean = {r["term"]: r["c"] for r in _counted(sample.where("y = 0"), keys).collect()}
    odds = []
    for r in held:
        c = in_clean.get(r["term"], 0)
        p, q = (r["c"] + 0.5) / (toxic + 1), (c + 0.5) / (clean + 1)
        odds.append((np.log(p / q), r["c"], r["term"]))
    best = sorted((o for o in odds if o[0] >= LEAST_ODDS), key=lambda o: (-o[0] * np.sqrt(o[1]), o[2]))[:MAX_TERMS]
    return {int(t) & ((1 << 64) - 1): (INSULT, float(o)) for o, _, t in best}


def _learn_weights(sample: DataFrame, lexicon: Lexicon) -> np.ndarray:
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, behind = grammar(), fading(TARGET, TARGET_REACH, TARGETED)
        for batch in batches:
            f = measure(batch.column("text"), shared.value, machine, behind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), *[pa.array(f[:, i]) for i in range(f.shape[1])]], names=["y", *FEATURES]
            )

    ddl = "y int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = sample.mapInArrow(task, ddl).toPandas()  # the bounded sample: a few numbers a row
    return fit_logistic(design(rows[list(FEATURES)].to_numpy(float)), rows["y"].to_numpy(float))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` and the clause features added."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    added = ["score", "predicted", *FEATURES]
    kept = [c for c in docs.columns if c.lower() not in added and (keep_text or c != text_col)]
    chosen = docs.select(*[col(c) for c in kept])
    new = {"score": F.lit(0.0), "predicted": F.lit(0), **{f: F.lit(0.0) for f in FEATURES}}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, behind = grammar(), fading(TARGET, TARGET_REACH, TARGETED)
        for batch in batches:
            f = measure(batch.column(batch.num_columns - 1), shared.value.lexicon, machine, behind)
            p = 1.0 / (1.0 + np.exp(-np.clip(design(f) @ shared.value.weights, -30, 30)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(p), pa.array((p >= threshold).astype(np.int32)), *[pa.array(f[:, i]) for i in range(f.shape[1])]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *added])

    source = docs.select(*[col(c) for c in kept], col(text_col).alias("_text"))
    return map_batches(source, task, chosen.withColumns(new).schema)
