"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1/-1 entries; a letter trigram is bound
from three of them, the first two permuted (rotated) by their distance from
the end; a document's vector is the bundle (sum) of its trigrams' vectors, and
a language's prototype the sum of its documents' unit vectors.  A document
gets the language whose prototype has the largest cosine with it.

Texts are lower-cased; characters that are not letters only separate words,
and a word's edges count as a letter, so short function words leave a trace.
Prototypes are learned from at most about ``train_rows`` documents (a hash of
the id picks them), counted over the whole table; the bound is a parameter.
Vectors are summed inside each task, and one row per task and language is
shuffled.

Defined cases: a null text or one without letters is ``und`` with score 0;
documents with a null language are not learned from; without any learnable
document everything is ``und``; equal cosines go to the language first by code
point; an empty table gives an empty result; repeated rows are judged alike;
a very long text is judged whole, its distinct trigrams bound in blocks;
columns named like the added ones are left out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens.llm.common import col, map_batches, prepare

UNKNOWN = "und"
DIMENSIONS = 1024
TRAIN_ROWS = 20_000
# Bound of the cosine for a long text; a shorter one with n distinct trigrams needs n / (n + HALF) of it, and one with
# fewer than JUDGED trigrams is too short to be rejected.
MIN_COSINE = 0.35
HALF = 40
JUDGED = 20
# Sharpness of the confidence: a softmax over the cosines.
SHARPNESS = 30.0
# Trigrams of one text bound at a time.
_BLOCK = 4096
_EDGE = 0
_LETTERS: dict[str, np.ndarray] = {}
_VECTORS: dict[tuple[int, int], np.ndarray] = {}


def _is_letter() -> np.ndarray:
    if "t" not in _LETTERS:
        _LETTERS["t"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _LETTERS["t"]


def letter_vectors(codes: np.ndarray, dims: int) -> np.ndarray:
    """The fixed random +1/-1 vectors of some letters, one row each (cached per letter)."""
    for c in np.unique(codes).tolist():
        if (c, dims) not in _VECTORS:
            if len(_VECTORS) > 20_000:
                _VECTORS.clear()
            bits = np.random.Generator(np.random.PCG64([int(c), 7])).integers(0, 2, dims, dtype=np.int8)
            _VECTORS[(c, dims)] = bits * 2 - 1
    names, at = np.unique(codes, return_inverse=True)
    return np.stack([_VECTORS[(int(c), dims)] for c in names])[at]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text as an (n, 3) array, and their counts."""
    none = np.empty((0, 3), np.int64), np.empty(0, np.int64)
    if not text:
        return none
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(_is_letter()[codes], codes, _EDGE)
    codes = np.concatenate([[_EDGE], codes, [_EDGE]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _EDGE) | (codes[:-1] != _EDGE)
    codes = codes[keep]
    if len(codes) < 3:
        return none
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    inside = b != _EDGE
    keys, counts = np.unique((a[inside] << 42) | (b[inside] << 21) | c[inside], return_counts=True)
    mask = (1 << 21) - 1
    return np.stack([keys >> 42, (keys >> 21) & mask, keys & mask], axis=1), counts


def bundle(text: str | None, dims: int = DIMENSIONS) -> np.ndarray:
    """The vector of a text: the sum of its trigrams' bound vectors (zeros without letters)."""
    return bundle_trigrams(*trigrams(text), dims)


def bundle_trigrams(grams: np.ndarray, counts: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """The sum of the bound vectors of some trigrams, each as often as it occurs."""
    total = np.zeros(dims, np.float32)
    if not len(grams):
        return total
    letters, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    plain = letter_vectors(letters, dims)
    first, second = np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1)
    for i in range(0, len(grams), _BLOCK):
        j = slice(i, i + _BLOCK)
        bound = first[at[j, 0]] * second[at[j, 1]] * plain[at[j, 2]]
        total += counts[j].astype(np.float32) @ bound.astype(np.float32)
    return total


def _unit(v: np.ndarray) -> np.ndarray:
    n = float(np.linalg.norm(v))
    return v / n if n else v


@dataclass(frozen=True)
class Prototypes:
    """Languages in code-point order and their unit prototype vectors."""

    languages: list[str]
    vectors: np.ndarray

    def cosines(self, v: np.ndarray) -> np.ndarray:
        return self.vectors @ _unit(v)


def learn(
    docs: DataFrame,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dims: int = DIMENSIONS,
    train_rows: int = TRAIN_ROWS,
) -> Prototypes:
    """Prototypes from the learnable documents with a text and a language."""
    prepare(docs.sparkSession)
    usable = docs.where(learnable & col(lang_col).isNotNull())
    n = usable.count()
    share = min(1.0, train_rows / n) if n else 1.0
    picked = usable
    if share < 1.0:
        key = F.pmod(F.xxhash64(col(id_col).cast("string"), F.lit("langid")), F.lit(1 << 20))
        picked = usable.where(key < int(share * (1 << 20)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                v = _unit(bundle(text.as_py(), dims)).astype(np.float64)
                sums[lang.as_py()] = sums.get(lang.as_py(), 0.0) + v
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "v": [s.tolist() for s in sums.values()]},
                schema=pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))]),
            )

    # One row per task and language; summed entry by entry.
    sums = (
        picked.select(col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
        .mapInArrow(task, "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    )
    rows = sorted((r["lang"], [p["x"] for p in r["v"]]) for r in sums.collect())  # one row per language
    found = [(lang, _unit(np.array(v))) for lang, v in rows if np.any(v)]
    vectors = np.stack([v for _, v in found]) if found else np.zeros((0, dims))
    return Prototypes([lang for lang, _ in found], vectors.astype(np.float32))


def identify(
    docs: DataFrame,
    prototypes: Prototypes,
    text_col: str = "text",
    dims: int = DIMENSIONS,
    keep_text: bool = True,
    with_size: bool = False,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (confidence, 0 to 1) and ``cosine`` added.

    ``with_size`` adds ``n_trigrams``, the number of distinct trigrams.
    With ``keep_text=False`` the text column is left out of the result.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(prototypes)  # languages x dims numbers
    new = {"lang_pred": F.lit(""), "score": F.lit(0.0), "cosine": F.lit(0.0)}
    if with_size:
        new["n_trigrams"] = F.lit(0).cast("long")
    added = tuple(new)
    kept = [c for c in docs.columns if c.lower() not in added and (keep_text or c != text_col)]
    source = docs.select(*[col(c) for c in kept], col(text_col).alias("_text"))
    schema = docs.select(*[col(c) for c in kept]).withColumns(new).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lang, score, cosine, size = [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                grams, counts = trigrams(text.as_py())
                v = bundle_trigrams(grams, counts, dims)
                size.append(len(grams))
                if not known.languages or not v.any():
                    lang.append(UNKNOWN), score.append(0.0), cosine.append(0.0)
                    continue
                c = known.cosines(v).astype(np.float64)
                best = int(np.argmax(c))
                weight = np.exp(SHARPNESS * (c - c[best]))
                lang.append(known.languages[best])
                score.append(float(1.0 / weight.sum()))
                cosine.append(float(c[best]))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            found = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(cosine, pa.float64())]
            found += [pa.array(size, pa.int64())] if with_size else []
            yield pa.RecordBatch.from_arrays([*columns, *found], names=[*names, *added])

    return map_batches(source, task, schema)


def resembles(cosine: str = "cosine", n_trigrams: str = "n_trigrams", lang_pred: str = "lang_pred") -> Column:
    """Whether a judged text resembles a learned language.

    A text without letters does not; one too short to judge is given the
    benefit of the doubt; the bound on the cosine grows with the text.
    """
    n = F.col(n_trigrams)
    far = (n >= JUDGED) & (F.col(cosine) < F.lit(MIN_COSINE) * n / (n + HALF))
    return (F.col(lang_pred) != UNKNOWN) & ~far
