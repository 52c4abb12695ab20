"""Quality rules on repetition inside a text, from a suffix array of its words.

The suffixes of a block of documents are sorted together by prefix doubling;
the first key holds the document, so suffixes of different documents never
share a prefix.  Longest-common-prefix values of neighbours follow from the
ranks kept at every doubling.  A maximal repeated substring is an
LCP interval; the innermost interval around a suffix has the larger of its two
neighbouring LCP values as length, which is the longest repeat that starts
there.  The union of those spans over all suffixes therefore is the union of
all maximal repeats (a repeat that can be extended to the left lies inside the
extension).  A document is dropped when repeats of at least ``min_words``
words cover too much of it, or when one repeat alone is too long a part.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; columns named like the added ones are left out of the result;
repeated rows are judged alike; an empty table gives an empty result.  Texts
are processed whole; memory is about 4 bytes per word and doubling, and
doublings end at the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, map_batches, prepare

# The base rules.
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
# The method's limits: repeats from this many words on count; the part of a
# document that they may cover; the part that one repeat may take.
REPEAT_WORDS = 8
MAX_COVERED = 0.45
MAX_LONGEST = 0.3
_SPACES = " \t\n\v\f\r"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def longest_repeats(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every word position, the length of the longest repeat that starts there.

    ``words`` are word hashes of consecutive documents, ``offsets`` their
    bounds.  Repeats stay inside a document and may overlap themselves.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    owner = textops.owners(offsets)
    end = offsets[1:][owner]
    with np.errstate(over="ignore"):
        key = textops.splitmix(words + textops.splitmix(owner.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int32)
    head = _heads(key[order])
    rank[order] = head
    levels = [rank.copy()]
    tied = _tied(order, head)
    width = 1
    while len(tied):
        after = tied + width
        second = np.full(len(tied), -1, np.int64)
        ok = after < end[tied]
        second[ok] = rank[after[ok]]
        pair = rank[tied].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(pair, kind="stable")
        tied, pair = tied[by], pair[by]
        group = rank[tied]
        # A subgroup's rank is its group's rank plus its start inside the group.
        starts = np.searchsorted(group, group, side="left")
        new = (group + _heads(pair) - starts).astype(np.int32)
        rank[tied] = new
        levels.append(rank.copy())
        tied = _tied(tied, new)
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    a, b = left.copy(), right.copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    live = np.arange(len(common))
    for level in range(len(levels) - 1, -1, -1):
        size, ranks = 1 << level, levels[level]
        can = live[(a[live] + size <= end[left[live]]) & (b[live] + size <= end[right[live]])]
        same = can[ranks[a[can]] == ranks[b[can]]]
        a[same] += size
        b[same] += size
        common[same] += size
        live = live[(a[live] < end[left[live]]) & (b[live] < end[right[live]])]
    best = np.zeros(n, np.int64)
    best[left] = common
    best[right] = np.maximum(best[right], common)
    return best


def _heads(sorted_keys: np.ndarray) -> np.ndarray:
    """For each entry of a sorted array, the index of the first equal entry."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    at = np.where(new, np.arange(len(sorted_keys)), 0)
    return np.maximum.accumulate(at)


def _tied(positions: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The positions whose (sorted) group has another member."""
    if len(groups) < 2:
        return positions[:0]
    same = groups[1:] == groups[:-1]
    flag = np.zeros(len(groups), bool)
    flag[1:] |= same
    flag[:-1] |= same
    return positions[flag]


def covered(best: np.ndarray, offsets: np.ndarray, least: int, longest: int | None = None) -> np.ndarray:
    """Words per document inside spans ``[i, i + best[i])`` of at least ``least`` words.

    With ``longest`` every span counts with that length instead.
    """
    change = np.zeros(len(best) + 1, np.int64)
    at = np.flatnonzero(best >= least)
    np.add.at(change, at, 1)
    np.add.at(change, at + (best[at] if longest is None else longest), -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return inside[offsets[1:]] - inside[offsets[:-1]]


def _byte_counts(raw: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray):
    """Code points inside words, and symbol characters, per row."""
    lo = int(bounds[0])
    block = raw[lo : int(bounds[-1])]
    points = np.concatenate([[0], np.cumsum((block & 0xC0) != 0x80)])
    per_word = points[ends - lo] - points[starts - lo]
    chars = np.concatenate([[0], np.cumsum(per_word)])
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[block])])
    b = bounds - lo
    return chars[at[1:]] - chars[at[:-1]], symbols[b[1:]] - symbols[b[:-1]]


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line of the text."""
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return len(lines) - len(set(lines))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def measure(docs: DataFrame, text_col: str = "text", repeat_words: int = REPEAT_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts of every text (longs) added: base counts, covered words, longest repeat."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in _COUNTS and (keep_text or c != text_col)]
    source = docs.select(*[col(c) for c in kept], col(text_col).alias("_text"))
    schema = docs.select(*[col(c) for c in kept]).withColumns({c: F.lit(0).cast("long") for c in _COUNTS}).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            raw, offsets = textops.text_buffers(text)
            out = {c: [] for c in _COUNTS}
            for a, b in textops.blocks(offsets):
                bounds = offsets[a : b + 1]
                words, starts, ends, at = textops.word_spans(raw, bounds)
                chars, symbols = _byte_counts(raw, bounds, starts, ends, at)
                best = longest_repeats(words, at)
                out["n_words"].append(np.diff(at))
                out["word_chars"].append(chars)
                out["n_symbols"].append(symbols)
                out["n_repeat_words"].append(covered(best, at, WINDOW, WINDOW))
                out["covered_words"].append(covered(best, at, repeat_words))
                longest = np.zeros(b - a, np.int64)
                np.maximum.at(longest, textops.owners(at), best)
                out["longest_repeat"].append(longest)
            lines = np.array([duplicate_lines(t) for t in text.to_pylist()], np.int64)
            out["n_dup_lines"].append(lines)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(np.concatenate(out[c]) if out[c] else np.zeros(0, np.int64), pa.int64()) for c in _COUNTS]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *_COUNTS])

    return map_batches(source, task, schema)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    repeat_words: int = REPEAT_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: float = MAX_LONGEST,
    keep_text: bool = True,
) -> DataFrame:
    """``measure`` plus ``base_failed``, ``repetitive`` and ``kept``."""
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * REPEAT_PERCENT)
    repetitive = (F.col("covered_words") > n * max_covered) | (F.col("longest_repeat") > n * max_longest)
    return (
        measure(docs, text_col, repeat_words, keep_text)
        .withColumn("base_failed", base)
        .withColumn("repetitive", repetitive & (n > 0))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("repetitive"))
    )
