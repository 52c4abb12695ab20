"""Line dedup: an exact set-similarity join over all lines of a corpus.

A line's set holds the hashes of its distinct words (A-Z lower-cased).  Lines
are ordered by document id and line number; a line is removed when an earlier
one has a set of Jaccard ``num/den`` or more.

1. Words are counted in a fixed number of hash buckets; (rarity class, hash) is
   the order of every set, the same everywhere.
2. A line posts the first ``n - ceil(num * n / den) + 1`` of its words (prefix
   filter), once per task for equal sets (again where a task meets an earlier
   place of the set), with its size, the word's position and a 128-bit sketch.
3. Postings meet by word, the earliest of each set.  The length filter bounds
   each line's partners, the positional filter bounds the words that can still be
   common, and the sketch bounds them again (differing bits are words that
   differ); all three only drop pairs that cannot match.
4. Surviving pairs are verified on the whole sets.

A line needs one earlier match only.  In a word's list each line first offers
its ``offers`` earliest partners and looks no further; the few lines that had
more and found no match offer all of them in a second pass, so a family of
copies that match costs work in proportion to its size and no match is lost.
Pairs are made and cut a bounded number at a time.  Many lines of one word that
resemble but do not match are still compared pair by pair, in the word's task.

Sets are compared by 64-bit word hashes; equal sets are found by 128-bit sums.

Defined cases: lines without a word are never removed; a null text stays null;
null ids come last; equal ids with different texts are different documents,
ordered by line, then a hash of the text; repeated rows (same id and text)
count as one document and stay alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, hashed_counts, prepare, store

NUM, DEN = 80, 100
OFFERS = 8
COUNT_BITS = 20
FILTER_BITS = 21
_SEEN = 200_000  # line sets that a task remembers, to post each once
_PAIRS = 1 << 20  # pairs looked at together
_SHORT = 512  # entries of a token up to which all its pairs are looked at together
_ROWS = 1024  # entries of a longer one that look for partners together
_FIRST = 64  # entries that these meet first
_LAST = (1 << 63) - 1  # order of a null id

_PROFILE = (
    "id long, key long, line int, n int, s1 long, s2 long, b1 long, b2 long, words array<long>"
)


def _rarity(counts: np.ndarray) -> np.ndarray:
    """Rarity class of each bucket (0 rarest), four per doubling of the count."""
    return np.minimum(4 * np.log2(np.maximum(counts, 1)), 255).astype(np.uint8)


def _line_sets(raw: np.ndarray, bounds: np.ndarray, rarity: np.ndarray):
    """Distinct words of each line with a word, in set order.

    Returns words, offsets per line, the row and the line number of each line.
    """
    words, starts, _, _ = textops.word_spans(raw, bounds, lower=True)
    cuts, line_at = textops.line_bounds(raw, bounds)
    line_of = np.searchsorted(cuts[1:], starts, side="right")
    fresh = np.ones(len(words), bool)
    fresh[1:] = line_of[1:] != line_of[:-1]
    present, of = line_of[fresh], np.cumsum(fresh) - 1
    level = rarity[(words & np.uint64(len(rarity) - 1)).astype(np.int64)].astype(np.uint64)
    if len(present) < (1 << 20):
        # One sort by (line, rarity, hash); hashes cut to 36 bits are told apart below.
        key = (of.astype(np.uint64) << np.uint64(44)) | (level << np.uint64(36)) | (words >> np.uint64(28))
        order = np.argsort(key)
        w, o, k = words[order], of[order], key[order]
        if np.any((k[1:] == k[:-1]) & (w[1:] != w[:-1])):
            order = None
    else:
        order = None
    if order is None:
        order = np.lexsort((words, words >> np.uint64(28), level, of))
        w, o = words[order], of[order]
    if len(w):
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
        w, o = w[new], o[new]
    at = np.searchsorted(o, np.arange(len(present) + 1)).astype(np.int64)
    row = np.searchsorted(line_at[1:], present, side="right")
    return w, at, row, present - line_at[row]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return (run[at[1:]] - run[at[:-1]]).view(np.int64)


def _signatures(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(textops.splitmix(words), at), _sums(textops.splitmix(words ^ np.uint64(0x3C6EF372FE94F82B)), at)


def _sketch(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words per line; each word of the line sets one of the 128 bits."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spread = textops.splitmix(words + np.uint64(11))
    bit = np.uint64(1) << (spread & np.uint64(63))
    high = ((spread >> np.uint64(6)) & np.uint64(1)).astype(bool)
    b1 = np.bitwise_or.reduceat(np.where(high, np.uint64(0), bit), at[:-1])
    b2 = np.bitwise_or.reduceat(np.where(high, bit, np.uint64(0)), at[:-1])
    return b1.view(np.int64), b2.view(np.int64)


def _profiles(rows: DataFrame, counts: np.ndarray, num: int, den: int) -> DataFrame:
    """One row per line with a word; ``words`` is its prefix, null where its task has posted the set from an earlier place."""
    shared = rows.sparkSession.sparkContext.broadcast(_rarity(counts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        for batch in batches:
            ids = batch.column("id").to_numpy()
            raw, offsets = textops.text_buffers(batch.column("text"))
            for a, b in textops.blocks(offsets):
                w, at, row, line = _line_sets(raw, offsets[a : b + 1], shared.value)
                if not len(row):
                    continue
                n = np.diff(at)
                s1, s2 = _signatures(w, at)
                b1, b2 = _sketch(w, at)
                send = np.zeros(len(n), bool)
                places = zip(ids[row + a].tolist(), line.tolist(), strict=True)
                for i, (s, p) in enumerate(zip(s1.tolist(), places, strict=True)):
                    if s not in seen or p < seen[s]:
                        seen[s] = p
                        send[i] = True
                if len(seen) > _SEEN:
                    seen.clear()
                length = n - (n * num + den - 1) // den + 1
                owner = textops.owners(at)
                take = send[owner] & ((np.arange(len(w)) - at[owner]) < length[owner])
                ends = np.concatenate([[0], np.cumsum(np.where(send, length, 0))]).astype(np.int32)
                which = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(which),
                        batch.column("key").take(which),
                        pa.array(line.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(s1),
                        pa.array(s2),
                        pa.array(b1),
                        pa.array(b2),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(w[take].view(np.int64))),
                    ],
                    names=["id", "key", "line", "n", "s1", "s2", "b1", "b2", "words"],
                )
        del seen
        textops.give_back()

    return rows.mapInArrow(task, _PROFILE)


_POSTING = ("token", "n", "doc", "line", "s1", "at", "b1", "b2")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[dict[str, np.ndarray]]:
    """Arrays of whole tokens from batches sorted by token."""
    rest: list[dict[str, np.ndarray]] = []
    held = 0
    for batch in batches:
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if not batch.num_rows:
            continue
        rest.append(now)
        held += batch.num_rows
        last = now["token"][-1]
        if rest[0]["token"][0] == last or held < 50_000:
            continue
        whole = {c: np.concatenate([r[c] for r in rest]) for c in names}
        cut = int(np.searchsorted(whole["token"] == last, True)) if last == whole["token"][-1] else held
        yield {c: v[:cut] for c, v in whole.items()}
        rest, held = [{c: v[cut:] for c, v in whole.items()}], held - cut
    if held:
        yield {c: np.concatenate([r[c] for r in rest]) for c in names}


def _passing(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether pairs pass the length, positional and sketch filters."""
    a, b = g["n"][i].astype(np.int64), g["n"][j].astype(np.int64)
    ok = (np.minimum(a, b) * den >= np.maximum(a, b) * num) & (
        np.minimum(a - g["at"][i], b - g["at"][j]) * (num + den) >= (a + b) * num
    )
    i, j, a, b = i[ok], j[ok], a[ok], b[ok]
    apart = textops.differing_bits(g["b1"][i], g["b1"][j]) + textops.differing_bits(g["b2"][i], g["b2"][j])
    # Each differing bit is a word of one line only: common <= (a + b - apart) / 2.
    ok[ok] = (a + b - apart) * (num + den) >= 2 * num * (a + b)
    return ok


def _earliest(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One entry per token and set, its earliest; tokens of one set only are left out."""
    order = np.lexsort((g["line"], g["doc"], g["s1"], g["token"]))
    g = {c: v[order] for c, v in g.items()}
    t, s = g["token"], g["s1"]
    first = np.ones(len(t), bool)
    first[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
    g = {c: v[first] for c, v in g.items()}
    t = g["token"]
    alone = np.ones(len(t), bool)
    if len(t) > 1:
        same = t[1:] == t[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
    return {c: v[~alone] for c, v in g.items()}


_Pairs = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _pairs_of_group(g: dict[str, np.ndarray], num: int, den: int, offers: int | None) -> _Pairs:
    """Passing pairs ``(earlier entries, later entries, later entries that may have more)`` of whole tokens, some at a time.

    An entry meets the entries before it: its ``offers`` earliest partners, or
    all of them.  Entries of one place (equal or null ids) meet both ways, since
    texts decide there.  With ``wanted``, only those entries look for partners.
    """
    t = g["token"]
    starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
    size = np.diff(np.append(starts, len(t)))
    some = np.flatnonzero(np.repeat(size <= _SHORT, size))
    if len(some):
        for x, y, more in _pairs_of_short({c: v[some] for c, v in g.items()}, num, den, offers):
            yield some[x], some[y], some[more]
    for a, m in zip(starts[size > _SHORT].tolist(), size[size > _SHORT].tolist(), strict=True):
        for x, y, more in _pairs_of_long({c: v[a : a + m] for c, v in g.items()}, num, den, offers):
            yield x + a, y + a, more + a


def _places(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the entries by place, and the number of each ordered entry's place."""
    order = np.lexsort((g["s1"], g["line"], g["doc"]))
    doc, line = g["doc"][order], g["line"][order]
    new = np.zeros(len(order), np.int64)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    return order, np.cumsum(new)


def _pairs_of_short(g: dict[str, np.ndarray], num: int, den: int, offers: int | None) -> _Pairs:
    """Tokens of few entries, many together.

    Entries are compared in order of size, each with the following ones that
    the length filter allows; whole tokens of a bounded number of pairs at a time.
    """
    order = np.lexsort((g["n"], g["token"]))
    g = {c: v[order] for c, v in g.items()}
    t, n = g["token"], g["n"].astype(np.int64)
    by_place, number = _places(g)
    rank, place = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
    rank[by_place], place[by_place] = np.arange(len(t)), number
    starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(t))))
    scale = int(n.max()) + 2
    reach = np.minimum(n * den // num, scale - 1)
    # Entries after i in its group that are at most den/num times as large.
    stop = np.searchsorted(group * scale + n, group * scale + reach, side="right")
    # The smaller line of a match has its first common word early enough; the rest need not look.
    looks = (n - g["at"]) * (num + den) >= 2 * n * num
    width = np.where(looks, np.maximum(stop - np.arange(len(n)) - 1, 0), 0)
    upto = np.concatenate([[0], np.cumsum(width)])
    bounds = np.append(starts, len(t))
    k = 0
    while k < len(starts):
        last = max(int(np.searchsorted(upto[bounds], upto[bounds[k]] + _PAIRS, side="right")) - 1, k + 1)
        at, end = int(bounds[k]), int(bounds[last])
        k = last
        w = width[at:end]
        i = np.repeat(np.arange(at, end), w)
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[at:end] - upto[at], w)
        if "wanted" in g:
            asked = (g["wanted"][i] + g["wanted"][j]) > 0
            i, j = i[asked], j[asked]
        ok = _passing(g, i, j, num, den)
        i, j = i[ok], j[ok]
        before, after = place[i] <= place[j], place[j] <= place[i]
        x, y = np.concatenate([i[before], j[after]]), np.concatenate([j[before], i[after]])
        if "wanted" in g:
            asked = g["wanted"][y] > 0
            x, y = x[asked], y[asked]
        more = np.zeros(0, np.int64)
        if offers is not None and len(x):
            by = np.argsort(y * len(t) + rank[x])
            x, y = x[by], y[by]
            nth = np.arange(len(y)) - np.searchsorted(y, y, side="left")
            more = np.unique(y[nth >= offers])
            x, y = x[nth < offers], y[nth < offers]
        yield order[x], order[y], order[more]


def _pairs_of_long(g: dict[str, np.ndarray], num: int, den: int, offers: int | None) -> _Pairs:
    """One token of many entries.

    Some entries at a time meet the list from its earliest entry on, block by
    block; an entry with ``offers`` partners looks no further, so a family of
    near copies meets little more than its earliest members.
    """
    order, number = _places(g)
    g = {c: v[order] for c, v in g.items()}
    n = g["n"].astype(np.int64)
    stop = np.searchsorted(number, number, side="right")
    least, most = -(-n * num // den), n * den // num
    asked = np.flatnonzero(g["wanted"] > 0) if "wanted" in g else np.arange(len(n))
    none = np.zeros(0, np.int64)
    for a in range(0, len(asked), _ROWS):
        live = asked[a : a + _ROWS]
        had = np.zeros(len(live), np.int64)
        lo, width = 0, _FIRST
        while len(live):
            other = np.arange(lo, min(lo + width, len(n)))
            near = (n[other] >= least[live, None]) & (n[other] <= most[live, None])
            near &= (other < stop[live, None]) & (other != live[:, None])
            r, x = np.nonzero(near)
            x += lo
            ok = _passing(g, x, live[r], num, den)
            r, x = r[ok], x[ok]
            lo += width
            left, more = stop[live] > lo, none
            if offers is not None:
                nth = np.arange(len(r)) - np.searchsorted(r, r, side="left") + had[r]
                had += np.bincount(r, minlength=len(live))
                more = live[(had > offers) | ((had == offers) & left)]
                x, r = x[nth < offers], r[nth < offers]
                left &= had < offers
            yield order[x], order[live[r]], order[more]
            live, had = live[left], had[left]
            width = max(min(2 * width, _PAIRS // max(len(live), 1)), 1)


def _candidates(postings: DataFrame, num: int, den: int, offers: int | None) -> DataFrame:
    """``x, dx, y, dy, token``: candidate pairs of line sets with a document of each; a null ``x`` marks a set with more partners."""
    names = (*_POSTING, "wanted") if "wanted" in postings.columns else _POSTING

    def rows_of(g: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        s, d, t = g["s1"], g["doc"], g["token"]
        # The same pair once, whichever way it was met.
        swap = (d[x] > d[y]) | ((d[x] == d[y]) & (s[x] > s[y]))
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        by = np.lexsort((s[x], s[y]))
        x, y = x[by], y[by]
        one = np.ones(len(x), bool)
        one[1:] = (s[x][1:] != s[x][:-1]) | (s[y][1:] != s[y][:-1])
        x, y = x[one], y[one]
        none = np.ones(len(more), bool)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(s[x]), pa.array(s[more], mask=none)]),
                pa.concat_arrays([pa.array(d[x]), pa.array(d[more], mask=none)]),
                pa.array(np.concatenate([s[y], s[more]])),
                pa.array(np.concatenate([d[y], d[more]])),
                pa.array(np.concatenate([t[y], t[more]])),
            ],
            names=["x", "dx", "y", "dy", "token"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, names):
            g = _earliest(g)
            if not len(g["token"]):
                continue
            found = _pairs_of_group(g, num, den, offers)
            if offers is not None:
                # A bounded number of pairs per entry; several words offer the same pair, so they are cut together.
                found = [tuple(map(np.concatenate, zip(*found, strict=True)))]
            for x, y, more in found:
                yield rows_of(g, x, y, more)

    met = postings.repartition("token").sortWithinPartitions("token")
    return met.mapInArrow(task, "x long, dx long, y long, dy long, token long")


def _bits_of(keys: DataFrame):
    """A broadcast bitmap of fixed size of the 64-bit values in a table's one column."""
    held = hashed_counts(
        keys, lambda batches: (b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches), FILTER_BITS
    )
    return keys.sparkSession.sparkContext.broadcast(np.packbits(held > 0))


def _among(shared, values: np.ndarray) -> np.ndarray:
    """Which values may be in the bitmap."""
    at = values.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    byte = shared.value[(at >> np.uint64(3)).astype(np.int64)]
    return (byte >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``s1, words`` (sorted hashes) of the wanted line sets ``(s1, doc)``; ``doc`` is a document that has it."""
    docs_held = _bits_of(wanted.select(F.xxhash64("doc").alias("h")))
    sets_held = _bits_of(wanted.select("s1"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.zeros(1 << 8, np.uint8)
        for batch in batches:
            some = batch.take(pa.array(np.flatnonzero(_among(docs_held, batch.column("h").to_numpy(zero_copy_only=False)))))
            raw, offsets = textops.text_buffers(some.column("text"))
            for a, b in textops.blocks(offsets):
                w, at, row, _ = _line_sets(raw, offsets[a : b + 1], flat)
                s1, _ = _signatures(w, at)
                hit = pa.array(_among(sets_held, s1))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc").take(pa.array(row + a)), pa.array(s1), textops.binary_column(w, at)],
                    names=["doc", "s1", "words"],
                ).filter(hit)

    docs = rows.select("doc", F.xxhash64("doc").alias("h"), "text")
    found = docs.mapInArrow(task, "doc long, s1 long, words binary")
    return found.join(wanted, ["s1", "doc"]).dropDuplicates(["s1"]).select("s1", "words")


def _verified(candidates: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``x, y`` whose whole sets are similar enough."""
    pairs = store(
        candidates.where("x is not null").groupBy("x", "y").agg(F.min("dx").alias("dx"), F.min("dy").alias("dy"))
    )
    ends = pairs.select(F.col("x").alias("s1"), F.col("dx").alias("doc")).union(pairs.select("y", "dy"))
    wanted = store(ends.groupBy("s1").agg(F.min("doc").alias("doc")))
    sets = store(_sets(rows, wanted))
    joined = pairs.select("x", "y").join(
        sets.select(F.col("s1").alias("x"), F.col("words").alias("p")), "x"
    ).join(sets.select(F.col("s1").alias("y"), F.col("words").alias("q")), "y")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (p, q) in enumerate(zip(batch.column("p"), batch.column("q"), strict=True)):
                a, b = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = common * (num + den) >= num * (len(a) + len(b))
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    return store(joined.select("x", "y", "p", "q").mapInArrow(task, "x long, y long"))


def removals(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUM, den: int = DEN, offers: int = OFFERS
) -> DataFrame:
    """``id, key, n_lines, removed`` for documents that lose lines: numbers (from 0) of the removed ones, ascending.

    ``key`` is a hash of the text; repeated rows have one result row.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        col(id_col).cast("long").alias("id"),
        F.coalesce(col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(col(text_col)).alias("key"),
        col(text_col).alias("text"),
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, _, h, _ in textops.word_blocks(batch.column(0), lower=True):
                yield h

    counts = hashed_counts(rows.select("text"), hashes, COUNT_BITS)
    lines = store(_profiles(rows.select(F.col("doc").alias("id"), "key", "text"), counts, num, den))
    postings = lines.where(F.size("words") > 0).select(
        F.posexplode("words").alias("at", "token"), "n", F.col("id").alias("doc"), "line", "s1", "b1", "b2"
    ).select(*_POSTING)
    offered = store(_candidates(postings, num, den, offers))
    matched = _verified(offered, rows, num, den)
    beaten = store(_beaten(matched, lines))

    # Sets that had more partners than were offered, and no earlier match yet.
    open_ = store(
        offered.where("x is null").select("y", "token").distinct().join(beaten.toDF("y"), "y", "left_anti")
    )
    if open_.limit(1).count():
        again = _postings_of(lines, open_.select("token").distinct()).join(
            open_.select(F.col("y").alias("s1")).distinct().withColumn("wanted", F.lit(1)), "s1", "left"
        )
        again = again.select(*_POSTING, F.coalesce("wanted", F.lit(0)).alias("wanted"))
        rest = _candidates(again, num, den, None).join(matched, ["x", "y"], "left_anti")
        beaten = store(beaten.union(_beaten(_verified(rest, rows, num, den), lines)).distinct())

    # A line goes when its set stands earlier (by 128 bits), or is beaten by a similar earlier set.
    place = F.struct(F.col("id"), F.col("line"), F.col("key"))
    count = F.count(F.lit(1)).alias("c")
    repeated = lines.groupBy("s1", "s2", "n").agg(count).where("c > 1").select("s1").distinct()
    flags = repeated.withColumn("beaten", F.lit(0)).union(beaten.select("s1", F.lit(1))).groupBy("s1").agg(
        F.max("beaten").alias("beaten")
    )
    touched = store(lines.select("id", "key", "line", "n", "s1", "s2").join(flags, "s1"))
    first = touched.where("beaten = 0").groupBy("s1", "s2", "n").agg(F.min(place).alias("first"))
    later = touched.where("beaten = 0").join(first, ["s1", "s2", "n"]).where(F.col("first") != place)
    gone = (
        touched.where("beaten = 1").select("id", "key", "line").union(later.select("id", "key", "line"))
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))
    )
    return gone.select(F.when(F.col("id") < _LAST, F.col("id")).alias("id"), "key", "removed")


def _beaten(matched: DataFrame, lines: DataFrame) -> DataFrame:
    """``s1`` of the sets that have a similar set with an earlier first line."""
    ends = matched.select(F.col("x").alias("s1")).union(matched.select("y")).distinct()
    first = lines.join(ends, "s1").groupBy("s1").agg(F.min(F.struct("id", "line", "key")).alias("first"))
    first = store(first)
    met = matched.join(first.toDF("x", "fx"), "x").join(first.toDF("y", "fy"), "y")
    return met.select(F.when(F.col("fx") < F.col("fy"), F.col("y")).otherwise(F.col("x")).alias("s1")).distinct()


def _postings_of(lines: DataFrame, tokens: DataFrame) -> DataFrame:
    """The postings of some words.  A fixed-size filter keeps most others from being shuffled; the join is exact."""
    held = _bits_of(tokens)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))
            token = words.flatten().to_numpy(zero_copy_only=False)
            at = np.arange(len(token)) - (words.offsets.to_numpy()[:-1] - words.offsets[0].as_py())[row]
            hit = _among(held, token)
            rows = pa.array(row[hit])
            columns = {c: batch.column(c).take(rows) for c in ("n", "line", "s1", "b1", "b2")}
            columns |= {"doc": batch.column("id").take(rows), "token": pa.array(token[hit]), "at": pa.array(at[hit].astype(np.int32))}
            yield pa.RecordBatch.from_arrays([columns[c] for c in _POSTING], names=list(_POSTING))

    ddl = "token long, n int, doc long, line int, s1 long, at int, b1 long, b2 long"
    some = lines.where(F.size("words") > 0).select("id", "line", "n", "s1", "b1", "b2", "words").mapInArrow(task, ddl)
    return some.join(tokens, "token", "left_semi")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """Per document: id, ``n_lines`` and the numbers of its removed lines (texts are not moved)."""
    gone = removals(docs, id_col, text_col, num, den)
    text = col(text_col)
    keyed = docs.select(
        col(id_col).cast("long").alias("_own"),
        F.xxhash64(text).alias("_text"),
        F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("n_lines"),
    )
    return _with_removed(keyed, gone).select(
        F.col("_own").alias(id_col),
        "n_lines",
        F.size("_removed").alias("n_removed"),
        F.col("_removed").alias("removed"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with the removed lines taken out of their texts; all columns and rows stay."""
    gone = removals(docs, id_col, text_col, num, den)
    row = F.struct(*[col(c) for c in docs.columns])
    keyed = docs.select(
        row.alias("_row"), col(id_col).cast("long").alias("_own"), F.xxhash64(col(text_col)).alias("_text")
    )
    met = _with_removed(keyed, gone)
    text = F.col("_row").getField(text_col)
    kept = F.transform(
        F.filter(
            F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(x.alias("t"), i.alias("i"))),
            lambda x: ~F.array_contains(F.col("_removed"), x["i"]),
        ),
        lambda x: x["t"],
    )
    cleaned = F.when(F.size("_removed") > 0, F.array_join(kept, "\n")).otherwise(text)
    return met.select(
        *[(cleaned if c == text_col else F.col("_row").getField(c)).alias(c) for c in docs.columns]
    )


def _with_removed(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    g = gone.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("removed"))
    joined = keyed.join(g, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")), "left")
    return joined.withColumn("_removed", F.coalesce("removed", F.array().cast("array<int>")))


def oracle() -> str:
    """DuckDB SQL for ``op2_line_dedup`` (ids are unique there): prefix join on words by exact frequency."""
    return r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line, unnest(parts) AS txt
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)),
sets AS (
  SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all(
    translate(txt, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w
  FROM lines),
ordered AS (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS place FROM sets WHERE len(w) > 0),
classes AS (SELECT w, len(w) AS n, min(place) AS first FROM ordered GROUP BY w),
tokens AS (SELECT first, n, unnest(w) AS token FROM classes),
frequency AS (SELECT token, count(*) AS f FROM tokens GROUP BY token),
ranked AS (
  SELECT t.first, t.n, t.token, row_number() OVER (PARTITION BY t.first ORDER BY f, t.token) AS pos
  FROM tokens t JOIN frequency USING (token)),
prefix AS (SELECT * FROM ranked WHERE pos <= n - (n * 80 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.first AS x, b.first AS y FROM prefix a JOIN prefix b
    ON a.token = b.token AND a.first < b.first AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
beaten AS (
  SELECT DISTINCT y FROM pairs JOIN classes cx ON cx.first = x JOIN classes cy ON cy.first = y
  WHERE len(list_intersect(cx.w, cy.w)) * 180 >= (cx.n + cy.n) * 80),
gone AS (
  SELECT o.doc_id, o.line FROM ordered o JOIN classes c ON o.w = c.w
  WHERE o.place <> c.first OR c.first IN (SELECT y FROM beaten)),
per_doc AS (
  SELECT doc_id, count(*) AS k, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS n_lines,
  CAST(coalesce(k, 0) AS INTEGER) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""
