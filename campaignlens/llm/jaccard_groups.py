"""N-gram Jaccard join by grouped prefixes.

A document's set holds the hashes of its distinct five-word shingles.  All
shingles have one order, rare ones first; two sets of Jaccard ``num/den`` or
more share a shingle among the first ``n - ceil(num * n / den) + 1`` of each
(the prefix).  Documents with the same size and the same prefix form one
group; only groups are matched.

1. Shingles are counted in a fixed number of hash buckets; (rarity class, hash)
   is the order, the same everywhere.
2. Every group sends its prefix; shingles that one group alone has are dropped
   by an aggregate that combines inside the tasks.
3. Group pairs pass a length filter and a prefix filter: sets that match share
   a computable number of prefix shingles.  Pairs that pass are expanded into
   the members' distinct sets, which are compared exactly.
4. Links come in two passes.  First every group meets one other group of each of
   its shingles, the one in whose prefix the shingle stands first (the least
   edited text of a family), which joins a large family of near copies in a
   star of links; a 512-bit sketch of the prefixes bounds what a pair can share.
   Then only groups of different components are matched, each stray with all
   others of its shingle.  What pairs share is first added up in a fixed number
   of hash buckets, which can only overstate it; only pairs whose bucket reaches
   the number needed are written and counted exactly.  Both passes together
   lose no component, and a family of near copies never emits all its pairs.

A *class* is one distinct set; its members need no links among themselves.
Sets are compared through 64-bit shingle hashes and told apart by 128-bit sums;
a group is named by a 64-bit hash of its size and prefix.

Defined cases: a null text, and one without words, has an empty set and is
linked with nothing; fewer than five words make one shingle; equal ids with
different texts are different documents; a document with a null id takes part,
and its component's id is the smallest id that is not null; repeated rows share
one component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlens.llm import textops
from campaignlens.llm.common import col, has_map, hashed_counts, prepare, row_hash, store
from campaignlens.llm.graph import components

WIDTH = 5
NUM, DEN = 80, 100
# Buckets of the shingle counts, the document filter and the pair counts: fixed sizes, whatever the input.
COUNT_BITS = 20
FILTER_BITS = 21
PAIR_BITS = 22
_SEEN = 200_000  # groups that a task remembers, to send each prefix once
_NEVER = 1 << 60
_SKETCH = tuple(f"k{i}" for i in range(8))  # 512 bits
_BLOCK = 1 << 18  # pairs looked at together
_LIST = 4096  # partners written in one row


def _shingles(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, distinct hashes, offsets)`` for blocks of a text column."""
    for a, b, words, at in textops.word_blocks(column, lower=True):
        h, owner = textops.window_hashes(words, at, width)
        yield a, b, *textops.distinct_by_row(h, owner, b - a)


def _sum_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return run[offsets[1:]] - run[offsets[:-1]]


def _signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s1 = _sum_by_row(textops.splitmix(h), at)
    s2 = _sum_by_row(textops.splitmix(h ^ np.uint64(0x5BF03635DEADBEEF)), at)
    return s1.view(np.int64), s2.view(np.int64)


def _rarity(counts: np.ndarray) -> np.ndarray:
    """Rarity class of each bucket (0 rarest), 16 per doubling of the count."""
    return np.minimum(16 * np.log2(np.maximum(counts, 1)), 4095).astype(np.uint16)


def _profiles(docs: DataFrame, counts: np.ndarray, width: int, num: int, den: int) -> DataFrame:
    """One row per document: id, text key, size, set signature, group; once per task the group's prefix, the
    order of its last shingle, and its sketch."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_rarity(counts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        mask = np.uint64(len(table) - 1)
        seen: set[int] = set()
        for batch in batches:
            for a, b, h, at in _shingles(batch.column("text"), width):
                n = np.diff(at)
                s1, s2 = _signatures(h, at)
                owner = textops.owners(at)
                order = np.lexsort((h, table[(h & mask).astype(np.int64)], owner))
                h = h[order]
                length = np.where(n > 0, n - (n * num + den - 1) // den + 1, 0)
                first = (np.arange(len(h)) - at[owner]) < length[owner]
                prefix = h[first]
                ends = np.concatenate([[0], np.cumsum(length)])
                final = prefix[np.maximum(ends[1:] - 1, 0)] if len(prefix) else np.zeros(b - a, np.uint64)
                rank = table[(final & mask).astype(np.int64)].astype(np.int64)
                stop = (rank << 51) | (final >> np.uint64(13)).astype(np.int64)
                sketch = _sketch(prefix, ends)
                mark = _sum_by_row(textops.splitmix(prefix + np.uint64(3)), ends)
                with np.errstate(over="ignore"):
                    group = textops.splitmix(mark + n.astype(np.uint64)).view(np.int64)
                send = np.zeros(b - a, bool)
                for i, g in enumerate(group.tolist()):
                    if n[i] and g not in seen:
                        seen.add(g)
                        send[i] = True
                if len(seen) > _SEEN:
                    seen.clear()
                sent = prefix[np.repeat(send, length)].view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(send, length, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        batch.column("key").slice(a, b - a),
                        pa.array(n, pa.int64()),
                        pa.array(s1),
                        pa.array(s2),
                        pa.array(group),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(sent)),
                        pa.array(stop),
                        *[pa.array(k) for k in sketch],
                    ],
                    names=["id", "key", "n", "s1", "s2", "grp", "prefix", "stop", *_SKETCH],
                )

    ddl = "id long, key long, n long, s1 long, s2 long, grp long, prefix array<long>, stop long"
    return docs.mapInArrow(task, ddl + "".join(f", {k} long" for k in _SKETCH))


def _sketch(tokens: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """512 bits per row of tokens, in eight columns; every token sets one."""
    rows = len(ends) - 1
    bits = np.zeros((rows, 64 * len(_SKETCH)), bool)
    bit = textops.splitmix(tokens + np.uint64(19)) % np.uint64(bits.shape[1])
    bits[np.repeat(np.arange(rows), np.diff(ends)), bit.astype(np.int64)] = True
    packed = np.packbits(bits, axis=1).view(np.int64)
    return [np.ascontiguousarray(packed[:, i]) for i in range(len(_SKETCH))]


def _prefix_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return n - (n * num + den - 1) // den + 1


def _common_needed(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many prefix shingles a matching pair of groups must share; more than any if the sizes rule it out.

    The set whose prefix ends first in the order has all its other common
    shingles behind its own prefix.
    """
    a, b = g["n"][i], g["n"][j]
    needed = -((-(a + b) * num) // (num + den))
    rest_a, rest_b = a - _prefix_length(a, num, den), b - _prefix_length(b, num, den)
    ends_a, ends_b = g["stop"][i], g["stop"][j]
    rest = np.where(ends_a < ends_b, rest_a, np.where(ends_b < ends_a, rest_b, np.maximum(rest_a, rest_b)))
    least = np.maximum(needed - rest, 1)
    return np.where(np.minimum(a, b) * den >= np.maximum(a, b) * num, least, _NEVER)


def _star_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """``ga, gb``: each group of a shingle with the group in whose prefix the shingle stands first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _whole_tokens(batches, ["token", "grp", "at", "n", "stop"]):
            order = np.lexsort((g["grp"], g["at"], g["token"]))
            g = {c: v[order] for c, v in g.items()}
            t = g["token"]
            starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            i = np.repeat(starts, np.diff(np.append(starts, len(t))))
            j = np.arange(len(t))
            ok = i != j
            i, j = i[ok], j[ok]
            ok = _common_needed(g, i, j, num, den) < _NEVER
            pairs = np.unique(np.stack([g["grp"][i[ok]], g["grp"][j[ok]]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["ga", "gb"])

    return _by_token(postings, ["token", "grp", "at", "n", "stop"]).mapInArrow(task, "ga long, gb long").distinct()


def _sharing_enough(pairs: DataFrame, about: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose prefixes can have enough in common by their sketches."""
    cols = ["n", "stop", *_SKETCH]
    side = lambda x: about.select(F.col("grp").alias(f"g{x}"), *[F.col(c).alias(c + x) for c in cols])
    met = pairs.join(side("a"), "ga").join(side("b"), "gb")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = {x: {c: batch.column(c + x).to_numpy(zero_copy_only=False) for c in cols} for x in "ab"}
            m = batch.num_rows
            g = {c: np.concatenate([half["a"][c], half["b"][c]]) for c in cols}
            i, j = np.arange(m), np.arange(m) + m
            apart = np.zeros(m, np.int64)
            for k in _SKETCH:
                apart += textops.differing_bits(g[k][i], g[k][j])
            # Every differing bit is a shingle of one prefix only.
            most = (_prefix_length(g["n"][i], num, den) + _prefix_length(g["n"][j], num, den) - apart) // 2
            yield batch.select(["ga", "gb"]).filter(pa.array(most >= _common_needed(g, i, j, num, den)))

    return met.mapInArrow(task, "ga long, gb long")


def _crossing(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ga, gb, needed)`` of groups of different roots that share a shingle, a bounded number at a time.

    Every group outside its shingle's commonest root meets all groups after
    it (the others of that kind stand first), so each pair of different roots
    is seen once for every shingle it shares.
    """
    for g in _whole_tokens(batches, ["token", "grp", "n", "stop", "root"]):
        order = np.lexsort((~_is_stray(g["token"], g["root"]), g["token"]))
        g = {c: v[order] for c, v in g.items()}
        t = g["token"]
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        ends = np.append(starts[1:], len(t))
        width = np.where(_is_stray(t, g["root"]), np.repeat(ends, ends - starts) - np.arange(len(t)) - 1, 0)
        upto = np.concatenate([[0], np.cumsum(width)])
        at = 0
        while at < len(t):
            stop = max(int(np.searchsorted(upto, upto[at] + _BLOCK, side="right")) - 1, at + 1)
            w = width[at:stop]
            i = np.repeat(np.arange(at, stop), w)
            j = i + 1 + np.arange(len(i)) - np.repeat(upto[at:stop] - upto[at], w)
            ok = (g["root"][i] != g["root"][j]) | (g["root"][i] == -1)
            i, j = i[ok], j[ok]
            needed = _common_needed(g, i, j, num, den)
            ok = needed < _NEVER
            x, y = g["grp"][i[ok]], g["grp"][j[ok]]
            yield np.minimum(x, y), np.maximum(x, y), needed[ok]
            at = stop


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return textops.splitmix(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64))


def _crossing_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """``ga, gb``: groups of different roots that share as many prefix shingles as a match needs."""
    met = _by_token(postings, ["token", "grp", "n", "stop", "root"])
    held = hashed_counts(
        met, lambda batches: (_pair_hash(x, y) for x, y, _ in _crossing(batches, num, den)), PAIR_BITS
    )
    shared = postings.sparkSession.sparkContext.broadcast(np.minimum(held, np.iinfo(np.uint16).max).astype(np.uint16))

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per shingle and smaller group with the larger ones, at most ``_LIST`` in a row."""
        table = shared.value
        mask, top = np.uint64(len(table) - 1), np.iinfo(table.dtype).max
        for x, y, needed in _crossing(batches, num, den):
            ok = table[(_pair_hash(x, y) & mask).astype(np.int64)] >= np.minimum(needed, top)
            x, y, needed = x[ok], y[ok], needed[ok]
            if not len(x):
                continue
            order = np.argsort(x, kind="stable")
            x, y, needed = x[order], y[order], needed[order]
            head = np.concatenate([[True], x[1:] != x[:-1]])
            since = np.arange(len(x)) - np.maximum.accumulate(np.where(head, np.arange(len(x)), 0))
            head = np.flatnonzero(head | (since % _LIST == 0))
            ends = pa.array(np.append(head, len(x)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x[head]),
                    pa.ListArray.from_arrays(ends, pa.array(y)),
                    pa.ListArray.from_arrays(ends, pa.array(needed.astype(np.int32))),
                ],
                names=["ga", "others", "needed"],
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs found often enough, from batches sorted by the smaller group."""
        for g in _whole_groups(batches):
            order = np.lexsort((g["gb"], g["ga"]))
            a, b, needed = g["ga"][order], g["gb"][order], g["needed"][order]
            head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            enough = np.diff(np.append(head, len(a))) >= needed[head]
            kept = head[enough]
            yield pa.RecordBatch.from_arrays([pa.array(a[kept]), pa.array(b[kept])], names=["ga", "gb"])

    lists = met.mapInArrow(partners, "ga long, others array<long>, needed array<int>")
    return lists.repartition("ga").sortWithinPartitions("ga").mapInArrow(counted, "ga long, gb long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """``ga, gb, needed`` arrays that hold every row of their smaller groups."""
    held: list[dict[str, np.ndarray]] = []
    size = 0
    for batch in batches:
        count = np.diff(batch.column("others").offsets.to_numpy())
        if not count.sum():
            continue
        held.append({
            "ga": np.repeat(batch.column("ga").to_numpy(zero_copy_only=False), count),
            "gb": batch.column("others").flatten().to_numpy(zero_copy_only=False),
            "needed": batch.column("needed").flatten().to_numpy(zero_copy_only=False),
        })
        size += int(count.sum())
        last = held[-1]["ga"][-1]
        if size < _BLOCK or held[0]["ga"][0] == last:
            continue
        g = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        cut = int(np.searchsorted(g["ga"] == last, True))
        yield {c: v[:cut] for c, v in g.items()}
        held, size = [{c: v[cut:] for c, v in g.items()}], size - cut
    if size:
        yield {c: np.concatenate([h[c] for h in held]) for c in held[0]}


def _by_token(postings: DataFrame, names: list[str]) -> DataFrame:
    return postings.select(*names).repartition("token").sortWithinPartitions("token")


def _whole_tokens(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Arrays of whole shingles (at least some ten thousand rows) from batches sorted by shingle."""
    held: list[dict[str, np.ndarray]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in names})
        rows += batch.num_rows
        last = held[-1]["token"][-1]
        if rows < 20_000 or held[0]["token"][0] == last:
            continue
        g = {c: np.concatenate([h[c] for h in held]) for c in names}
        cut = int(np.searchsorted(g["token"] == last, True))
        yield {c: v[:cut] for c, v in g.items()}
        held, rows = [{c: v[cut:] for c, v in g.items()}], rows - cut
    if rows:
        yield {c: np.concatenate([h[c] for h in held]) for c in names}


def _is_stray(token: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Rows outside their shingle's commonest root (rows sorted by shingle; a row of several roots, -1, is one)."""
    order = np.lexsort((root, token))
    t, r = token[order], root[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (r[1:] != r[:-1])])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(t)))
    size = np.where(r[head] == -1, 0, size)
    best = np.lexsort((r[head], -size, t[head]))
    top = best[np.concatenate([[True], t[head][best][1:] != t[head][best][:-1]])]
    main = np.zeros(len(head), bool)
    main[top] = r[head][top] != -1
    out = np.empty(len(t), bool)
    out[order] = ~np.repeat(main, np.diff(np.append(head, len(t))))
    return out


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id, s1, s2, shingles`` (sorted hashes) of the documents whose id may be among ``wanted (rep)``.

    A fixed-size filter on the ids keeps most other texts from being read into
    shingles and shuffled; the joins that follow are exact.
    """
    spark = docs.sparkSession
    held = hashed_counts(
        wanted.select(F.xxhash64("rep").alias("h")),
        lambda batches: (b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches),
        FILTER_BITS,
    )
    shared = spark.sparkContext.broadcast(np.packbits(held > 0))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            rows = np.flatnonzero(bits[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            if not len(rows):
                continue
            some = batch.take(pa.array(rows))
            for a, b, sh, at in _shingles(some.column("text"), width):
                s1, s2 = _signatures(sh, at)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").slice(a, b - a), pa.array(s1), pa.array(s2), textops.binary_column(sh, at)],
                    names=["id", "s1", "s2", "shingles"],
                )

    texts = docs.select("id", F.xxhash64("id").alias("h"), "text")
    return texts.mapInArrow(task, "id long, s1 long, s2 long, shingles binary")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose sets are similar enough, compared exactly.

    Each pair names its sets by signature and representative, so the sets go
    from the texts straight into the two joins.
    """
    about = classes.select("node", "rep", "s1", "s2")
    keyed = pairs
    for side in ("a", "b"):
        keyed = keyed.join(about.toDF(side, f"rep_{side}", f"s1_{side}", f"s2_{side}"), side)
    keyed = store(keyed)
    sets = _sets(docs, keyed.select(F.col("rep_a").alias("rep")).union(keyed.select("rep_b")).distinct(), width)

    def with_set(df: DataFrame, side: str) -> DataFrame:
        found = sets.toDF(f"_id{side}", f"s1_{side}", f"s2_{side}", f"set_{side}")
        met = df.join(found, [f"s1_{side}", f"s2_{side}"]).where(F.col(f"_id{side}").eqNullSafe(F.col(f"rep_{side}")))
        return met.drop(f"_id{side}", f"rep_{side}", f"s1_{side}", f"s2_{side}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = common * (num + den) >= num * (len(p) + len(q))
            kept = batch.select(["a", "b"]).filter(pa.array(keep))
            if kept.num_rows:
                yield kept

    joined = with_set(with_set(keyed, "a"), "b").select("a", "b", "set_a", "set_b")
    return store(joined.mapInArrow(task, "a long, b long").distinct())


def _labels(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Every class with its component's root."""
    return classes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def link(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    num: int = NUM,
    den: int = DEN,
) -> DataFrame:
    """One row per document: ``id, key, n, s1, s2, root, component`` (see ``near_classes``).

    ``key`` is a hash of the text; ``root`` names the component.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        col(id_col).cast("long").alias("id"), F.xxhash64(col(text_col)).alias("key"), col(text_col).alias("text")
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, _, h, _ in _shingles(batch.column(0), width):
                yield h

    counts = hashed_counts(rows.select("text"), hashes, COUNT_BITS)
    profiles = store(_profiles(rows, counts, width, num, den))
    classes = store(
        profiles.where("n > 0")
        .groupBy("n", "s1", "s2", "grp")
        .agg(F.min("id").alias("rep"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    posted = profiles.select("grp", F.posexplode("prefix").alias("at", "token"))
    shared = posted.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low <> high")
    postings = posted.join(shared.select("token"), "token").groupBy("token", "grp").agg(F.min("at").alias("at"))
    about = profiles.where(F.size("prefix") > 0).groupBy("grp").agg(*[F.min(c).alias(c) for c in ("n", "stop", *_SKETCH)])
    placed = store(postings.join(about.select("grp", "n", "stop"), "grp"))

    # First pass: each group with the least edited group of each of its shingles.
    stars = store(_sharing_enough(_star_pairs(placed, num, den), about, num, den))
    heads = classes.groupBy("grp").agg(F.min("node").alias("head"))
    members = classes.select("grp", "node")
    first = store(
        stars.join(members.toDF("ga", "a"), "ga")
        .join(heads.toDF("gb", "b"), "gb")
        .select("a", "b")
        .union(stars.join(heads.toDF("ga", "a"), "ga").join(members.toDF("gb", "b"), "gb").select("a", "b"))
        .union(members.join(heads, "grp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
        .distinct()
    )
    links = _verified(first, classes, rows, width, num, den)
    labelled = store(_labels(classes, links))

    # Second pass: groups of different components.  A group of several components has no label of its own.
    groups = labelled.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    mixed = groups.where("lo <> hi").select("grp")
    groups = groups.select("grp", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit(-1)).alias("root"))
    crossing = (
        _crossing_pairs(placed.join(groups, "grp"), num, den)
        .union(mixed.select(F.col("grp").alias("ga"), F.col("grp").alias("gb")))
    )
    ma = labelled.select(F.col("grp").alias("ga"), F.col("node").alias("a"), F.col("root").alias("ra"))
    mb = labelled.select(F.col("grp").alias("gb"), F.col("node").alias("b"), F.col("root").alias("rb"))
    second = (
        crossing.join(ma, "ga")
        .join(mb, "gb")
        .where("ra <> rb")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verified(store(second.join(done, ["a", "b"], "left_anti")), classes, rows, width, num, den)
    final = _labels(classes, links.union(more))
    final = final.join(final.groupBy("root").agg(F.min("rep").alias("component")), "root")
    final = store(final.select("n", "s1", "s2", "root", "component"))
    return profiles.select("id", "key", "n", "s1", "s2").join(final, ["n", "s1", "s2"], "left")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    num: int = NUM,
    den: int = DEN,
) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` of every document.

    The component's id is the smallest id reachable by links (its own where it
    has none).
    """
    linked = link(docs, id_col, text_col, width, num, den)
    return linked.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    num: int = NUM,
    den: int = DEN,
) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, then text hash.

    Documents without words are linked with nothing and all stay.
    """
    linked = link(docs, id_col, text_col, width, num, den)
    chosen = (
        linked.where("n > 0")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))).alias("m"))
        .select(*_row_key(F.col("m.id"), F.col("m.key")), F.lit(True).alias("_chosen"))
    )
    empty = linked.where("n = 0").select(*_row_key(F.col("id"), F.col("key")), F.lit(False).alias("_chosen"))
    wanted = chosen.union(empty.distinct())
    key = _row_key(col(id_col).cast("long"), F.xxhash64(col(text_col)))
    names = [k.alias(f"_k{i}") for i, k in enumerate(key)]
    on = ["_k0", "_k1", "_k2"]
    keyed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_row"), row_hash(docs).alias("_tie"), *names)
    met = keyed.join(wanted.toDF(*on, "_chosen"), on)
    # Repeated rows of a chosen document: one stays.  The join has already placed them together.
    least = F.min_by("_row", "_tie") if has_map(keyed.schema["_row"].dataType) else F.min("_row")
    once = met.where("_chosen").groupBy(*on).agg(least.alias("_row")).select("_row")
    rest = met.where("not _chosen").select("_row")
    return once.union(rest).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def _row_key(ident: Column, text_hash: Column) -> list[Column]:
    """Non-null join keys of a document: whether the id is null, the id, the text's hash."""
    return [ident.isNull(), F.coalesce(ident, F.lit(0)), text_hash]


def oracle() -> str:
    """DuckDB SQL for ``op8_jaccard_groups``: prefix join by exact frequency, then smallest reachable id."""
    return r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s FROM words),
classes AS MATERIALIZED (SELECT s, len(s) AS n, min(doc_id) AS first FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT first, n, unnest(s) AS token FROM classes),
frequency AS (SELECT token, count(*) AS f FROM tokens GROUP BY token),
ranked AS (
  SELECT t.first, t.n, t.token, f, row_number() OVER (PARTITION BY t.first ORDER BY f, t.token) AS pos
  FROM tokens t JOIN frequency USING (token)),
prefix AS MATERIALIZED (SELECT * FROM ranked WHERE f > 1 AND pos <= n - (n * 80 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.first AS x, b.first AS y FROM prefix a JOIN prefix b
    ON a.token = b.token AND a.first < b.first AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN classes cx ON cx.first = x JOIN classes cy ON cy.first = y
  WHERE len(list_intersect(cx.s, cy.s)) * 180 >= (cx.n + cy.n) * 80),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS node, x AS seen FROM edges UNION SELECT r.node, b.y FROM reach r JOIN edges b ON b.x = r.seen),
least_of AS (SELECT node, min(seen) AS root FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(r.root, c.first, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON len(d.s) > 0 AND d.s = c.s LEFT JOIN least_of r ON r.node = c.first"""
