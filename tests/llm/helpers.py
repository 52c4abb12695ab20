"""Small corpora and plain-Python counterparts of the operators' definitions."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows ``(doc_id, text[, lang, source])`` as a table of documents."""
    full = []
    for r in rows:
        i, text, lang, source = (list(r) + ["en", "s"][len(r) - 2 :])[:4] if len(r) < 4 else r[:4]
        full.append((i, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOCUMENT).repartition(3)


def prose(rnd: random.Random, n: int, stock: int = 400) -> str:
    return " ".join(f"w{rnd.randrange(stock)}" for _ in range(n))


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0


def shingles(text: str | None, width: int = 5) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id reachable by links of 80 percent, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    links = defaultdict(set)
    for i in sets:
        for j in sets:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i].add(j)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = min(seen)
    return out


def removed_lines(rows: list[tuple[int, str | None]]) -> dict[int, list[int]]:
    """Numbers of the lines that match an earlier line, by comparing all pairs (ids are unique)."""
    lines = []
    for i, text in sorted(rows, key=lambda r: r[0]):
        if text is not None:
            for n, line in enumerate(text.split("\n")):
                w = frozenset(words(line.translate(LOWER)))
                if w:
                    lines.append((i, n, w))
    out: dict[int, list[int]] = {i: [] for i, _ in rows}
    for k, (i, n, w) in enumerate(lines):
        if any(100 * len(w & x) >= 80 * len(w | x) for _, _, x in lines[:k]):
            out[i].append(n)
    return out
