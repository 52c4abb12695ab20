"""Array helpers on Arrow text columns, used inside ``mapInArrow`` tasks.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09``-``\\x0D`` (on
UTF-8 that is the class ``[^\\x20\\x09-\\x0D]+``).  Words are represented by
64-bit polynomial hashes, computed for a block of documents at once from one
running sum over the bytes, so that no Python object per word is made.
Blocks are bounded by bytes; one longer document is hashed in pieces that end
at white space.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Hash parameters.
_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = 20240607
BLOCK_BYTES = 1 << 20

_U64 = np.uint64
_LIBC = ctypes.CDLL(None)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    with np.errstate(over="ignore"):
        x = x + _U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


def _byte_table(lower: bool) -> np.ndarray:
    t = splitmix(np.arange(256, dtype=_U64) + _U64(_SEED)) | _U64(1)
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {False: _byte_table(False), True: _byte_table(True)}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Letters, for words without punctuation: A-Z, a-z and every byte of a longer UTF-8 character.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for ``i < n``."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, b in (("p", _BASE), ("q", inverse)):
            f = np.full(size, b & ((1 << 64) - 1), _U64)
            f[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.cumprod(f, dtype=_U64)
    return _POWERS["p"], _POWERS["q"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and ``len + 1`` offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def _word_bounds(raw: np.ndarray, cuts: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; no word crosses a position in ``cuts``."""
    solid = ~between[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = cuts[(cuts > 0) & (cuts < len(raw))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of byte spans of a block; equal spans have equal hashes."""
    p, q = powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(raw) + 1, _U64)
        np.cumsum(_TABLES[lower][raw] * p[: len(raw)], dtype=_U64, out=run[1:])
        h = (run[ends] - run[starts]) * q[starts]
        return splitmix(h + (ends - starts).astype(_U64))


def _pieces(raw: np.ndarray, limit: int, between: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long text between words, each of about ``limit`` bytes (a longer word stays whole)."""
    at, n = 0, len(raw)
    while at < n:
        end = min(at + limit, n)
        while end < n:
            spaces = np.flatnonzero(between[raw[end : end + limit]])
            if len(spaces):
                end += int(spaces[0]) + 1
                break
            end = min(end + limit, n)
        yield at, end
        at = end


def word_spans(
    raw: np.ndarray, bounds: np.ndarray, lower: bool = False, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of rows ``bounds``, and word offsets per row.

    ``bounds`` are byte offsets (rows + 1) into ``raw``; the spans are byte
    positions in ``raw``.  ``between`` marks the bytes that separate words.
    """
    lo, hi = int(bounds[0]), int(bounds[-1])
    if len(bounds) == 2 and hi - lo > 2 * BLOCK_BYTES:
        parts = [
            _block_spans(raw, np.array([lo + a, lo + b]), lower, between)
            for a, b in _pieces(raw[lo:hi], BLOCK_BYTES, between)
        ]
        h, s, e = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return h, s, e, np.array([0, len(h)])
    return _block_spans(raw, bounds, lower, between)


def _block_spans(
    raw: np.ndarray, bounds: np.ndarray, lower: bool, between: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lo = int(bounds[0])
    block = raw[lo : int(bounds[-1])]
    if not len(block):
        none = np.empty(0, np.int64)
        return np.empty(0, _U64), none, none, np.zeros(len(bounds), np.int64)
    starts, ends = _word_bounds(block, bounds - lo, between)
    h = hash_spans(block, starts, ends, lower)
    return h, starts + lo, ends + lo, np.searchsorted(starts, bounds - lo).astype(np.int64)


def line_bounds(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets that cut rows ``bounds`` into ``\\n``-lines, and line offsets per row.

    Every row has at least one line; the newline byte belongs to the line
    before it.
    """
    lo, hi = int(bounds[0]), int(bounds[-1])
    newline = np.flatnonzero(raw[lo:hi] == 10) + lo + 1
    rows = len(bounds) - 1
    owner = np.searchsorted(bounds[1:], newline, side="left")  # a newline ending a row still opens an empty line
    cuts = np.concatenate([bounds[:-1], newline])
    order = np.argsort(np.concatenate([np.arange(rows), owner]), kind="stable")
    cuts = cuts[order]
    counts = np.bincount(owner, minlength=rows) + 1
    return np.append(cuts, hi), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Row number of each item, from item offsets per row."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def window_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width``-word window and the row of each.

    A row with fewer words (but at least one) has one window, its whole
    sequence; a row without words has none.
    """
    c = splitmix(np.arange(width, dtype=_U64) + _U64(77)) | _U64(1)
    n = len(words)
    rows = owners(offsets)
    with np.errstate(over="ignore"):
        full = np.zeros(max(n - width + 1, 0), _U64)
        for i in range(width):
            full += words[i : i + len(full)] * c[i]
        inside = rows[: len(full)] == rows[width - 1 :] if len(full) else np.empty(0, bool)
        h, owner = full[inside], rows[: len(full)][inside]
        counts = np.diff(offsets)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.zeros(len(short), _U64)
            for i in range(width - 1):
                has = counts[short] > i
                extra[has] += words[offsets[short[has]] + i] * c[i]
            h = np.concatenate([h, extra + counts[short].astype(_U64)])
            owner = np.concatenate([owner, short])
    return splitmix(h), owner


def distinct_by_row(h: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row and their offsets per row."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(rows + 1)).astype(np.int64)


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits that differ between two signed 64-bit columns."""
    # bitwise_count takes a signed number's absolute value, so the bits are viewed unsigned.
    return np.bitwise_count((a ^ b).view(_U64)).astype(np.int64)


def give_back() -> None:
    """Return freed memory to the system; a worker lives on and serves tasks of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_blocks(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, word hashes, word offsets)`` for blocks of a text column."""
    raw, offsets = text_buffers(column)
    for a, b in blocks(offsets):
        h, _, _, at = word_spans(raw, offsets[a : b + 1], lower)
        yield a, b, h, at


def binary_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column whose row ``i`` holds the bytes of ``values[offsets[i]:offsets[i+1]]``."""
    at = (offsets * values.itemsize).astype(np.int64)
    wide = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))]
    )
    return wide.cast(pa.binary())
