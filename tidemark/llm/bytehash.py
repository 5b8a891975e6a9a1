"""Hashes of words, shingles and byte windows, for a whole Arrow batch at a time.

All arithmetic is modulo 2**64 on numpy arrays. The hash of a substring comes
from prefix sums of ``byte * BASE**place``; dividing by ``BASE**start`` (BASE is
odd, so it has an inverse) makes it independent of the place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

# The bytes that separate words.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32
_inside = np.ones(256, dtype=bool)
_inside[list(SEPARATORS)] = False

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, kind: str = "up") -> np.ndarray:
    """``BASE**i`` (or its inverse) for i below ``n``; kept between calls."""
    have = _powers[kind]
    if len(have) < n:
        steps = np.full(max(n, 2 * len(have)), BASE if kind == "up" else INVERSE, dtype=np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (a finalizer of a well known kind)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offset of each row; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    return sums


def substring_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per ``[start, end)``; equal bytes give equal hashes."""
    down = powers(len(sums), "down")
    length = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + length * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word never crosses a row."""
    inside = _inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & ~(before & ~first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & ~(after & ~first[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``k``-word shingle, A-Z lower-cased, repeats included.

    A row with fewer words gives its whole sequence as one shingle, a row
    without words none.
    """
    data, offsets = flat(texts)
    data = _lower[data]
    starts, ends, rows = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    each = substring_hash(prefix_sums(data), starts, ends)
    place = [powers(k + 1)[i + 1] for i in range(k)]
    total = np.zeros(max(0, len(each) - k + 1), np.uint64)
    for i in range(k):
        total += each[i : i + len(total)] * place[i]
    whole = rows[k - 1 :] == rows[: len(total)] if len(total) else np.zeros(0, bool)
    out, at = mix(total[whole]), rows[: len(total)][whole]
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.searchsorted(rows, short)
        value = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = counts[short] > i
            value[has] += each[begin[has] + i] * place[i]
        value = mix(value + counts[short].astype(np.uint64))
        out, at = np.concatenate([out, value]), np.concatenate([at, short])
    return out, at


def portions(batch: pa.RecordBatch, column: int, max_bytes: int = 1 << 21) -> list[pa.RecordBatch]:
    """The batch in slices whose texts have about ``max_bytes``; a longer text stands alone.

    The arrays made from a text are several times as large as the text itself.
    """
    if not batch.num_rows:
        return []
    texts = batch.column(column)
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct values of each of ``n`` rows."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    if len(values):
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        values, rows = values[fresh], rows[fresh]
    return np.split(values, np.searchsorted(rows, np.arange(1, n)))
