"""Words of an Arrow text column as numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. UTF-8 keeps those six bytes for themselves, so words are found without decoding. A word
is known by a 64-bit hash: a polynomial over per-byte constants, worked out for all words of a
piece of text with one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BLOCK = 1 << 20
_rng = np.random.default_rng(20240117)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = []


#: Texts go to Python in batches of at most so many rows and about so many bytes, so that a worker's
#: memory follows the longest text, not the batch.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def map_texts(rows: DataFrame, task, schema: str) -> DataFrame:
    """``rows.mapInArrow`` in small batches (settings of the session, which are only ever lowered)."""
    conf = rows.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        held = conf.get(key)
        if not held.isdigit() or not 0 < int(held) <= most:
            conf.set(key, str(most))
    return rows.mapInArrow(task, schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column of ``df`` is called so."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(_BLOCK, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, marks, body = column.buffers()
    if n == 0 or body is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(marks, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(body, np.uint8), offsets.astype(np.int64)


def runs(offsets: np.ndarray, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer text stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE, kinds=None):
    """Start and end byte of each word, and the n + 1 word numbers at which the rows begin.

    ``kinds`` gives each byte a class; a word is also cut between classes 1 and 2.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    inside = ~white[data[low:high]]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cuts = offsets[1:-1] - low
    before[cuts[cuts < high - low]] = False
    after[cuts[cuts > 0] - 1] = False
    if kinds is not None and high > low:
        kind = kinds[data[low:high]]
        cut = np.flatnonzero(kind[1:] * kind[:-1] == 2)
        before[cut + 1] = False
        after[cut] = False
    starts = np.flatnonzero(inside & ~before) + low
    ends = np.flatnonzero(inside & ~after) + low + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _long_hash(body: np.ndarray, table: np.ndarray) -> int:
    powers, total = _power_tables()[0], 0
    for k in range(0, len(body), _BLOCK):
        part = table[body[k : k + _BLOCK]] * powers[: len(body[k : k + _BLOCK])]
        total = (total + int(part.sum(dtype=np.uint64)) * pow(_BASE, k, 1 << 64)) & _MASK
    return total


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span; ``lower`` treats A-Z as a-z. Spans must be in order."""
    table = _BYTE_LOWER if lower else _BYTE
    powers, inverse = _power_tables()
    out = np.empty(len(starts), np.uint64)
    at, n = 0, len(starts)
    while at < n:
        base = starts[at]
        to = int(np.searchsorted(ends, base + _BLOCK - 1, "right"))
        if to <= at:
            out[at] = _long_hash(data[base : ends[at]], table)
            at += 1
            continue
        seg = table[data[base : ends[to - 1]]]
        seg *= powers[: len(seg)]
        sums = np.empty(len(seg) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(seg, out=sums[1:])
        s = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[s]) * inverse[s]
        at = to
    return mixed(out + (ends - starts).astype(np.uint64) * _STEP)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (rows are not told apart here)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : k + n]
    return mixed(out + np.uint64(size))


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each row; fewer words than ``size`` make one shingle."""
    all_windows, sets = windows(hashes, size), []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            s = np.sort(all_windows[a : b - size + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            sets.append(s[keep])
        elif b > a:
            sets.append(windows(hashes[a:b], b - a))
        else:
            sets.append(hashes[:0])
    return sets


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
