"""Arrow string columns as flat byte arrays, and 64-bit hashes over them.

Every helper works on a slice of rows whose texts lie one after the other in
one byte array, so a task's memory is bounded by ``STEP_BYTES`` (or by its
longest single text) and not by the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP_BYTES = 1 << 19
U64 = np.uint64
M64 = (1 << 64) - 1


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offs


def row_slices(offs: np.ndarray, step: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``step`` bytes (one row at least)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + step, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, in place where it can be."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_table(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, b, U64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


class Words:
    """Words of a row slice: maximal runs of word bytes inside one row, with
    a 64-bit hash of each word's (mapped) bytes.

    ``is_word``: 256 booleans; ``fold``: 256 bytes, the byte that counts as."""

    def __init__(self, is_word: np.ndarray, fold: np.ndarray | None = None, seed: int = 1):
        self.is_word = is_word
        self.values = random_table(256, seed)[np.arange(256) if fold is None else fold]
        self.powers = Powers(0x9FB21C651E98DF25)

    def split(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """offs are relative to ``data``.  Returns word starts, word ends and
        for each row (plus one) the number of words before it."""
        n = len(data)
        inside = np.zeros(n + 2, np.bool_)
        inside[1:-1] = self.is_word[data]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        cuts = offs[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begins[cuts] = inside[cuts + 1]
        ends[cuts - 1] = inside[cuts]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offs)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers.to(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


class Runs:
    """Hash of every run of ``n`` consecutive items, from the items' hashes."""

    def __init__(self):
        self.powers = Powers(0xD6E8FEB86659FD93)

    def sums(self, h: np.ndarray) -> np.ndarray:
        up, _ = self.powers.to(len(h) + 1)
        out = np.zeros(len(h) + 1, U64)
        np.cumsum(h * up[:len(h)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, n: int) -> np.ndarray:
        """One hash for each start that has n items after it; items of the
        next row are not told apart here, callers mask those starts."""
        m = len(sums) - n
        if m <= 0:
            return np.zeros(0, U64)
        _, down = self.powers.to(len(sums))
        return mix((sums[n:] - sums[:-n]) * down[:m] + U64(n))


def room(first: np.ndarray, n_items: int) -> np.ndarray:
    """For each item, how many items of its own row start at it or later."""
    return np.repeat(first[1:], np.diff(first)) - np.arange(n_items)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, np.bool_)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


def same_rows(schema, *extra) -> object:
    """The schema of a frame with more columns at its end."""
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, *extra])


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])
