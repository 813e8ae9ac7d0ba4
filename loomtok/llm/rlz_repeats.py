"""Substring dedup by relative Lempel-Ziv parsing over words.

A reference block holds, from all texts, the windows of ``length`` words that
share an anchor (the smallest hash of ``SEED`` words in the window, the same
for equal windows); only anchors that occur at two places make a block.  Each
run of windows in a block is parsed greedily against the block: its index
is the order of all runs' remainders by their window fingerprints (ranks over
1, 2, 4, ... windows), where the longest match of a remainder stands next to
it.  A factor is the longest run of windows that stands at one other place,
its source, in the same order; the parse goes on behind it.  A window without
another place is a literal.

Every window of every text is in one block, so all are parsed.  A factor that
reaches its block's border is checked there: if the next one's source goes on
where its own ended, both are one factor (``factors``).  All words under a
factor's windows are a duplicate span.

Memory is bounded by a slice of rows, a bucket of anchors or
``repeats.CROWD`` runs of a block; the windows of larger blocks are grouped
one by one, with partial aggregation, each a factor with the least or largest
other place as its source.

``factors`` returns the factors themselves: _k1, _k2 (the text by its hashes),
lo and n (first window, windows; a factor's words are n + length - 1), and
source (the same three of the other place).  Texts that stand in several rows
are parsed once; that they are copies isn't in there.

``remove`` adds n_words, n_removed and kept (the remaining words joined by
one space).  Every word in a window that also starts anywhere else goes,
judged on the input.  Words are runs of other characters than the six ASCII
white spaces, compared as they are.  Null texts have no words; short texts
lose nothing; repeated rows are copies and lose everything if they are long
enough.  Columns with the new names are replaced; empty tables give empty
tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm import repeats
from loomtok.llm.flat import Words, byte_class, byte_rows, row_slices, same_rows, with_columns

LENGTH = 35
SEED = 8

WORD_BYTES = ~byte_class((0x09, 0x0D), (0x20, 0x20))


class Parsed:
    """The words of a slice of rows and the hashes of their runs."""

    def __init__(self):
        self.words, self.sequence = Words(WORD_BYTES), repeats.Sequence()

    def rows(self, data: np.ndarray, offs: np.ndarray, length: int, seed: int):
        """(row, hashes of ``seed`` words at each place, function to the
        fingerprints of windows) of each row that has a window."""
        starts, ends, first = self.words.split(data, offs)
        sums = self.sequence.sums(self.words.hashes(data, starts, ends))
        for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= length:
                grams = self.sequence.at(sums, np.arange(a, b - seed + 1), seed)
                yield r, b - a, grams, lambda lo, n, a=a: self.sequence.at(sums, np.arange(a + lo, a + lo + n), length)


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1]


class Index:
    """The order of the remainders of all runs in some blocks.  ``owner``:
    the run of each window; windows of different blocks never have one ``h``."""

    def __init__(self, owner: np.ndarray, h: np.ndarray):
        at = np.arange(len(h))
        last = np.searchsorted(owner, owner, "right")  # past the run's last window
        self.left = last - at
        self.ranks, span = [_dense(h)], 1
        while span < (self.left.max() if len(h) else 0):
            r, ahead = self.ranks[-1], at + span
            more = np.where(ahead < last, r[np.minimum(ahead, len(h) - 1)] + 1, 0)
            self.ranks.append(_dense(r * (len(h) + 1) + more))
            span *= 2
        self.order = np.argsort(self.ranks[-1], kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many windows the remainders at a and b share."""
        n, most = np.zeros(len(a), np.int64), np.minimum(self.left[a], self.left[b])
        for level in range(len(self.ranks) - 1, -1, -1):
            x, y = (np.minimum(v + n, len(self.left) - 1) for v in (a, b))
            same = (n < most) & (self.ranks[level][x] == self.ranks[level][y])
            n = np.where(same, np.minimum(n + (1 << level), most), n)
        return n

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window the other one with the longest match from there on, and its length."""
        n, best = np.zeros(len(self.order), np.int64), np.zeros(len(self.order), np.int64)
        for a, b in ((self.order[1:], self.order[:-1]), (self.order[:-1], self.order[1:])):
            more = self.common(a, b)
            better = more > n[a]
            n[a[better]], best[a[better]] = more[better], b[better]
        return best, n


def parse(n: np.ndarray, owner: np.ndarray, start: np.ndarray, h: np.ndarray, rows: pa.Table) -> pa.RecordBatch:
    """The factors of each run of windows.  A text that several tasks have
    met is in here several times and counts once."""
    k1, k2, lo = (np.asarray(rows.column(c)) for c in ("_k1", "_k2", "lo"))
    once = np.zeros(len(n), np.bool_)
    once[np.unique(np.stack([k1, k2, lo.astype(np.int64)]), axis=1, return_index=True)[1]] = True
    if not once.all():
        own, rows, n = once[owner], rows.filter(pa.array(once)), n[once]
        k1, k2, owner, start, h = k1[once], k2[once], (np.cumsum(once) - 1)[owner[own]], start[own], h[own]
    source, reach = Index(owner, h).longest()
    known = np.asarray(rows.column("known"))
    # a run that its own text holds again is one factor
    free = np.flatnonzero((reach > 0) & ~known[owner])
    first, lengths, behind = [], [], -1
    for p, m in zip(free.tolist(), reach[free].tolist()):
        if p >= behind:
            first.append(p)
            lengths.append(m)
            behind = p + m
    first, lengths = np.array(first, np.int64), np.array(lengths, np.int64)
    of, whole = source[first], np.flatnonzero(known)
    begin = (np.cumsum(n) - n)[whole]
    return repeats.runs_of(
        np.concatenate([k1[owner[first]], k1[whole]]), np.concatenate([k2[owner[first]], k2[whole]]), np.concatenate([start[first], start[begin]]),
        np.concatenate([lengths, n[whole]]), np.concatenate([k1[owner[of]], k1[whole]]), np.concatenate([k2[owner[of]], k2[whole]]),
        np.concatenate([start[of], np.array(rows.column("again").to_pylist(), object)[whole]]).tolist())


def _parsed(docs: DataFrame, length: int, text_col: str) -> DataFrame:
    """``repeats.RUN``: the factors of all blocks."""
    seed = min(SEED, length)
    texts = repeats.texts_of(docs, text_col)
    parsed = Parsed()

    def sample(data, offs):
        found = []
        for r, n, grams, _ in parsed.rows(data, offs, length, seed):
            at = np.unique(repeats.anchors(grams, 0, n - length + 1, length, seed)[0])
            found.append((grams[at], np.full(len(at), r), at))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    tied = repeats.table(repeats.ties(texts, sample, 0.012), "tied")

    def contexts(batches):
        new, out, parsed = repeats.New(), repeats.Contexts(), Parsed()
        for batch in batches:
            k1, k2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offs = byte_rows(batch.column(3))
            fresh, places = new(k1, k2), batch.column(2)
            for lo, hi in row_slices(offs):
                for r, n, grams, prints in parsed.rows(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], length, seed):
                    if not fresh[lo + r]:
                        continue
                    at, firsts, sizes = repeats.anchors(grams, 0, n - length + 1, length, seed)
                    mine = np.isin(at, np.asarray(places[lo + r].values))
                    whole = prints(0, n - length + 1)
                    out.add(int(k1[lo + r]), int(k2[lo + r]), grams[at[mine]], at[mine], firsts[mine], sizes[mine],
                            lambda a, m: whole[a:a + m].tobytes())
                yield from out.batches(1 << 22)
        yield from out.batches()

    within = repeats.attach(texts, tied, "places", "inner", repeats.MAX_PLACES).select("_k1", "_k2", "places", "_text").mapInArrow(contexts, repeats.CONTEXT)

    def prints(payloads, n):
        data, offs = byte_rows(payloads)
        return np.frombuffer(data[offs[0]:offs[-1]].tobytes(), np.uint64)

    return repeats.repeated(within, prints, parse)


def factors(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """_k1, _k2, lo, n, source (_k1, _k2, lo), joined over block borders."""
    found = _parsed(docs, length, text_col).dropDuplicates(["_k1", "_k2", "lo"])
    order = Window.partitionBy("_k1", "_k2").orderBy("lo")
    goes_on = (F.lag(F.col("lo") + F.col("n")).over(order) == F.col("lo")) & (F.lag("s1").over(order) == F.col("s1")) \
        & (F.lag("s2").over(order) == F.col("s2")) & (F.lag(F.col("slo") + F.col("n")).over(order) == F.col("slo"))
    marked = found.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_f", F.sum("_new").over(order))
    joined = marked.groupBy("_k1", "_k2", "_f").agg(F.min("lo").alias("lo"), F.sum("n").cast("int").alias("n"), F.min_by(F.struct(
        F.col("s1").alias("_k1"), F.col("s2").alias("_k2"), F.col("slo").alias("lo")), "lo").alias("source"))
    return joined.drop("_f")


def remove(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    docs = docs.drop("n_words", "n_removed", "kept")
    names = docs.columns
    hits = repeats.hits(_parsed(docs, length, text_col), docs, text_col)
    both = repeats.attach(repeats.keyed(docs, text_col), hits, "hits", "left").select("row", "hits")
    at = names.index(text_col)

    def cut(batches):
        words = Words(WORD_BYTES)
        for batch in batches:
            whole, found = pa.RecordBatch.from_arrays(batch.column(0).flatten(), names=names), batch.column(1)
            data, offs = byte_rows(whole.column(at))
            for lo, hi in row_slices(offs):
                part = data[offs[lo]:offs[hi]]
                starts, ends, first = words.split(part, offs[lo:hi + 1] - offs[lo])
                removed, rest = [], []
                for i in range(lo, hi):
                    a, b = first[i - lo], first[i - lo + 1]
                    gone = repeats.covered(found[i].as_py() or (), int(b - a), length)
                    removed.append(int(gone.sum()))
                    raw = part[starts[a]:ends[b - 1]].tobytes() if b > a else b""
                    own = raw.split()
                    if removed[-1]:
                        own = [w for w, g in zip(own, gone.tolist()) if not g]
                    rest.append(b" ".join(own))
                rows = whole.slice(lo, hi - lo)
                kept = pa.array(rest, pa.binary()).cast(pa.string())
                yield with_columns(rows, n_words=pa.array(np.diff(first), pa.int64()), n_removed=pa.array(removed, pa.int64()), kept=kept)

    return both.mapInArrow(cut, same_rows(docs.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())))
