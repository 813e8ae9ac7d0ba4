"""What the two exact repeat operators share: sequences of symbols, anchors,
ties of fingerprints over all texts, and windows that occur twice.

A text is a sequence of symbols (bytes or words), a window is a run of ``w``
of them.  Texts are told apart by 128 bits (``_k1``, ``_k2``), a null text
counts as an empty one.  Copies of a text are worked on once in each input
partition and count as one text; that they are copies is known from their
number.

Window fingerprints are 64-bit polynomial hashes of random symbol values,
compared only under one 64-bit anchor, so two different windows pass for
equal with probability 2**-128.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.llm.flat import Powers, U64, byte_rows, mix, random_table, row_slices
from loomtok.llm.shared import table

#: Fingerprints that one bucket holds on average, and that a task holds before it writes them.
BUCKET, HELD = 1 << 20, 1 << 19
#: Places known to be tied that one row holds.
KNOWN = 1 << 14
#: Bytes of a small table that may be broadcast; a larger one is joined by shuffle.
MAX_BYTES = 128 << 20
#: What a row with its key, and an item of its array, take as Spark holds them (a struct of two ints is the larger item).
ROW_BYTES, ITEM_BYTES = 64, 32
#: Tied places that may be broadcast, of which there are many more than rows.
MAX_PLACES = 250_000
#: Contexts of one anchor that meet in one task; the windows of more are grouped by fingerprint.
CROWD = 10_000
POSITION = U64((1 << 20) - 1)
#: Starts that one call of ``anchors`` looks at.
PIECE = 1 << 19


class Sequence:
    """Prefix sums over symbol values, for hashes of any run."""

    def __init__(self):
        self.powers = Powers(0x9FB21C651E98DF25)

    def sums(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.powers.to(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[:len(values)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        _, down = self.powers.to(len(sums))
        return mix((sums[starts + n] - sums[starts]) * down[starts])


BYTE_VALUES = random_table(256, 1)


def least_in(values: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each ``w`` values that follow each other."""
    n = len(values) - w + 1
    padded = np.full(-(-len(values) // w) * w, ~U64(0), U64)
    padded[:len(values)] = values
    block = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchors(grams: np.ndarray, lo: int, hi: int, w: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the windows that start at lo..hi-1, their anchors: the leftmost
    of the smallest hashes of ``k`` symbols in the window.  ``grams`` has the
    hash at each place of the text.  Equal windows have equal anchors at
    equal places.  Returns (place of the anchor, first start, starts)."""
    places, firsts, sizes = [], [], []
    for a in range(lo, hi, PIECE):
        b = min(a + PIECE, hi)
        part = grams[a:b + w - k]
        found = least_in((part & ~POSITION) | np.arange(len(part), dtype=U64), w - k + 1) & POSITION
        edge = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        places.append(found[edge].astype(np.int64) + a)
        firsts.append(edge + a)
        sizes.append(np.diff(np.append(edge, b - a)))
    return np.concatenate(places), np.concatenate(firsts), np.concatenate(sizes)


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """_k1, _k2 and row, which holds all columns whatever their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"), F.struct(*docs.columns).alias("row"))


def texts_of(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"), text.alias("_text"))


class New:
    """Rows whose text this task meets for the first time."""

    def __init__(self):
        self.seen: set[tuple[int, int]] = set()

    def __call__(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k1), np.bool_)
        for i, k in enumerate(zip(k1.tolist(), k2.tolist())):
            if k not in self.seen:
                self.seen.add(k)
                out[i] = True
        return out


def ties(texts: DataFrame, sample, density: float) -> DataFrame:
    """_k1, _k2, places (array<int>) of the sampled places whose fingerprint
    is found at another place of any text.  ``sample(data, offs)`` gives
    (fingerprints, rows, places), rows in order; ``density`` is about how
    many there are for each byte.  Fingerprints are dealt out to buckets by
    their leading bits and sorted one bucket at a time.  Of those that a task
    holds together, all places of one fingerprint are settled there and only
    one goes to the bucket, so a frequent fingerprint doesn't fill it."""
    n_bytes = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = max(6, int(np.ceil(np.log2(max(1, n_bytes * density / BUCKET)))))
    dealt = dealt_out(texts, sample, bits).repartition("bucket").sortWithinPartitions("bucket")

    def sort(batches):
        def places(rows, mark=None):
            n = np.concatenate([np.frombuffer(r[3], np.int32) for r in rows])
            k1, k2 = (np.repeat(np.concatenate([np.frombuffer(r[i], np.int64) for r in rows]), n) for i in (1, 2))
            place = np.concatenate([np.frombuffer(r[4], np.int32) for r in rows])
            if mark is not None:
                own = mark(np.concatenate([np.frombuffer(r[0], U64) for r in rows]), k1, k2, place)
                k1, k2, place = k1[own], k2[own], place[own]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (k1, k2, place)], ["_k1", "_k2", "place"])

        for bucket, held in grouped(batches):
            rows = (r for b in held for r in zip(*(b.column(i).to_pylist() for i in range(1, 6))))
            if bucket < 0:
                yield from (places([r]) for r in rows)
            else:
                yield places(list(rows), twice)

    found = dealt.mapInArrow(sort, "_k1 long, _k2 long, place int")
    return found.groupBy("_k1", "_k2").agg(F.collect_set("place").alias("places"))


def dealt_out(texts: DataFrame, sample, bits: int) -> DataFrame:
    """bucket, h, k1, k2, n, place: samples packed by bucket, which are the
    leading ``bits`` of the fingerprint; those under a negative bucket are
    known to be tied and have no fingerprint."""

    def deal(batches):
        new, held, size = New(), [], 0

        def flush():
            h, k1, k2, place = (np.concatenate(x) for x in zip(*held))

            def packed(own, h):
                edge = np.flatnonzero(np.concatenate([[True], (k1[own][1:] != k1[own][:-1]) | (k2[own][1:] != k2[own][:-1])]))
                parts = [h, k1[own][edge], k2[own][edge], np.diff(np.append(edge, len(own))).astype(np.int32), place[own].astype(np.int32)]
                return [x.tobytes() for x in parts]

            known = twice(h, k1, k2, place)
            one = np.zeros(len(h), np.bool_)
            one[np.unique(h, return_index=True)[1]] = True
            sent = np.flatnonzero(~known | one)
            bucket = (h[sent] >> U64(64 - bits)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(order)]):
                own = sent[order[a:b]]
                yield int(bucket[order[a]]), packed(own, h[own])
            known = np.flatnonzero(known)
            for a in range(0, len(known), KNOWN):  # to any task, by what they hold
                own = known[a:a + KNOWN]
                yield -1 - int(mix(k1[own[:1]].view(U64) + place[own[:1]].astype(U64))[0] >> U64(34)), packed(own, h[:0])

        def rows(found):
            found = list(found)
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), *[pa.array([p[i] for _, p in found], pa.binary()) for i in range(5)]],
                                              ["bucket", "h", "k1", "k2", "n", "place"])

        for batch in batches:
            k1, k2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offs = byte_rows(batch.column(2))
            for lo, hi in row_slices(offs):
                fresh = new(k1[lo:hi], k2[lo:hi])
                h, row, place = sample(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                keep = fresh[row]
                if keep.any():
                    held.append((h[keep], k1[lo:hi][row[keep]], k2[lo:hi][row[keep]], place[keep]))
                    size += int(keep.sum())
                if size > HELD:
                    yield rows(flush())
                    held, size = [], 0
        if held:
            yield rows(flush())

    return texts.mapInArrow(deal, "bucket int, h binary, k1 binary, k2 binary, n binary, place binary")


def grouped(batches):
    """(value, batches) of the runs of equal values in a sorted first column."""
    key, held = None, []
    for batch in batches:
        k = np.asarray(batch.column(0))
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(k)]):
            if a == b:
                continue
            if held and int(k[a]) != key:
                yield key, held
                held = []
            key = int(k[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield key, held


def twice(h: np.ndarray, *who: np.ndarray) -> np.ndarray:
    """Which entries have a fingerprint that another entry, told apart by
    ``who``, has as well."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.cumsum(first) - 1
    head = order[np.flatnonzero(first)][group]
    other = np.zeros(len(h), np.bool_)
    for x in who:
        other |= x[order] != x[head]
    out = np.zeros(len(h), np.bool_)
    out[order] = np.bincount(group[other], minlength=group[-1] + 1 if len(group) else 0).astype(np.bool_)[group] if len(h) else False
    return out


def attach(left: DataFrame, right: DataFrame, items: str, how: str, most: int | None = None) -> DataFrame:
    """Joins by text key; ``right`` (a written table) goes to every executor
    where it is small enough, by its rows and the items of its array column."""
    n, m = right.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(items)), F.lit(0))).first()
    small = n * ROW_BYTES + m * ITEM_BYTES <= MAX_BYTES and (most is None or m <= most)
    return left.join(F.broadcast(right) if small else right, ["_k1", "_k2"], how)


CONTEXT = "g long, _k1 long, _k2 long, lo int, n int, payload binary, known boolean, again int"


class Contexts:
    """Rows of ``CONTEXT`` in the making: an anchor's windows in one text.
    Equal contexts of one text are repeats of each other: the first stands
    for all, the others are known and need no payload.  ``again`` is where
    such a context stands as well."""

    def __init__(self):
        self.rows: list[list] = []
        self.size = 0

    def add(self, k1: int, k2: int, g: np.ndarray, places: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, payload) -> None:
        met: dict[tuple, list] = {}
        for h, place, lo, n in zip(g.view(np.int64).tolist(), places.tolist(), firsts.tolist(), sizes.tolist()):
            raw = payload(lo, n)
            row = met.get((h, place - lo, raw))
            if row is None:
                met[h, place - lo, raw] = row = [h, k1, k2, lo, n, raw, False, None]
                self.rows.append(row)
                self.size += len(raw)
            else:
                row[6:] = True, lo
                self.rows.append([None, k1, k2, lo, n, None, True, row[3]])

    def batches(self, least: int = 0):
        if self.rows and self.size >= least:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.rows), kinds)], ["g", "_k1", "_k2", "lo", "n", "payload", "known", "again"])
            self.rows, self.size = [], 0


#: Schema of what ``settle`` returns.
RUN = "_k1 long, _k2 long, lo int, n int, s1 long, s2 long, slo int"


def marks(n: np.ndarray, owner: np.ndarray, start: np.ndarray, h: np.ndarray, rows: pa.Table) -> pa.RecordBatch:
    """Runs of windows whose fingerprint another place has as well; they have no source."""
    k1, k2 = (np.asarray(rows.column(c)) for c in ("_k1", "_k2"))
    hit = twice(h, k1[owner], k2[owner], start) | np.asarray(rows.column("known"))[owner]
    before = np.concatenate([[False], hit[:-1]]) & np.concatenate([[False], owner[1:] == owner[:-1]])
    begin = np.flatnonzero(hit & ~before)
    after = np.concatenate([hit[1:], [False]]) & np.concatenate([owner[1:] == owner[:-1], [False]])
    size = np.flatnonzero(hit & ~after) - begin + 1
    own = owner[begin]
    return runs_of(k1[own], k2[own], start[begin], size)


def runs_of(k1, k2, lo, n, s1=None, s2=None, slo=None) -> pa.RecordBatch:
    none = lambda x, kind: pa.nulls(len(k1), kind) if x is None else pa.array(x, kind)
    columns = [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(np.asarray(lo, np.int32)), pa.array(np.asarray(n, np.int32)),
               none(s1, pa.int64()), none(s2, pa.int64()), none(slo, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["_k1", "_k2", "lo", "n", "s1", "s2", "slo"])


def repeated(contexts: DataFrame, prints, settle=marks) -> DataFrame:
    """_k1, _k2, lo, n, s1, s2, slo: runs of window starts that also occur
    elsewhere, and where (text and start; null where that isn't told).
    ``prints(payloads, n)`` gives the fingerprints of the windows of some
    contexts, one after the other; ``settle(n, owner, start, fingerprints,
    contexts)`` the runs of the contexts of some whole anchors."""
    contexts = table(contexts, "contexts")
    whole = contexts.where("payload IS NOT NULL")
    crowds = table(whole.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CROWD).select("g"), "crowds")
    crowded = not crowds.isEmpty()
    few = whole.join(crowds, "g", "left_anti") if crowded else whole
    few = few.select("g", "_k1", "_k2", "lo", "n", "payload", "known", "again").repartition("g").sortWithinPartitions("g")

    def windows(rows: pa.Table):
        n = np.asarray(rows.column("n"), np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        ends = np.cumsum(n)
        start = np.arange(ends[-1]) - (ends - n)[owner] + np.asarray(rows.column("lo"))[owner]
        h = prints(rows.column("payload").combine_chunks(), n) ^ mix(np.asarray(rows.column("g")).view(U64))[owner]
        return n, owner, start, h

    def runs(rows: pa.Table):
        return settle(*windows(rows), rows)

    def match(batches):
        held, size = [], 0
        for _, rows in grouped(batches):
            if sum(b.num_rows for b in rows) == 1 and not rows[0].column("known")[0].as_py():
                continue
            held += rows
            size += sum(b.column("n").to_numpy().sum() for b in rows)
            if size > 1 << 18:
                yield runs(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield runs(pa.Table.from_batches(held))

    own = [F.col("_k1").alias("s1"), F.col("_k2").alias("s2"), F.col("again").alias("slo")]
    found = few.mapInArrow(match, RUN).unionByName(contexts.where("payload IS NULL").select("_k1", "_k2", "lo", "n", *own))
    if not crowded:
        return found

    def spread(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = pa.Table.from_batches([batch.slice(a, 500)])
                _, owner, start, h = windows(rows)
                again = np.asarray(rows.column("again").combine_chunks().fill_null(-1))[owner]
                again = np.where(again < 0, -1, again + start - np.asarray(rows.column("lo"))[owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(rows.column(c))[owner]) for c in ("g", "_k1", "_k2")]
                                                 + [pa.array(start.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(np.asarray(rows.column("known"))[owner]), pa.array(again)],
                                                 ["g", "_k1", "_k2", "lo", "h", "known", "again"])

    each = whole.join(crowds, "g", "left_semi").select("g", "_k1", "_k2", "lo", "n", "payload", "known", "again")
    each = each.mapInArrow(spread, "g long, _k1 long, _k2 long, lo int, h long, known boolean, again int")
    who = F.struct("_k1", "_k2", "lo")
    two = each.groupBy("g", "h").agg(F.min(who).alias("a"), F.max(who).alias("b"), F.max("known").alias("k")).where("a != b OR k").drop("k")
    other = (F.when(F.col("a") != who, F.col("a")).when(F.col("b") != who, F.col("b"))
             .when(F.col("again") >= 0, F.struct("_k1", "_k2", F.col("again").alias("lo"))))
    ones = each.join(two, ["g", "h"]).select("_k1", "_k2", "lo", F.lit(1).alias("n"), other.alias("o"))
    return found.unionByName(ones.select("_k1", "_k2", "lo", "n", F.col("o._k1").alias("s1"), F.col("o._k2").alias("s2"), F.col("o.lo").alias("slo")))


def hits(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """_k1, _k2, hits (array of lo, n) of texts with repeated windows; of a
    text with copies every window is one."""
    copies = texts_of(docs, text_col).groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = copies.select("_k1", "_k2", F.lit(0).alias("lo"), F.lit((1 << 31) - 1).alias("n"))
    both = found.select("_k1", "_k2", "lo", "n").unionByName(copies)
    return table(both.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("lo", "n")).alias("hits")), "hits")


def covered(hits: list[dict], size: int, w: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a window that starts in the hits."""
    edge = np.zeros(size + 1, np.int32)
    last = size - w + 1
    for h in hits:
        end = min(h["lo"] + h["n"], last)
        if end > h["lo"]:
            edge[h["lo"]] += 1
            edge[end - 1 + w] -= 1
    return np.cumsum(edge[:-1]) > 0
