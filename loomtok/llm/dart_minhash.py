"""Near duplicates by DartMinHash signatures and banded joining.

A text's elements are its runs of five words (a shorter text that has words
is one run), each with its number of occurrences as weight.  Darts are
thrown by hash at the region of each element, one unit of weight after the
other: they arrive at random ranks, each bears a coordinate, and of the darts
of a text the earliest for each coordinate makes its signature.  Ranks are
followed only as far as the text's weight needs, so a text gets about as
many darts as the signature is long, whatever its size.  Two texts agree in
a coordinate with probability equal to their weighted Jaccard similarity.

Texts that agree in all coordinates of a band form a bucket.  First each
bucket's most central text (the one whose buckets hold the most texts) is
compared with the others of the bucket.  Buckets that still hold texts of
several components are then searched through: within blocks of bounded size,
and each pair of blocks of a large bucket, an inverted index of the shingles
gives the exact similarity of each text outside the largest component with
all others, and only links that join two components are written.  All
comparisons are exact.  A link is a similarity of ``least`` or more; classes
are the links' components, so ``groups`` loses no link but those that share
no band: at 0.8 one in 10**6.

Words are runs of other bytes than white space, with A-Z lowered.  Texts are
told apart by 128-bit hashes and copies share one signature.  ``groups``
returns the documents' rows with ``class_id`` (the smallest key in the
class, null if it has only null keys), ``class_size`` and ``first``, which
holds for the rows with that key; ``keep_first`` returns exactly one row of
each class.  Null texts and texts without words are never duplicates of
anything: each row is a class of its own with its own key.  Repeated rows
are copies.  Columns of the new names are replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.components import components
from loomtok.llm.flat import Runs, Words, byte_class, byte_rows, mix, row_slices, with_columns
from loomtok.llm.shared import table

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 28, 4
#: Texts whose 16-byte ids may be broadcast.
MAX_BROADCAST = 4_000_000
#: Bytes of text in one block of a bucket that is searched through.
BLOCK_BYTES = 8 << 20

WORD_BYTES = ~byte_class((0x09, 0x0D), (0x20, 0x20))
LOWER = np.arange(256)
LOWER[0x41:0x5B] += 32


class Shingles:
    """Hashed runs of words of each row of a slice, sorted within the row."""

    def __init__(self, n: int = SHINGLE):
        self.n, self.words, self.runs = n, Words(WORD_BYTES, LOWER), Runs()

    def of(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, their number before each row and after the last)."""
        n = self.n
        starts, ends, first = self.words.split(data, offs)
        sums = self.runs.sums(self.words.hashes(data, starts, ends))
        size = np.diff(first)
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(starts)) - first[:-1][row]
        found = [(self.runs.of(sums, n), np.flatnonzero(place <= (size - n)[row]))]
        for m in range(1, n):  # texts of fewer words
            short = first[:-1][size == m]
            found.append((self.runs.of(sums, m) if len(short) else sums, short))
        h = np.concatenate([h[at] for h, at in found])
        row = np.concatenate([row[at] for _, at in found])
        order = np.lexsort((h, row))
        return h[order], np.searchsorted(row[order], np.arange(len(size) + 1))


def units(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A hash for each unit of weight: the n-th occurrence of an element in a
    row is its n-th unit.  Rows' elements are sorted."""
    new = np.ones(len(h), np.bool_)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.arange(len(h))
    unit = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(h + unit.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Darts:
    def __init__(self, k: int):
        self.k = k

    def signatures(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """uint32, one row of k for each row that has elements, zeros for others."""
        k = self.k
        out = np.zeros((len(first) - 1, k), np.uint32)
        size = np.diff(first)
        row = np.repeat(np.arange(len(size)), size)
        cells = units(h, row)
        todo, darts = np.flatnonzero(size), k * (np.log(k) + 3)
        while len(todo):
            reach = np.zeros(len(size))
            reach[todo] = darts / size[todo]
            mine = reach[row] > 0
            full = self._throw(cells[mine], row[mine], reach, out)
            todo, darts = todo[~full[todo]], darts * 2
        return out

    def _throw(self, cells: np.ndarray, row: np.ndarray, reach: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Fills the signatures of the rows; tells which are full."""
        limit, found = reach[row], []
        many = limit > 4
        # a wide reach: all arrivals of a cell at once, many enough to pass the reach
        n = np.ceil(limit[many] + 7 * np.sqrt(limit[many]) + 12).astype(np.int64)
        ends = np.cumsum(n)
        begin = np.repeat(ends - n, n)
        turn = np.arange(len(begin)) - begin
        h = mix(np.repeat(cells[many], n) + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        gaps = np.concatenate([[0.0], np.cumsum(self._gap(h))])
        rank = gaps[1:] - gaps[begin]
        r = np.repeat(row[many], n)
        keep = rank <= reach[r]
        found.append((r[keep], rank[keep], h[keep]))
        # a narrow one: arrival by arrival, for the cells that are still within
        cell, r, rank, turn = cells[~many], row[~many], np.zeros(int((~many).sum())), 0
        while len(cell):
            turn += 1
            h = mix(cell + np.uint64(turn * 0xD1342543DE82EF95 & (1 << 64) - 1))
            rank = rank + self._gap(h)
            keep = rank <= reach[r]
            cell, r, rank = cell[keep], r[keep], rank[keep]
            found.append((r, rank, h[keep]))
        r, rank, h = (np.concatenate(x) for x in zip(*found))
        dart = mix(h + np.uint64(0x2545F4914F6CDD1D))
        spot = r * self.k + ((dart >> np.uint64(32)) * np.uint64(self.k) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((rank, spot))
        spot = spot[order]
        earliest = np.ones(len(spot), np.bool_)
        earliest[1:] = spot[1:] != spot[:-1]
        spot, order = spot[earliest], order[earliest]
        out.reshape(-1)[spot] = (dart[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return np.bincount(spot // self.k, minlength=len(reach)) == self.k

    @staticmethod
    def _gap(h: np.ndarray) -> np.ndarray:
        return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted lists of shingles."""
    if not len(a) or not len(b):
        return 0.0
    (x, m), (y, n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / (len(a) + len(b) - both)


def text_id(text_col: str = "text"):
    """128 bits; null for a null text."""
    return F.when(F.col(text_col).isNotNull(), F.struct(F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit(1), text_col).alias("b")))


def signatures(docs: DataFrame, text_col: str = "text", k: int = BANDS * ROWS) -> DataFrame:
    """id, sig (k times 4 bytes) of each text that has words, copies once."""
    texts = docs.select(text_id(text_col).alias("id"), F.col(text_col).alias("_text")).where(F.col("id").isNotNull())

    def run(batches):
        shingles, darts = Shingles(), Darts(k)
        for batch in batches:
            data, offs = byte_rows(batch.column(1))
            for lo, hi in row_slices(offs):
                h, first = shingles.of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                some = np.diff(first) > 0
                sigs = [s.tobytes() for s in darts.signatures(h, first)[some]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).filter(pa.array(some)), pa.array(sigs, pa.binary())], ["id", "sig"])

    schema = T.StructType([texts.schema["id"], T.StructField("sig", T.BinaryType())])
    return texts.mapInArrow(run, schema).groupBy("id").agg(F.first("sig").alias("sig"))


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar enough."""
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("a")), "u").select("u", "v", "a")
    both = both.join(texts.select(F.col("id").alias("v"), F.col("text").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches):
        shingles = Shingles()
        for batch in batches:
            sides = [byte_rows(batch.column(i)) for i in (2, 3)]
            keep = np.zeros(batch.num_rows, np.bool_)
            for lo, hi in row_slices(sides[0][1] + sides[1][1]):
                (x, at), (y, to) = (shingles.of(d[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]) for d, o in sides)
                for i in range(hi - lo):
                    keep[lo + i] = similarity(x[at[i]:at[i + 1]], y[to[i]:to[i + 1]]) >= least
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return both.mapInArrow(run, both.select("u", "v").schema)


def links(docs: DataFrame, least: float = LEAST, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Links between different texts (u, v), enough of them to connect all
    that are linked, and their components (node, root)."""
    sigs = table(signatures(docs, text_col), "signatures")
    size = 4 * ROWS
    bands = sigs.select("id", F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * size + 1, size)) for b in range(BANDS)])).alias("band"))
    grouped = table(bands.join(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "band"), "bands")
    ids = table(grouped.select("id").distinct(), "ids")
    n = ids.count()
    ids = F.broadcast(ids) if n <= MAX_BROADCAST else ids
    copies = docs.select(text_id(text_col).alias("id"), F.col(text_col).alias("text"))
    texts = table(copies.join(ids, "id", "left_semi").dropDuplicates(["id"]), "texts")
    score = grouped.groupBy("id").agg(F.sum("n").alias("score"))
    heads = grouped.join(score, "id").groupBy("band").agg(F.max(F.struct("score", "id")).alias("head")).select("band", F.col("head.id").alias("head"))
    stars = grouped.join(heads, "band").where(F.col("id") != F.col("head")).select(F.col("head").alias("u"), F.col("id").alias("v")).distinct()
    found = table(_verified(stars, texts, least), "stars")
    roots = components(found)

    # larger buckets whose texts are in several components yet
    placed = grouped.where("n > 2").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    size = texts.select("id", F.octet_length("text").alias("size"))
    open_ = placed.join(size, "id").groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum("size").alias("size"))
    open_ = open_.where("low < high").select("band", F.ceil(F.col("size") / BLOCK_BYTES).cast("int").alias("blocks"))
    dealt = placed.join(open_, "band").withColumn("i", F.pmod(F.xxhash64("band", "id"), "blocks").cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "id", "root")
    dealt = dealt.join(texts, "id").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    all_links = table(found.unionByName(_searched(dealt, least)), "links")
    return all_links, components(all_links)


def _searched(dealt: DataFrame, least: float) -> DataFrame:
    """Links (u, v) that join the components within each (band, i, j)."""
    dealt = dealt.select("band", "i", "j", "id", "root", "text")

    def search(rows: pa.Table):
        ids, root = rows.column("id").to_pylist(), rows.column("root").to_pylist()
        names = {r: n for n, r in enumerate(dict.fromkeys(tuple(r.values()) for r in root))}
        group = np.array([names[tuple(r.values())] for r in root])
        if len(names) < 2:
            return
        shingles = Shingles()
        cells, owner, total = [], [], np.zeros(len(ids))
        data, offs = byte_rows(rows.column("text").combine_chunks())
        for lo, hi in row_slices(offs):
            h, first = shingles.of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            total[lo:hi] = np.diff(first)
            owner.append(np.repeat(np.arange(lo, hi), np.diff(first)))
            cells.append(units(h, owner[-1]))
        cells, owner = np.concatenate(cells), np.concatenate(owner)
        _, cells = np.unique(cells, return_inverse=True)
        start = np.searchsorted(owner, np.arange(len(ids) + 1))
        order = np.argsort(cells, kind="stable")
        holders, at = owner[order], np.searchsorted(cells[order], np.arange(cells.max() + 2 if len(cells) else 1))
        largest = np.bincount(group).argmax()
        for x in np.flatnonzero(group != largest):
            mine = cells[start[x]:start[x + 1]]
            shared = np.bincount(np.concatenate([holders[at[c]:at[c + 1]] for c in mine] or [np.zeros(0, np.int64)]), minlength=len(ids))
            alike = shared >= least * (total[x] + total - shared)
            while len(other := np.flatnonzero(alike & (group != group[x]) & (shared > 0))):
                y = other[0]
                yield ids[x], ids[y]
                group[group == group[y]] = group[x]

    def run(batches):
        held: list[pa.RecordBatch] = []
        key = None
        out = pa.struct([("a", pa.int64()), ("b", pa.int64())])

        def done():
            found = list(search(pa.Table.from_batches(held)))
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], out) for k in (0, 1)], ["u", "v"])

        for batch in batches:
            keys = [np.asarray(batch.column(c)) for c in range(3)]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                new = tuple(int(k[a]) for k in keys)
                if new != key and held:
                    yield done()
                    held = []
                key = new
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    kind = dealt.schema["id"].dataType
    return dealt.mapInArrow(run, T.StructType([T.StructField("u", kind), T.StructField("v", kind)]))


def groups(docs: DataFrame, least: float = LEAST, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _classed(docs.drop("class_id", "class_size", "first"), least, key, text_col).select("row.*", "class_id", "class_size", "first")


def _classed(docs: DataFrame, least: float, key: str, text_col: str) -> DataFrame:
    """row (all columns, whatever their names), root, class_id, class_size,
    first.  Classes are worked out on ids and keys alone; the rows then meet
    only those of the texts that have company."""
    _, roots = links(docs, least, text_col)
    wordless = F.col(text_col).isNull() | (F.trim(F.regexp_replace(text_col, r"[\t-\r]", " ")) == "")
    keyed = docs.select(F.when(~wordless, text_id(text_col)).alias("id"), F.col(key).alias("key"), F.struct(*docs.columns).alias("row"))
    roots = roots.withColumnRenamed("node", "id")
    slim = keyed.select("id", "key").where(F.col("id").isNotNull()).join(roots, "id", "left")
    sizes = slim.groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    nodes = roots.unionByName(sizes.select(F.col("root").alias("id"), "root"))
    company = table(nodes.join(sizes, "root"), "company")
    company = F.broadcast(company) if company.count() <= MAX_BROADCAST else company
    out = keyed.join(company, "id", "left").select(
        "row", "root", "key", F.when(F.col("n").isNull(), F.col("key")).otherwise(F.col("least")).alias("class_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("class_size"))
    return out.withColumn("first", F.col("root").isNull() | F.col("key").eqNullSafe(F.col("class_id"))).drop("key")


def keep_first(docs: DataFrame, least: float = LEAST, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with its own columns."""
    firsts = _classed(docs, least, key, text_col).where("first")
    several = firsts.where(F.col("root").isNotNull()).dropDuplicates(["root"])
    return firsts.where(F.col("root").isNull()).unionByName(several).select("row.*")
