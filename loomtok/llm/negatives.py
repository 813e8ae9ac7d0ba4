"""Hard-negative mining with segment summaries that bound scores.

A row's score is its inner product with the anchor, in whole numbers: each
component x counts as floor(256 * x).  An anchor's positives are its ``k``
best other rows of the same label; for each positive, its hard negatives are
the ``k`` best rows of other labels whose score lies between ``least`` per
cent of the positive's and the positive's own.  Higher scores come first,
then smaller ids.

Every vector is stored with the mean and the deviation (root of the sum of
squared differences from the mean) of each of ``SEGMENTS`` segments.  Over a
segment of w components the inner product is w times the product of the means,
give or take the product of the deviations; the summaries of wider segments
follow from those of the narrow ones.  A search goes from one segment to 4 to
16, at each step drops the rows whose bounds rule them out (below the k-th
best lower bound, or outside every positive's range), and scores the rest
exactly.  Bounds are widened by far more than floating point can lose.

Rows are dealt to parts by hash and anchors to blocks, so a label or source
with a third of all rows is no special case: each part meets each block in a
task of its own, and gives the best k for each anchor and positive, which are
merged.  Nothing is sent to the driver but the numbers of rows and anchors.

Rows with a null id or label, a null vector, or null or non-finite components
take no part, nor do those whose squared whole components sum to 2**62 or
more (their scores might pass 64 bits).  Rows are compared with rows of their
own length only; empty vectors score 0.  Rows that repeat id, label and
vector count once; one id with several is several rows, and never its own
positive or negative.  Other columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtok.llm.shared import table

SEGMENTS = 16
#: Segments that one of the next level holds.
FAN = 4
#: Rows and anchors that meet in one task.
PART_ROWS, BLOCK_ANCHORS = 4_096, 1_024


def edges(width: int) -> np.ndarray:
    """Bounds of the narrowest segments of vectors with ``width`` components."""
    return np.arange(SEGMENTS + 1) * width // SEGMENTS


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row."""
    cut = edges(v.shape[1])
    size = np.diff(cut)
    sums = np.zeros((len(v), v.shape[1] + 1))
    np.cumsum(v, axis=1, out=sums[:, 1:])
    mean = (sums[:, cut[1:]] - sums[:, cut[:-1]]) / np.maximum(size, 1)
    off = np.zeros_like(sums)
    np.cumsum((v - np.repeat(mean, size, axis=1)) ** 2, axis=1, out=off[:, 1:])
    return mean, np.sqrt(np.maximum(off[:, cut[1:]] - off[:, cut[:-1]], 0))


class Vectors:
    """Rows of one length with their summaries, the widest segments first."""

    def __init__(self, rows: pa.Table):
        ids = rows.column("id").to_numpy()
        labels = np.array(rows.column("label").to_pylist(), object)
        order = np.lexsort((ids, labels.astype(str)))
        self.rows = rows.take(pa.array(order))
        self.ids, self.labels = ids[order], labels[order]
        matrix = lambda c, n, kind: self.rows.column(c).combine_chunks().flatten().to_numpy().astype(kind).reshape(len(ids), n)
        self.width = len(rows.column("q")[0].as_py())
        self.whole = matrix("q", self.width, np.int64)
        mean, off, size = matrix("mean", SEGMENTS, float), matrix("off", SEGMENTS, float), np.diff(edges(self.width)).astype(float)
        self.levels = [(size, mean, off)]
        while len(size) > 1:
            part = lambda x: x.reshape(*x.shape[:-1], -1, FAN)
            wide = part(size).sum(axis=-1)
            m = (part(size) * part(mean)).sum(axis=-1) / np.maximum(wide, 1)
            off = np.sqrt((part(off) ** 2 + part(size) * (part(mean) - m[..., None]) ** 2).sum(axis=-1))
            size, mean = wide, m
            self.levels.insert(0, (size, mean, off))
        self.norm = np.sqrt((self.whole.astype(float) ** 2).sum(axis=1))
        #: doubles are exact as long as no sum of products passes 2**53
        self.small = self.whole.astype(float) if (self.norm.max(initial=0) + 1) ** 2 < 2 ** 53 else None

    def bounds(self, level: int, at: np.ndarray, other: Vectors, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the scores of rows ``at`` with row j of ``other``."""
        size, mean, off = self.levels[level]
        middle, room = mean[at] @ (size * other.levels[level][1][j]), off[at] @ other.levels[level][2][j]
        room = room + 1e-9 * self.norm[at] * other.norm[j] + 1e-6
        return middle - room, middle + room

    def exact(self, at: np.ndarray, other: Vectors, j: int) -> np.ndarray:
        if self.small is not None and other.small is not None:
            return np.rint(self.small[at] @ other.small[j]).astype(np.int64)
        return self.whole[at] @ other.whole[j]

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in ``at`` of the k best."""
        return np.lexsort((self.ids[at], -scores))[:k]


def kth(x: np.ndarray, k: int) -> float:
    return np.partition(x, len(x) - k)[len(x) - k]


def positives(near: Vectors, anchors: Vectors, j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of an anchor's best of its own label."""
    at = np.flatnonzero((near.labels == anchors.labels[j]) & (near.ids != anchors.ids[j]))
    for level in range(len(near.levels)):
        if len(at) <= k:
            break
        low, high = near.bounds(level, at, anchors, j)
        at = at[high >= kth(low, k)]
    scores = near.exact(at, anchors, j)
    top = near.best(at, scores, k)
    return at[top], scores[top]


def negatives(near: Vectors, anchors: Vectors, j: int, wanted: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each range (lowest, highest score) the best rows of other labels."""
    at = np.flatnonzero((near.labels != anchors.labels[j]) & (near.ids != anchors.ids[j]))
    for level in range(len(near.levels)):
        low, high = near.bounds(level, at, anchors, j)
        needed = np.zeros(len(at), bool)
        for least, most in wanted:
            sure = low[(low >= least) & (high <= most)]
            needed |= (high >= (max(least, kth(sure, k)) if len(sure) >= k else least)) & (low <= most)
        at = at[needed]
    scores = near.exact(at, anchors, j)
    out = []
    for least, most in wanted:
        fits = np.flatnonzero((scores >= least) & (scores <= most))
        fits = fits[near.best(at[fits], scores[fits], k)]
        out.append((at[fits], scores[fits]))
    return out


def index(rows: DataFrame, is_anchor: Column, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, q (whole components), anchor, mean, off of the rows that take part; written once."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
    fine &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v.cast("array<double>"), lambda x: F.floor(x * 256))
    named = rows.where(fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), whole.alias("q"),
                                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    known = named.where(square < 2.0 ** 62).withColumn("q", F.col("q").cast("array<int>")).distinct()

    def run(batches):
        for batch in batches:
            q = batch.column(2)
            wide = q.value_lengths().to_numpy()
            mean, off = np.zeros((len(wide), SEGMENTS)), np.zeros((len(wide), SEGMENTS))
            for w in np.unique(wide):
                own = np.flatnonzero(wide == w)
                mean[own], off[own] = summaries(q.take(pa.array(own)).flatten().to_numpy().astype(float).reshape(len(own), w))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(wide) + 1) * SEGMENTS, pa.int32()), pa.array(x.reshape(-1))) for x in (mean, off)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=["id", "label", "q", "anchor", "mean", "off"])

    return table(known.mapInArrow(run, "id long, label string, q array<int>, anchor boolean, mean array<double>, off array<double>"), "vectors")


def mine(rows: DataFrame, is_anchor: Column, k: int = 5, least: int = 80, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score; ``is_anchor`` on the rows' own columns."""
    known = index(rows, is_anchor, id_col, vector_col, label_col)
    sizes = known.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    parts, blocks = (-(-sizes.rows // PART_ROWS) or 1, -(-sizes.anchors // BLOCK_ANCHORS) or 1)
    own = F.xxhash64("id", "label", "q")
    near = known.drop("anchor").withColumns({"width": F.size("q"), "part": F.pmod(own, F.lit(parts)), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    asked = known.where("anchor").drop("anchor").withColumns({"width": F.size("q"), "key": own})
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int"))
    keys = ["width", "part", "block"]

    def by_part(df: DataFrame) -> DataFrame:
        # names of their own, since rows and anchors come from one table
        every = df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return every.toDF(*every.columns)

    def table_of(names: list[str], kinds: list[pa.DataType], out: list[tuple]) -> pa.Table:
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, zip(*out) if out else [[]] * len(names), kinds)})

    def find_positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            a, v = Vectors(anchors), Vectors(rows)
            own = a.rows.column("key").to_numpy()
            for j in range(len(own)):
                at, scores = positives(v, a, j, k)
                out += [(int(a.ids[j]), int(own[j]), int(v.ids[i]), int(s)) for i, s in zip(at, scores)]
        return table_of(["anchor_id", "key", "id", "score"], [pa.int64()] * 4, out)

    best = near.groupBy(*keys).cogroup(by_part(asked).groupBy(*keys)).applyInArrow(find_positives, "anchor_id long, key long, id long, score long")
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    best = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    held = best.groupBy("anchor_id", "key").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("positives"))
    asked = asked.join(held.withColumnRenamed("anchor_id", "id"), ["id", "key"])

    def find_negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            a, v = Vectors(anchors), Vectors(rows)
            own, listed = a.rows.column("key").to_numpy(), a.rows.column("positives").to_pylist()
            for j in range(len(own)):
                # least <= 100 * score / positive score <= 100, in whole numbers
                wanted = [(-(-least * p["score"] // 100), p["score"]) for p in listed[j]]
                for p, (at, scores) in zip(listed[j], negatives(v, a, j, wanted, k)):
                    out += [(int(a.ids[j]), int(own[j]), p["r"], p["id"], p["score"], int(v.ids[i]), int(s)) for i, s in zip(at, scores)]
        return table_of(["anchor_id", "key", "r", "positive_id", "positive_score", "negative_id", "negative_score"],
                        [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4], out)

    found = near.groupBy(*keys).cogroup(by_part(asked).groupBy(*keys)).applyInArrow(
        find_negatives, "anchor_id long, key long, r int, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "key", "r").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
