"""Approximate nearest neighbours by a hierarchical k-means tree.

``fit`` splits a bounded sample (``MAX_SAMPLE`` vectors and ``SAMPLE_BYTES``,
those whose ``xxhash64(id)`` come first) by k-means, level after level, to
leaves of about ``LEAF_SAMPLE``.  Every row is then indexed: it goes down to
the nearest centre of each level.  A query visits leaves best bin first: a
priority queue holds the open nodes by the inner product of query and
centre.  ``calibrate`` widens the number of visited leaves until up to
``TRIALS`` queries, compared with all rows by brute force, reach the wanted
recall; a query whose leaves hold fewer than ``k`` candidates goes on to the
next ones.  ``search`` deals rows and queries out by bins: neighbouring small
leaves share one, a large leaf has several parts by hash of the id, and the
queries of a bin come in blocks.  In each, matrix products of a leaf's rows
and the queries that visit it give each query's best ``k`` of the bin; those
are merged.

Nearness is the inner product in double precision of the original vectors;
of equal scores the smaller id goes first.  Null ids, null, empty and zero
vectors, vectors with null or non-finite components, and those of another
length than most of the sample take no part, neither as queries nor as
candidates.  Rows that repeat id and vector count once; one id with several
vectors is several candidates, and as a query gets the nearest of all of
them.  Fewer candidates than ``k`` give all of them.  An empty table gives
an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtok.llm.shared import table

MAX_SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
LEAF_SAMPLE = 60
BRANCHES = 8
TRIALS = 100
#: Rows of a bin and queries that meet in one task.
PART_ROWS, BLOCK_QUERIES = 4_096, 4_096


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (doubles) of the rows that take part."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    fine &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(fine).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


class Tree:
    """Nodes by number, the root is 0; ``below[n]`` are its children (none: a leaf)."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        self.centres, self.below = [sample.mean(axis=0)], [[]]
        rng = np.random.default_rng(seed)
        todo = [(0, np.unique(sample, axis=0))]
        while todo:
            node, own = todo.pop()
            if len(own) <= 2 * LEAF_SAMPLE:
                continue
            n = min(BRANCHES, -(-len(own) // LEAF_SAMPLE))
            centres = own[rng.choice(len(own), n, replace=False)]
            for _ in range(12):
                near = self._nearest(own, centres)
                centres = np.stack([own[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(n)])
            near = self._nearest(own, centres)
            kept = [i for i in range(n) if (near == i).any()]
            if len(kept) < 2:
                continue
            for i in kept:
                self.centres.append(centres[i])
                self.below.append([])
                self.below[node].append(len(self.below) - 1)
                todo.append((len(self.below) - 1, own[near == i]))
        self.centres = np.stack(self.centres)
        self._leaves()

    def plain(self) -> tuple:
        return self.centres, self.below

    @classmethod
    def of(cls, plain: tuple) -> Tree:
        tree = cls.__new__(cls)
        tree.centres, tree.below = plain
        tree._leaves()
        return tree

    def _leaves(self) -> None:
        self.leaves, open_ = [], [0]  # neighbours in the tree stand together
        while open_:
            node = open_.pop()
            open_ += self.below[node]
            if not self.below[node]:
                self.leaves.append(node)

    @staticmethod
    def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return (rows @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            below = np.array(self.below[node])
            if not len(below) or not len(own):
                out[own] = node
                continue
            near = self._nearest(rows[own], self.centres[below])
            todo += [(int(n), own[near == i]) for i, n in enumerate(below)]
        return out

    def visits(self, query: np.ndarray, n: int, ids: dict[int, int] | None = None, k: int = 0) -> list[int]:
        """The first ``n`` leaves, best bin first, and further ones until they
        hold ``k`` candidates; ``ids`` has the distinct ids of each leaf, one
        of which may be the query's own."""
        score = -(self.centres @ query)
        queue, found, held = [(score[0], 0)], [], 0
        while queue and (len(found) < n or held < k):
            _, node = heapq.heappop(queue)
            if not self.below[node]:
                found.append(node)
                held += max((ids or {}).get(node, 0) - 1, 0)
            for b in self.below[node]:
                heapq.heappush(queue, (score[b], b))
        return found


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def fit(rows: DataFrame) -> Tree | None:
    """``rows`` from ``usable``."""
    widest = rows.agg(F.max(F.size("v"))).first()[0]
    if widest is None:
        return None
    n = max(1000, min(MAX_SAMPLE, SAMPLE_BYTES // (8 * widest)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n).select("v").toArrow().column("v").combine_chunks()
    lengths = sample.value_lengths().to_numpy()
    width = int(np.bincount(lengths).argmax())
    return Tree(matrix(sample.filter(pa.array(lengths == width)), width))


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and scores of the k best; equal scores are told apart by id, so
    the products near the k-th are computed anew, each by itself."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth - 1e-9 * max(1.0, abs(kth)))
    else:
        near = np.arange(len(scores))
    exact = (rows[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order], exact[order]


def calibrate(rows: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """Leaves to visit so that the trial queries find ``recall`` of their k
    nearest; brute force over all rows, best k of each task merged."""
    width = tree.centres.shape[1]
    trials = queries.where(F.size("v") == width).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(TRIALS).toArrow()
    if not len(trials) or len(tree.leaves) < 2:
        return 1
    own, wanted = trials.column("id").to_numpy(), matrix(trials.column("v").combine_chunks(), width)
    shared = rows.sparkSession.sparkContext.broadcast((tree.plain(), own, wanted))

    def run(batches):
        plain, own, wanted = shared.value
        tree = Tree.of(plain)
        held = [(np.zeros(0), np.zeros(0, np.int64))] * len(own)
        for batch in batches:
            ids, v = np.asarray(batch.column(0)), matrix(batch.column(1), width)
            scores, leaf = wanted @ v.T, tree.leaf(v)
            for q in range(len(own)):
                s = np.where(ids == own[q], -np.inf, scores[q])
                top = np.argpartition(-s, k - 1)[:k] if len(s) > k else np.arange(len(s))
                s, f = np.concatenate([held[q][0], s[top]]), np.concatenate([held[q][1], leaf[top]])
                top = np.argsort(-s, kind="stable")[:k]
                held[q] = s[top], f[top]
        for q, (s, f) in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array(s), pa.array(f)], ["q", "score", "leaf"])

    part = rows.where(F.size("v") == width).mapInArrow(run, "q long, score double, leaf long").where(F.col("score") > float("-inf"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    true = part.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "leaf").toPandas()
    if not len(true):
        return 1
    rank = [{leaf: n for n, leaf in enumerate(tree.visits(w, len(tree.leaves)))} for w in wanted]
    need = np.array([rank[q][leaf] for q, leaf in zip(true.q, true.leaf)])
    n = 1
    while (need < n).mean() < recall:
        n += 1
    return n


def search(rows: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, the neighbour's id, score; ``is_query`` on the rows' own columns."""
    vectors, queries = usable(rows, id_col, vector_col), usable(rows.where(is_query), id_col, vector_col)
    schema = f"query_id long, rank int, {id_col} long, score double"
    tree = fit(vectors)
    if tree is None:
        return rows.sparkSession.createDataFrame([], schema)
    n = calibrate(vectors, queries, tree, k, recall)
    width = tree.centres.shape[1]
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tree.plain())

    def index(batches):
        tree = Tree.of(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf(matrix(batch.column(1), width)))], ["id", "v", "leaf"])

    indexed = table(vectors.where(F.size("v") == width).mapInArrow(index, "id long, v array<double>, leaf long"), "leaves")
    # a few numbers for each leaf of the tree, whatever the rows
    counts = indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")).collect()
    sizes, distinct = {r.leaf: r.rows for r in counts}, {r.leaf: r.ids for r in counts}
    bins, room = {}, 0
    for leaf in (x for x in tree.leaves if x in sizes):
        parts = -(-sizes[leaf] // PART_ROWS)
        if parts > 1 or room < sizes[leaf]:
            room = PART_ROWS if parts == 1 else 0
            bins[leaf] = (leaf, parts)
            last = leaf
        else:
            bins[leaf] = (last, 1)
        room -= sizes[leaf] if parts == 1 else 0
    plan = spark.sparkContext.broadcast((bins, distinct))

    def visit(batches):
        (bins, distinct), tree = plan.value, Tree.of(shared.value)
        for batch in batches:
            found: list[tuple[int, int, list[int]]] = []
            for i, q in enumerate(matrix(batch.column(1), width)):
                own: dict[int, list[int]] = {}
                for leaf in tree.visits(q, n, distinct, k):
                    if leaf in bins:
                        own.setdefault(bins[leaf][0], []).append(leaf)
                found += [(i, b, leaves) for b, leaves in own.items()]
            at = pa.array([i for i, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([b for _, b, _ in found], pa.int64()),
                                              pa.array([x for _, _, x in found], pa.list_(pa.int64()))], ["query_id", "q", "bin", "leaves"])

    visits = table(queries.where(F.size("v") == width).mapInArrow(visit, "query_id long, q array<double>, bin long, leaves array<long>"), "visits")
    asked = dict(visits.groupBy("bin").count().collect())
    rows_of = spark.createDataFrame([(leaf, b, parts, -(-asked.get(b, 0) // BLOCK_QUERIES)) for leaf, (b, parts) in bins.items()],
                                    "leaf long, bin long, parts int, blocks int").where("blocks > 0")
    here = indexed.join(F.broadcast(rows_of), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    here = here.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bin", "part", "block", "leaf", "id", "v")
    there = visits.join(F.broadcast(rows_of.select("bin", "parts", "blocks").distinct()), "bin")
    there = there.withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int"))
    there = there.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bin", "part", "block", "query_id", "q", "leaves")

    def meet(near: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(near) and len(asked):
            near = near.sort_values(["leaf", "id"], kind="stable")
            ids, leaf, v = near.id.to_numpy(), near.leaf.to_numpy(), np.stack(near.v.to_numpy())
            again = np.concatenate([[False], (ids[1:] == ids[:-1]) & (leaf[1:] == leaf[:-1])])
            if again.any():  # repeated rows
                keep = ~pd.DataFrame(v).assign(id=ids).duplicated().to_numpy()
                ids, leaf, v = ids[keep], leaf[keep], v[keep]
            # one more than k for the query's own row, more if an id has several
            most = k + int(pd.Series(ids).value_counts().iloc[0])
            q, own = np.stack(asked.q.to_numpy()), asked.query_id.to_numpy()
            who: dict[int, list[int]] = {}
            for i, leaves in enumerate(asked.leaves):
                for x in leaves:
                    who.setdefault(int(x), []).append(i)
            scores: list[list[np.ndarray]] = [[] for _ in own]
            spots: list[list[np.ndarray]] = [[] for _ in own]
            for a, b in zip(*(np.searchsorted(leaf, np.unique(leaf), side) for side in ("left", "right"))):
                mine = who.get(int(leaf[a]), [])
                for some in (mine[i:i + 256] for i in range(0, len(mine), 256)):
                    for i, s in zip(some, q[some] @ v[a:b].T):
                        top = np.arange(b - a)
                        if b - a > most:
                            kth = np.partition(s, b - a - most)[b - a - most]
                            top = np.flatnonzero(s >= kth - 1e-9 * max(1.0, abs(kth)))
                        scores[i].append(s[top])
                        spots[i].append(top + a)
            for i in range(len(own)):
                if spots[i]:
                    at, s = np.concatenate(spots[i]), np.concatenate(scores[i])
                    other = ids[at] != own[i]
                    f, e = best(s[other], ids[at[other]], v[at[other]], q[i], k)
                    out.append((np.full(len(f), own[i]), f, e))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pd.DataFrame({"query_id": cols[0].astype(np.int64), "id": cols[1].astype(np.int64), "score": cols[2].astype(np.float64)})

    keys = ["bin", "part", "block"]
    found = here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(meet, "query_id long, id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
