"""Exact byte-level BPE training as an iterative DataFrame job.

State: one row per distinct piece, ``(cnt, ids array<int>)``, and one row per
adjacent pair, ``(left_id, right_id, freq)``.  All pairs are counted once, at
the start.  A round holds up to ``BATCH`` merges, about twice as many as the
round before had accepted:

1. *Rank.*  The ``TOP`` first pairs by (freq desc, left_id, right_id) come to
   the driver.  Any other pair ranks behind them, and no count of a pair of
   known ids can rise.  So their counts, kept up with what each round
   changes, tell the order until the last of them is reached; only then the
   pair table takes up the changes and is ranked anew.
2. *Guess.*  The driver guesses the order in which the next merges will come,
   from the exact counts and from the ``HINT_PIECES`` most frequent pieces,
   which tell about how much a merge takes from its neighbours and what new
   pairs it makes.
3. *Try.*  Every task applies the guessed merges, in that order, to its pieces
   that hold one of their pairs, and adds up what each merge changes:
   ``(step, left_id, right_id, change)``.
4. *Check.*  From the exact counts and changes the driver walks the greedy
   order itself.  A merge is accepted when its pair is the first of all, it
   was tried, and what was tried before it without being accepted doesn't
   touch it (``Tried.meets``): then its changes are those of the true order.
   At the first pair that fails, the batch is cut.  The first guess is the
   first pair of the exact ranking, so at least one merge is accepted.
5. *Apply.*  The accepted merges change the pieces; the rest of the guess is
   forgotten.

So the merges equal the one-at-a-time greedy order whatever the guess was
worth; ``tests/test_train.py`` checks that against a sequential trainer, with
guesses from a few pieces too.  A merge whose string is already in the
vocabulary uses that id again and has a round of its own.

What a round costs follows the pieces that it changes: the others are looked
at once in each step.  Pieces lie in blocks of flat arrays, on which a merge
is a few array operations.  A round's changes are summed in the blocks first;
what reaches the driver are those of the ranked pairs and of pairs with a
tried id.
"""

from __future__ import annotations

import heapq
import time
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.functions.bytelevel import DEFAULT_SPECIAL_TOKENS
from loomtok.functions.text import lines_keep_newline
from loomtok.operators.model import BpeModel
from loomtok.operators.pieces import pair_counts, piece_counts, words_from_pieces
from loomtok.session import ensure_checkpoint_dir

#: Merges of a round at most, and at least if there are so many; ranked pairs that reach the driver; pieces that the guess is made from.
BATCH, LEAST_BATCH, TOP, HINT_PIECES = 512, 32, 4096, 20_000
#: Pieces of one row of the packed state.
BLOCK_PIECES = 100_000
PACKED = "cnt binary, ids binary, owner binary"

Merge = tuple[int, int, int, int]  # left, right, new, freq


@dataclass
class TrainStats:
    rounds: int = 0
    seconds: float = 0.0
    distinct_pieces: int = 0
    guessed: int = 0
    accepted: list[int] = field(default_factory=list)


def corpus_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The trainer reads its corpus line by line with the newline kept, so a
    run of newlines is never one piece."""
    return df.select(F.explode(lines_keep_newline(text_col)).alias("line"))


# --------------------------------------------------------------------------
# what tasks do
# --------------------------------------------------------------------------
def merged(word: list[int], left: int, right: int, new: int) -> list[int]:
    """All occurrences from the left."""
    out, i, n = [], 0, len(word)
    while i < n:
        if i + 1 < n and word[i] == left and word[i + 1] == right:
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


class Block:
    """Many pieces as flat arrays: the count of each, all ids, and the piece
    of each id (equal next to each other, in any order)."""

    def __init__(self, cnt: np.ndarray, ids: np.ndarray, owner: np.ndarray):
        self.cnt, self.ids, self.owner = cnt, ids, owner

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(np.frombuffer(row["cnt"], np.int64), np.frombuffer(row["ids"], np.int32), np.frombuffer(row["owner"], np.int32))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (self.cnt, self.ids, self.owner)], names=["cnt", "ids", "owner"])

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that begin at some places, as one number each, and their counts."""
        at = at[(at >= 0) & (at < len(self.ids) - 1)]
        at = at[self.owner[at] == self.owner[at + 1]]
        return self.ids[at].astype(np.int64) << 32 | self.ids[at + 1], self.cnt[self.owner[at]]

    def holding(self, wanted: np.ndarray) -> np.ndarray:
        """Which ids belong to pieces that hold one of the pairs (sorted numbers)."""
        keys = self.ids[:-1].astype(np.int64) << 32 | self.ids[1:]
        spot = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        hit = (wanted[spot] == keys) & (self.owner[:-1] == self.owner[1:])
        held = np.zeros(len(self.cnt), np.bool_)
        held[self.owner[:-1][hit]] = True
        return held[self.owner]

    def merge(self, left: int, right: int, new: int) -> np.ndarray:
        """All occurrences, from the left; returns where they began."""
        ids, owner = self.ids, self.owner
        at = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right) & (owner[:-1] == owner[1:]))
        if left == right and len(at) > 1:  # of a run every second one
            begin = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
            at = at[(at - at[begin]) % 2 == 0]
        if len(at):
            ids = ids.copy()
            ids[at] = new
            self.ids, self.owner = np.delete(ids, at + 1), np.delete(owner, at + 1)
        return at


def _numbers(pairs) -> np.ndarray:
    return np.sort(np.array([left << 32 | right for left, right in pairs], np.int64))


def packed(words: DataFrame) -> DataFrame:
    """(cnt, ids) of pieces as rows of ``BLOCK`` pieces each, so that a round
    moves a few byte arrays between Spark and Python."""
    def run(batches):
        held, size = [], 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            ids = rows.column("ids").combine_chunks()
            lengths = ids.value_lengths().to_numpy()
            return Block(rows.column("cnt").to_numpy(), ids.flatten().to_numpy().astype(np.int32), np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)).batch()

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_PIECES:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    return words.select("cnt", "ids").mapInArrow(run, PACKED)


def unpacked(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block.of(row)
                begin = np.flatnonzero(np.diff(b.owner, prepend=-1) != 0)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(b.ids)), pa.int32()), pa.array(b.ids))
                yield pa.RecordBatch.from_arrays([pa.array(b.cnt[b.owner[begin]]), lists], names=["cnt", "ids"])

    return blocks.mapInArrow(run, "cnt long, ids array<int>")


def apply_merges(blocks: DataFrame, batch: list[Merge]) -> DataFrame:
    """The pieces after the batch; those of one symbol can take part in no
    further pair and go."""
    if not batch:
        return blocks
    wanted = _numbers((left, right) for left, right, _, _ in batch)

    def run(batches):
        for rows in batches:
            for row in rows.to_pylist():
                b = Block.of(row)
                held = b.holding(wanted)
                some = Block(b.cnt, b.ids[held], b.owner[held])
                for left, right, new, _ in batch:
                    some.merge(left, right, new)
                ids, owner = np.concatenate([b.ids[~held], some.ids]), np.concatenate([b.owner[~held], some.owner])
                stay = np.bincount(owner, minlength=len(b.cnt)) >= 2
                yield Block(b.cnt[stay], ids[stay[owner]], (np.cumsum(stay) - 1).astype(np.int32)[owner[stay[owner]]]).batch()

    return blocks.mapInArrow(run, PACKED)


def tried(blocks: DataFrame, batch: list[tuple[int, int, int]], ranked: list[tuple[int, int, int]], known: int) -> DataFrame:
    """(step, left_id, right_id, change, told) that the merges (left, right,
    new) make one after the other, counted in each block first; ``told``: of a
    ranked pair or one with an id from ``known`` on."""
    wanted, listed = _numbers((left, right) for left, right, _ in batch), _numbers((left, right) for left, right, _ in ranked)

    def run(batches):
        for rows in batches:
            for row in rows.to_pylist():
                b = Block.of(row)
                held = b.holding(wanted)
                b = Block(b.cnt, b.ids[held], b.owner[held])
                steps, keys, changes = [], [], []
                for step, (left, right, new) in enumerate(batch):
                    before = Block(b.cnt, b.ids, b.owner)
                    at = b.merge(left, right, new)
                    if not len(at):
                        continue
                    lost, n = before.pairs(np.unique(np.concatenate([at - 1, at, at + 1])))
                    now = at - np.arange(len(at))
                    won, m = b.pairs(np.unique(np.concatenate([now - 1, now])))
                    pair, of = np.unique(np.concatenate([lost, won]), return_inverse=True)
                    change = np.zeros(len(pair), np.int64)
                    np.add.at(change, of, np.concatenate([-n, m]))
                    pair, change = pair[change != 0], change[change != 0]
                    steps.append(np.full(len(pair), step, np.int32))
                    keys.append(pair)
                    changes.append(change)
                if steps:
                    pair = np.concatenate(keys)
                    left, right = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
                    spot = np.minimum(np.searchsorted(listed, pair), len(listed) - 1)
                    told = (left >= known) | (right >= known) | (listed[spot] == pair)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(steps), left, right, np.concatenate(changes), told)],
                                                     names=["step", "left_id", "right_id", "change", "told"])

    rows = blocks.mapInArrow(run, "step int, left_id int, right_id int, change long, told boolean")
    return rows.groupBy("step", "left_id", "right_id", "told").agg(F.sum("change").cast("long").alias("change"))


def update_pairs(pairs: DataFrame, rounds: list[tuple[DataFrame, list[int], int, list[int]]]) -> DataFrame:
    """The pair table after some rounds: (changes, ids, known, accepted
    steps); the tried ids from ``known`` on are called ``ids`` now."""
    for changes, ids, known, accepted in rounds:
        now = F.array(*map(F.lit, ids)) if ids else F.array().cast("array<int>")
        named = lambda c: F.when(F.col(c) < known, F.col(c)).otherwise(F.get(now, F.col(c) - known)).cast("int").alias(c)
        own = changes.where(F.col("step").isin(accepted)).select(named("left_id"), named("right_id"), F.col("change").alias("freq"))
        pairs = pairs.unionByName(own)
    return pairs.groupBy("left_id", "right_id").agg(F.sum("freq").cast("bigint").alias("freq")).where(F.col("freq") > 0)


# --------------------------------------------------------------------------
# what the driver does
# --------------------------------------------------------------------------
class Guess:
    """The order in which merges will probably come, from some pieces:
    ``held`` counts their pairs, ``where`` tells which pieces may hold one."""

    def __init__(self, pieces: list[tuple[list[int], int]]):
        self.words, self.counts = [w for w, _ in pieces], [c for _, c in pieces]
        self.held: dict[tuple[int, int], int] = defaultdict(int)
        self.where: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, w in enumerate(self.words):
            self._count(w, self.counts[i])
            for p in zip(w, w[1:]):
                self.where[p].add(i)

    def _count(self, word: list[int], n: int) -> None:
        for p in zip(word, word[1:]):
            self.held[p] += n

    def _merge(self, left: int, right: int, new: int, before: dict[int, list[int]] | None = None) -> set[tuple[int, int]]:
        """In all pieces; returns the new pairs.  ``before`` gets the pieces as they were."""
        fresh = set()
        for i in list(self.where.get((left, right), ())):
            old = self.words[i]
            word = merged(old, left, right, new)
            if len(word) < len(old):
                if before is not None:
                    before.setdefault(i, old)
                self.words[i] = word
                self._count(old, -self.counts[i])
                self._count(word, self.counts[i])
                for p in zip(word, word[1:]):
                    if new in p:
                        self.where[p].add(i)
                        fresh.add(p)
        return fresh

    def apply(self, batch: list[Merge]) -> None:
        for left, right, new, _ in batch:
            self._merge(left, right, new)

    def batch(self, ranked: list[tuple[int, int, int]], model: BpeModel, most: int, least: int) -> list[tuple[int, int, int]]:
        """(left, right, new) with ids to come from ``model.vocab_size`` on;
        pairs of fewer than ``least`` are left out."""
        held, before = self.held, {}
        # pieces stand for the rest: what a count in them is worth
        worth = {(left, right): n / held[left, right] for left, right, n in ranked if held.get((left, right))}
        queue = [(-n, left, right) for left, right, n in ranked]  # sorted, so a heap
        exact = {(left, right): n for left, right, n in ranked}
        known, tokens = model.vocab_size, model.tokens
        made: list[str] = []
        out: list[tuple[int, int, int]] = []
        text_of = lambda i: tokens[i] if i < known else made[i - known]
        value = lambda p: held[p] * worth[p] if p in worth else exact.get(p, 0)
        added: set[tuple[int, int]] = set()
        while queue and len(out) < most:
            n, left, right = heapq.heappop(queue)
            now = value((left, right))
            if now < -n * (1 - 1e-9):
                if now >= least:
                    heapq.heappush(queue, (-now, left, right))
                continue
            text = text_of(left) + text_of(right)
            if model.token_id(text) is not None or text in made:
                if not out:  # an id that is used again: alone
                    out.append((left, right, model.token_id(text)))
                break
            new = known + len(out)
            made.append(text)
            out.append((left, right, new))
            rate = now / held[left, right] if held.get((left, right)) else 1.0
            fresh = self._merge(left, right, new, before)
            added |= fresh
            for p in fresh:
                worth[p] = rate
                if value(p) >= least:
                    heapq.heappush(queue, (-value(p), *p))
            exact[left, right] = 0
            worth.pop((left, right), None)
        # the pieces are as they were again
        for i, old in before.items():
            self._count(self.words[i], -self.counts[i])
            self._count(old, self.counts[i])
            self.words[i] = old
        for p in added:
            held.pop(p, None)
            self.where.pop(p, None)
        return out


class Tried:
    """A batch with the exact changes that its merges make."""

    def __init__(self, batch: list[tuple[int, int, int]], known: int, ranked: list[tuple[int, int, int]], last: tuple[int, float, float], changes: DataFrame):
        """``last``: the place (-freq, left, right) in the ranking up to which all pairs are in ``ranked``."""
        self.batch, self.known, self.last = batch, known, last
        self.count = {(left, right): n for left, right, n in ranked}
        self.changes: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        self.beside: set[tuple[int, int]] = set()
        # a new pair gains in one step only, that of its later id
        for r in changes.where("told").select("step", "left_id", "right_id", "change").toArrow().to_pylist():
            step, left, right, n = r.values()
            self.changes[step].append((left, right, n))
            self.beside.update((step, i - known) for i in (left, right) if i >= known and i != step + known)

    def meets(self, early: int, late: int) -> bool:
        """Whether ``late`` would change otherwise without ``early`` before
        it: they share a symbol, or stand side by side somewhere."""
        (a, b, _), (c, d, _) = self.batch[early], self.batch[late]
        return b == c or d == a or (late, early) in self.beside

    def accept(self, model: BpeModel, vocab_size: int) -> tuple[list[Merge], list[int], list[int]]:
        """The merges in greedy order, their steps, and by step the true id (-1: not accepted)."""
        known, ids = self.known, [-1] * len(self.batch)
        true = lambda i: i if i < known else ids[i - known]
        step_of = {(left, right): i for i, (left, right, _) in enumerate(self.batch)}
        tried_id = {}
        queue = [(-n, *p) for p, n in self.count.items()]
        heapq.heapify(queue)
        merges, steps, open_ = [], [], set(range(len(self.batch)))
        while queue and model.vocab_size < vocab_size:
            n, left, right = queue[0]
            now = self.count[left, right]
            if -n != now:
                heapq.heappop(queue)
                if now > 0:
                    heapq.heappush(queue, (-now, left, right))
                continue
            if queue[0] > self.last:
                break  # an unknown pair may come first
            step = step_of.get((tried_id.get(left, left), tried_id.get(right, right)))
            if step is None or any(i < step and self.meets(i, step) for i in open_):
                break
            new, _ = model.add_token(model.tokens[left] + model.tokens[right])
            if self.batch[step][2] >= known:
                ids[step] = new
                tried_id[new] = known + step
            merges.append((left, right, new, now))
            steps.append(step)
            open_.discard(step)
            for a, b, x in self.changes[step]:
                pair = true(a), true(b)
                before = self.count.get(pair, 0)
                self.count[pair] = before + x
                if x > 0:
                    heapq.heappush(queue, (-self.count[pair], *pair))
            if self.batch[step][2] < known:
                break  # counts of pairs with an id used again aren't all known
        return merges, steps, ids


def train_bpe(lines: DataFrame, vocab_size: int, min_frequency: int = 2,
              special_tokens: list[str] | None = None, line_col: str = "line",
              batch: int | None = None, top: int | None = None, hint_pieces: int | None = None, checkpoint_every: int = 8,
              normalize: bool = True, stats: TrainStats | None = None) -> BpeModel:
    """Learn merges until the vocabulary holds ``vocab_size`` entries or no
    pair reaches ``min_frequency``.  Ids: special tokens, the 256 byte
    symbols by code point, then merges in creation order.

    The blocks of pieces are persisted each round and every ``checkpoint_every`` rounds
    written as reliable checkpoints in the shared checkpoint dir, the pair
    table whenever it takes up the changes.  That bounds lineage, survives
    executor loss and keeps the chain of dependent caches short: Spark re-plans
    the caches built on a parent when the parent is dropped, which grows
    without bound (and exhausts the driver heap) if never cut."""
    t0 = time.perf_counter()
    batch, top, hint_pieces = batch or BATCH, top or TOP, HINT_PIECES if hint_pieces is None else hint_pieces
    specials = list(DEFAULT_SPECIAL_TOKENS if special_tokens is None else special_tokens)
    model = BpeModel(specials, vocab_size_requested=vocab_size, min_frequency=min_frequency)
    stats = stats if stats is not None else TrainStats()

    spark = lines.sparkSession
    ensure_checkpoint_dir(spark)
    pc = piece_counts(lines, line_col, normalize=normalize)
    # a number of partitions of their own: small rows, much work for each
    words = words_from_pieces(pc, model.n_special).repartition(max(spark.sparkContext.defaultParallelism, lines.rdd.getNumPartitions()))
    words = words.persist(StorageLevel.MEMORY_AND_DISK)
    stats.distinct_pieces = words.count()
    pairs = pair_counts(words).checkpoint(eager=True)
    some = words.orderBy(F.desc("cnt"), "ids").limit(hint_pieces).collect() if hint_pieces else []
    blocks = packed(words).checkpoint(eager=True)
    words.unpersist()
    guess, size = Guess([(r.ids, r.cnt) for r in some]), 2 * LEAST_BATCH
    # counts: exact ones of the pairs that come before ``last``; waiting: rounds that the pair table hasn't taken up;
    # spent: blocks that later ones are made of until the next checkpoint
    counts: dict[tuple[int, int], int] = {}
    last, waiting, spent, rounds = (0.0, 0.0, 0.0), [], [], 0
    while model.vocab_size < vocab_size:
        if not counts or min((-n, *p) for p, n in counts.items()) > last:
            if waiting:
                was, pairs = pairs, update_pairs(pairs, waiting).checkpoint(eager=True)
                for df in (was, *(w[0] for w in waiting)):
                    df.unpersist()
                waiting = []
            first = pairs.where(F.col("freq") >= min_frequency).orderBy(F.desc("freq"), "left_id", "right_id").limit(top + 1).collect()
            if not first:
                break
            counts = {(r.left_id, r.right_id): r.freq for r in first[:top]}
            # all pairs of the wanted frequency, or the ranking's first ones
            last = (-min_frequency, float("inf"), float("inf")) if len(first) <= top else (-first[top - 1].freq, *first[top - 1][:2])
        ranked = sorted(((left, right, n) for (left, right), n in counts.items()), key=lambda r: (-r[2], r[0], r[1]))
        known = model.vocab_size
        guessed = guess.batch(ranked, model, min(size, batch, vocab_size - known), -last[0])
        changes = tried(blocks, guessed, ranked, known).persist(StorageLevel.MEMORY_AND_DISK)
        checked = Tried(guessed, known, ranked, last, changes)
        merges, steps, ids = checked.accept(model, vocab_size)
        model.merges.extend(merges)
        waiting.append((changes, ids, known, steps))
        stats.guessed += len(guessed)
        stats.accepted.append(len(merges))
        size = max(LEAST_BATCH, 2 * len(merges))
        rounds += 1
        if model.vocab_size >= vocab_size:
            break
        # pairs with an id that was used again aren't all known; of the others those count that may still come before ``last``
        counts = {} if guessed[0][2] < known else {p: n for p, n in checked.count.items() if n >= -last[0]}
        guess.apply(merges)
        spent.append(blocks)
        blocks = apply_merges(blocks, merges)
        if rounds % checkpoint_every == 0:
            blocks = blocks.checkpoint(eager=True)
            for df in spent:
                df.unpersist()
            spent = []
        else:
            blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for df in (*spent, *(w[0] for w in waiting), blocks, pairs):
        df.unpersist()
    stats.rounds = rounds
    stats.seconds = time.perf_counter() - t0
    return model


def train_on_texts(df: DataFrame, vocab_size: int, text_col: str = "text", **kw) -> BpeModel:
    return train_bpe(corpus_lines(df, text_col), vocab_size, **kw)
