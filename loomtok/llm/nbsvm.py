"""Quality classifier: Naive Bayes features under a linear support vector model.

A text's features are indicators of hashed n-grams: words, pairs of
neighbouring words, and the same for word forms (case of the first letter,
the last two characters, whether the word repeats the one before).  Each
indicator is scaled by its log-count ratio between the two classes, each
text by its length in that space, and a linear model is fitted to the hinge
loss by dual coordinate descent.  Scores are the sigmoid of the margin,
fitted to labelled rows that the model didn't see.

``fit`` reads at most ``max_rows`` labelled texts, those whose
``xxhash64(key)`` come first, and works on their hashed features alone.
``score`` adds ``score`` (0 to 1) to any frame with a text column, in one
narrow pass.  Null and empty texts have no features; they get the score of
the model's constant.  Labels other than 0 and 1 and null labels are left
out of the fit, which needs both classes (else an error); labelled rows
without a document, or whose documents have null texts, count for nothing
and as empty texts.  Of several texts or labels with one key, one text for each
label counts.  A column
named like the new one is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.flat import Words, byte_class, byte_rows, mix, row_slices, same_rows, with_columns

BITS = 20
#: Labelled texts that a fit reads at most.
MAX_ROWS = 4000
#: Parts of the labelled texts whose margins come from models of the others.
FOLDS = 4
#: Texts that must have a feature before it counts.
LEAST_TEXTS = 3

WORD_BYTES = ~byte_class((0x00, 0x20))
# a letter counts as a or A, a byte of other characters as a, a digit as 0
FORM = np.arange(256)
FORM[0x61:0x7B] = FORM[0x80:] = 0x61
FORM[0x41:0x5B] = 0x41
FORM[0x30:0x3A] = 0x30


class Features:
    """Distinct hashed features of each row of a slice."""

    def __init__(self):
        self.words = Words(WORD_BYTES)
        self.stamp = np.zeros(1 << BITS, np.int64)

    def of(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature of each, row of each), a feature once a row at most, rows in order."""
        starts, ends, first = self.words.split(data, offs)
        n = len(starts)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        word = self.words.hashes(data, starts, ends)
        pair = np.flatnonzero(row[1:] == row[:-1])
        same = np.zeros(n, np.uint64)
        same[pair + 1] = word[pair] == word[pair + 1]
        last = FORM[data[ends - 1]].astype(np.uint64)
        second = FORM[data[np.maximum(ends - 2, starts)]].astype(np.uint64)
        form = FORM[data[starts]].astype(np.uint64) | last << np.uint64(8) | second << np.uint64(16) | same << np.uint64(24)
        form = mix(form + np.uint64(0x51ED270B7A3F))
        two = [mix(h[:-1][pair] * np.uint64(3) + h[1:][pair]) for h in (word, form)]
        found = np.concatenate([word, form, *two]) >> np.uint64(64 - BITS)
        rows = np.concatenate([row, row, row[pair], row[pair]])
        order = np.argsort(rows, kind="stable")
        found, rows = found[order].astype(np.int64), rows[order]
        cut = np.searchsorted(rows, np.arange(len(offs)))
        keep = np.zeros(len(found), np.bool_)
        stamp = self.stamp
        for a, b in zip(cut[:-1], cut[1:]):
            here = found[a:b]
            stamp[here] = np.arange(b - a)
            keep[a:b] = stamp[here] == np.arange(b - a)
        return found[keep], rows[keep]


@dataclass
class Model:
    features: np.ndarray    # hashes, the others weigh nothing
    weights: np.ndarray     # by feature, the log-count ratio in it
    scale: np.ndarray       # by feature, the squared log-count ratio
    constant: float
    slope: float
    shift: float

    def plain(self) -> tuple:
        return self.features, self.weights, self.scale, self.constant, self.slope, self.shift


def margins(weights: np.ndarray, scale: np.ndarray, constant: float, found: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    size = np.sqrt(np.bincount(rows, scale[found], n))
    return np.bincount(rows, weights[found], n) / np.maximum(size, 1e-9) + constant


class Scorer:
    """A model ready for use in a task, from ``Model.plain()``."""

    def __init__(self, features, weights, scale, constant, slope, shift):
        self.weights, self.scale = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
        self.weights[features], self.scale[features] = weights, scale
        self.constant, self.slope, self.shift = constant, slope, shift

    def scores(self, found: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        m = margins(self.weights, self.scale, self.constant, found, rows, n)
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -40, 40)))


def descend(texts: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = 1.0,
            rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one multiplier for each
    text, moved to its best value between 0 and ``cost`` while the others
    stay.  The constant is the weight of a feature that each text has."""
    w, b = np.zeros(size), 0.0
    held = np.zeros(len(y))
    norm = np.array([float(v @ v) + 1.0 for v in values])  # 1.0 for the constant
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * (float(w[texts[i]] @ values[i]) + b) - 1.0
            new = min(max(held[i] - slope / norm[i], 0.0), cost)
            step = (new - held[i]) * y[i]
            if step:
                w[texts[i]] += step * values[i]
                b += step
                moved = max(moved, abs(step))
                held[i] = new
        if moved < 1e-3:
            break
    return w, b


def sigmoid_of(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method on the smoothed log loss."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, ab = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -40, 40)))
        grad = x.T @ (p - goal) + 1e-3 * (ab - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        ab = ab - step
        if abs(step).max() < 1e-7:
            break
    return float(ab[0]), float(ab[1])


def fit_features(texts: list[np.ndarray], y: np.ndarray, cost: float = 1.0) -> Model:
    """``texts``: distinct features of each; ``y``: 1 or -1."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.float32), 0.0, 1.0, 0.0)
    counts = np.bincount(np.concatenate(texts), minlength=1 << BITS)
    features = np.flatnonzero(counts >= LEAST_TEXTS).astype(np.int32)
    number = np.full(1 << BITS, -1, np.int32)
    number[features] = np.arange(len(features))
    texts = [x[x >= 0] for x in (number[t] for t in texts)]
    del counts, number
    size = len(features)

    def part(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        counts = {c: np.bincount(np.concatenate([texts[i] for i in own if y[i] == c] or [np.zeros(0, np.int32)]), minlength=size) for c in (1, -1)}
        p, q = counts[1] + 1.0, counts[-1] + 1.0
        ratio = np.log((p / p.sum()) / (q / q.sum()))
        ratio[counts[1] + counts[-1] < LEAST_TEXTS] = 0
        values = [(ratio[texts[i]] / max(np.sqrt((ratio[texts[i]] ** 2).sum()), 1e-9)).astype(np.float32) for i in own]
        w, b = descend([texts[i] for i in own], values, y[own], size, cost)
        return (w * ratio).astype(np.float32), (ratio ** 2).astype(np.float32), b

    # margins of texts by models that didn't see them, each class dealt out evenly
    fold = np.zeros(len(y), np.int64)
    for c in (1, -1):
        fold[y == c] = np.arange((y == c).sum()) % FOLDS
    unseen = np.zeros(len(y))
    for f in range(FOLDS):
        own = np.flatnonzero(fold == f)
        if len(own):
            rows = np.repeat(np.arange(len(own)), [len(texts[i]) for i in own])
            unseen[own] = margins(*part(np.flatnonzero(fold != f)), np.concatenate([texts[i] for i in own]), rows, len(own))
    return Model(features, *part(np.arange(len(y))), *sigmoid_of(unseen, y))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text_col: str = "text",
        may_learn: Column | None = None, max_rows: int = MAX_ROWS) -> Model:
    """``may_learn``: a condition on the labels' rows."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_key"), "_key", "_label").limit(max_rows)
    chosen = docs.select(F.col(key).alias("_key"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_key")

    def run(batches):
        features = Features()
        for batch in batches:
            data, offs = byte_rows(batch.column(1))
            for lo, hi in row_slices(offs):
                found, rows = features.of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                ends = np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), lists], ["key", "label", "found"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("label", T.IntegerType()), T.StructField("found", T.ArrayType(T.IntegerType()))])
    # of several texts with one key one, so there are no more than labels
    each = chosen.mapInArrow(run, schema).groupBy("key", "label").agg(F.min("found").alias("found"))
    rows = each.orderBy(F.xxhash64("key"), "key", "label").toArrow()
    lists = rows.column("found").combine_chunks() if len(rows) else pa.array([], pa.list_(pa.int32()))
    found = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1]) if len(rows) else []
    y = np.where(rows.column("label").to_numpy() == 1, 1, -1)
    del rows, lists
    return fit_features(found, y)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    docs = docs.drop(out_col)
    shared, at = docs.sparkSession.sparkContext.broadcast(model.plain()), docs.columns.index(text_col)

    def run(batches):
        features, scorer = Features(), Scorer(*shared.value)
        for batch in batches:
            data, offs = byte_rows(batch.column(at))
            for lo, hi in row_slices(offs):
                found, rows = features.of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                scores = pa.array(scorer.scores(found, rows, hi - lo), pa.float64())
                yield with_columns(batch.slice(lo, hi - lo), **{out_col: scores})

    return docs.mapInArrow(run, same_rows(docs.schema, T.StructField(out_col, T.DoubleType())))
