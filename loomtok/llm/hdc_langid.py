"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1.  A trigram's vector binds
those of its three letters, the first permuted twice and the second once, by
multiplying them place by place; everything that isn't a letter counts as
one boundary letter.  A text bundles (adds) its trigrams' vectors, a language
bundles its texts' normalised vectors, and a text belongs to the language
whose prototype has the largest cosine with it.

``fit`` runs over all rows whose language isn't null and sums vectors in
each task before they are shuffled; only one prototype a language reaches
the driver (``MAX_LANGUAGES`` at most, else an error).  ``predict`` is one
narrow pass.  A null text, an empty one and one without letters add nothing
to a prototype and get ``und`` with score 0; so does every text if nothing
was learned.  Of equal cosines the language that sorts first wins.  Repeated
rows count as often as they come.  Columns named like the new ones are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.flat import byte_rows, mix, row_slices, same_rows, with_columns

SIZE = 1024
MAX_LANGUAGES = 4096
UNKNOWN = "und"
#: Cells of one table of counts, rows by trigrams.
CELLS = 1 << 21


class Vectors:
    """Bundled trigram vectors of texts."""

    def __init__(self, size: int = SIZE):
        self.size, self.letters = size, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            h = mix(np.arange(self.size, dtype=np.uint64) + np.uint64((code + 1) << 32))
            self.letters[code] = (1 - 2 * (h >> np.uint64(63)).astype(np.int8)).astype(np.int8)
        return self.letters[code]

    def of(self, texts: list[str]) -> np.ndarray:
        """One row for each text, all zeros where it has no letter."""
        texts = [t.lower() + "\n" for t in texts]
        ends = np.cumsum([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        known = [c for c in np.flatnonzero(np.bincount(codes)).tolist() if chr(c).isalpha()]
        spot = np.zeros(int(codes.max()) + 1, np.int64)
        spot[known] = np.arange(1, len(known) + 1)
        seq = spot[codes]
        # of a run of other characters only the first stays, as the boundary
        keep = np.flatnonzero((seq > 0) | np.concatenate([[False], seq[:-1] > 0]))
        row = np.searchsorted(ends, keep, "right")
        seq = np.concatenate([[0], seq[keep]])
        at = np.flatnonzero(seq > 0)
        n = len(known) + 1
        out = np.zeros((len(texts), self.size), np.float32)
        if not len(at):
            return out
        row = row[at - 1]
        grams = (seq[at - 1] * n + seq[at]) * n + seq[at + 1]
        if n ** 3 <= 1 << 22:
            present = np.flatnonzero(np.bincount(grams, minlength=1))
            place = np.zeros(present[-1] + 1, np.int64)
            place[present] = np.arange(len(present))
            gram = place[grams]
        else:
            present, gram = np.unique(grams, return_inverse=True)
        base = np.stack([self.letter(c) for c in [0, *known]])
        once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
        width = min(len(present), 4096)
        rows = max(1, CELLS // width)
        for g in range(0, len(present), width):
            p = present[g:g + width]
            bound = (twice[p // (n * n)] * once[p // n % n] * base[p % n]).astype(np.float32)
            here = (gram >= g) & (gram < g + width) if width < len(present) else slice(None)
            r_, g_ = row[here], gram[here] - g
            for r in range(0, len(texts), rows):
                a, b = np.searchsorted(r_, [r, r + rows])
                if a == b:
                    continue
                m = min(rows, len(texts) - r)
                counts = np.bincount((r_[a:b] - r) * len(p) + g_[a:b], minlength=m * len(p))
                out[r:r + m] += counts.reshape(m, len(p)).astype(np.float32) @ bound
        return out


def _normal(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _slices(batch: pa.RecordBatch, at: int):
    column = batch.column(at)
    _, offs = byte_rows(column)
    for lo, hi in row_slices(offs):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def fit(docs: DataFrame, may_learn: Column | None = None, text_col: str = "text", lang_col: str = "lang",
        size: int = SIZE) -> dict[str, np.ndarray]:
    """language -> prototype, from the rows that ``may_learn`` allows."""
    known = docs.where(F.col(lang_col).isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)

    def run(batches):
        vectors, sums = Vectors(size), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, hi, texts in _slices(batch, 0):
                rows = _normal(vectors.of(texts))
                for lang in set(langs[lo:hi]):
                    own = [i - lo for i in range(lo, hi) if langs[i] == lang]
                    sums[lang] = sums.get(lang, 0) + rows[own].sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = known.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(run, "lang string, v array<double>")
    each = parts.select("lang", F.posexplode("v").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    whole = each.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("v"))
    rows = whole.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: np.array(r.v) for r in sorted(rows, key=lambda r: r.lang) if any(r.v)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    docs = docs.drop(lang_out, score_out)
    shared, at = docs.sparkSession.sparkContext.broadcast(prototypes), docs.columns.index(text_col)

    def run(batches):
        names = [*shared.value]
        size = len(shared.value[names[0]]) if names else SIZE
        vectors = Vectors(size)
        goals = _normal(np.stack([shared.value[n] for n in names])).T.astype(np.float32) if names else np.zeros((size, 1), np.float32)
        for batch in batches:
            for lo, hi, texts in _slices(batch, at):
                rows = vectors.of(texts)
                cos = _normal(rows) @ goals
                best = cos.argmax(axis=1)
                some = rows.any(axis=1) & bool(names)
                lang = [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
                score = np.where(some, np.clip(cos[np.arange(len(best)), best], 0, 1), 0).astype(np.float64)
                yield with_columns(batch.slice(lo, hi - lo), **{lang_out: pa.array(lang, pa.string()), score_out: pa.array(score)})

    return docs.mapInArrow(run, same_rows(docs.schema, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())))
