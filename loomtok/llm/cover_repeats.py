"""Suffix-array dedup: byte strings that occur twice, by difference covers.

Only one thing is asked of the suffix array of all texts: which suffixes
share their first ``length`` bytes with another one.  It is built block by
block, and only as far as that needs:

1.  Cover sample.  Places whose remainder by the period v lies in a
    difference cover D are sampled; for any two places some shift below v
    takes both into the sample.  Of sample suffixes it is found whether they
    tie with another one at depth K = length - v + 1: fingerprints are dealt
    out to buckets and sorted one bucket at a time.  No rank is kept, the
    cover is only a filter.  Two suffixes that tie over ``length``
    bytes hold, at one shift, two sample suffixes that tie at depth K, so
    every suffix without a tied sample in reach is settled here.
2.  Blocks.  The rest, runs of suffixes around tied samples, goes to blocks
    by anchor (the smallest hash of 32 bytes in the window, the same for
    equal windows), each run with the bytes it needs and no more.  A block
    sorts its suffixes by the fingerprint of their first ``length`` bytes;
    neighbours that tie are the repeats.

Blocks aren't in the order of the alphabet: that order isn't needed for
ties, and by anchor a suffix and its neighbours share their bytes.  Memory
is bounded by one bucket, by one slice of rows or by ``repeats.CROWD``
contexts of an anchor; the windows of more crowded anchors are grouped one
by one, with partial aggregation.

``remove`` adds n_bytes, spans (maximal runs of removed bytes, start and
end) and kept (the remaining bytes).  Every byte in a string of ``length``
bytes that starts anywhere else as well goes, judged on the input; matches
never cross texts.  Null texts count as empty; short texts lose nothing;
repeated rows are copies of each other and lose everything if they are long
enough.  Columns with the new names are replaced; empty tables give empty
tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm import repeats
from loomtok.llm.flat import byte_rows, row_slices, same_rows, with_columns

LENGTH = 400
ANCHOR = 32


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """Colbourn and Ling's cover with parameter ``r``: (v, D), 6r + 4 numbers
    whose differences take every value modulo v = 24 r**2 + 36 r + 13."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)])


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The sparsest of these covers that leaves K >= length / 8."""
    r = 0
    while length - difference_cover(r + 1)[0] + 1 >= max(1, length // 8):
        r += 1
    v, d = difference_cover(r)
    return (v, d) if v < length else (1, np.zeros(1, np.int64))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)]), False)


def _tied_samples(texts: DataFrame, length: int) -> DataFrame:
    v, d = cover_for(length)
    depth = length - v + 1
    sequence = repeats.Sequence()

    def sample(data, offs):
        sums = sequence.sums(repeats.BYTE_VALUES[data])
        rows, places = [], []
        for r, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
            if b - a >= length:
                at = (np.arange(0, b - a, v)[:, None] + d).ravel()
                at = at[at <= b - a - depth]
                places.append(at)
                rows.append(np.full(len(at), r))
        if not rows:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, place = np.concatenate(rows), np.concatenate(places)
        return sequence.at(sums, offs[row] + place, depth), row, place

    return repeats.ties(texts, sample, len(d) / v)


def _contexts(tied: DataFrame, length: int) -> DataFrame:
    """``tied``: _k1, _k2, places, _text."""
    v, _ = cover_for(length)
    k = min(ANCHOR, length)

    def run(batches):
        new, out, sequence = repeats.New(), repeats.Contexts(), repeats.Sequence()
        for batch in batches:
            k1, k2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offs = byte_rows(batch.column(3))
            fresh = new(k1, k2)
            places = batch.column(2)
            for i in np.flatnonzero(fresh):
                text = data[offs[i]:offs[i + 1]]
                tied = np.asarray(places[i].values)
                edge = np.zeros(len(text) + 2, np.int32)
                np.add.at(edge, np.maximum(tied - (v - 1), 0), 1)
                np.add.at(edge, np.minimum(tied, len(text) - length) + 1, -1)
                may = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[False], may, [False]])))
                grams = sequence.at(sequence.sums(repeats.BYTE_VALUES[text]), np.arange(len(text) - k + 1), k)
                raw = text.tobytes()
                for lo, hi in zip(turn[::2].tolist(), turn[1::2].tolist()):
                    at, firsts, sizes = repeats.anchors(grams, lo, hi, length, k)
                    out.add(int(k1[i]), int(k2[i]), grams[at], at, firsts, sizes, lambda a, n: raw[a:a + n - 1 + length])
                yield from out.batches(1 << 22)
        yield from out.batches()

    return tied.select("_k1", "_k2", "places", "_text").mapInArrow(run, repeats.CONTEXT)


def remove(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    docs = docs.drop("n_bytes", "spans", "kept")
    names = docs.columns
    texts = repeats.texts_of(docs, text_col)
    tied = repeats.table(_tied_samples(texts, length), "tied")
    contexts = _contexts(repeats.attach(texts, tied, "places", "inner", repeats.MAX_PLACES), length)
    sequence = repeats.Sequence()

    def prints(payloads, n):
        data, offs = byte_rows(payloads)
        data, offs = data[offs[0]:offs[-1]], offs - offs[0]
        out, ends = np.zeros(n.sum(), np.uint64), np.concatenate([[0], np.cumsum(n)])
        for lo, hi in row_slices(offs):
            owner = np.repeat(np.arange(lo, hi), n[lo:hi])
            starts = np.arange(len(owner)) - (ends[owner] - ends[lo]) + offs[owner] - offs[lo]
            out[ends[lo]:ends[hi]] = sequence.at(sequence.sums(repeats.BYTE_VALUES[data[offs[lo]:offs[hi]]]), starts, length)
        return out

    hits = repeats.hits(repeats.repeated(contexts, prints), docs, text_col)
    both = repeats.attach(repeats.keyed(docs, text_col), hits, "hits", "left").select("row", "hits")
    at, kept = names.index(text_col), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches):
        for batch in batches:
            whole, found = pa.RecordBatch.from_arrays(batch.column(0).flatten(), names=names), batch.column(1)
            data, offs = byte_rows(whole.column(at))
            for lo, hi in row_slices(offs):
                spans, rest = [], []
                for i in range(lo, hi):
                    text = data[offs[i]:offs[i + 1]]
                    gone = repeats.covered(found[i].as_py() or (), len(text), length)
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])])
                    rest.append(text[~gone].tobytes() if edge else text.tobytes())
                rows = whole.slice(lo, hi - lo)
                yield with_columns(rows, n_bytes=pa.array(np.diff(offs[lo:hi + 1]), pa.int64()), spans=pa.array(spans, kept), kept=pa.array(rest, pa.binary()))

    return both.mapInArrow(cut, same_rows(docs.schema, T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())))


def n_removed(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
