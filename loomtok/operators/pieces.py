"""Pieces (pre-tokenized words) and their counts; adjacent-pair counts.

Counting is the only pass over the corpus: each task cuts its texts with the
encoder's pattern and counts the pieces before ``groupBy(piece)``, so what is
shuffled is about one row per distinct piece per task, however skewed the
piece frequencies are.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.functions.bytelevel import piece_finder, symbol_ids, to_symbols

#: Distinct pieces that a task counts before it hands them on; rows of an output batch.
HELD_PIECES, OUT_PIECES = 300_000, 50_000


def piece_counts(df: DataFrame, text_col: str, normalize: bool = True) -> DataFrame:
    """(piece, cnt) over all texts: training-time counting (special tokens in
    training text are ordinary text).  A task counts up to ``HELD_PIECES``
    pieces before it hands them on."""
    def run(batches):
        find = piece_finder()
        counts: Counter = Counter()

        def rows():
            for some in batched(counts.items(), OUT_PIECES):
                pieces, n = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(n, pa.int64())], names=["piece", "cnt"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(find(text if text.isascii() or not normalize else unicodedata.normalize("NFKC", text)))
                if len(counts) >= HELD_PIECES:
                    yield from rows()
        yield from rows()

    counted = df.select(text_col).mapInArrow(run, "piece string, cnt long")
    return counted.groupBy("piece").agg(F.sum("cnt").alias("cnt"))


def words_from_pieces(pc: DataFrame, n_special: int) -> DataFrame:
    """(cnt, ids): the merge state of every distinct piece with >= 2 symbols,
    as base token ids."""
    ids = symbol_ids(to_symbols("piece"), n_special)
    return (pc.select(F.col("cnt").cast("bigint").alias("cnt"), ids.alias("ids"))
            .where(F.size("ids") >= 2))


def pair_counts(words: DataFrame) -> DataFrame:
    """(left_id, right_id, freq): count-weighted adjacent pairs."""
    n = F.size("ids")
    pairs = F.arrays_zip(F.slice("ids", 1, n - 1).alias("l"), F.slice("ids", 2, n - 1).alias("r"))
    return (words.select("cnt", F.explode(pairs).alias("p"))
            .groupBy(F.col("p.l").alias("left_id"), F.col("p.r").alias("right_id"))
            .agg(F.sum("cnt").cast("bigint").alias("freq")))
