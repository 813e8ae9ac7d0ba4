"""Writers.

The corpus sink range-partitions on ``ord`` and sorts within partitions, so
the part files, read in name order, are the corpus in article order without
any single-task sort.  Blocks carry their own newlines; each row is written
without its final ``\\n`` and the text writer's line separator puts it back.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Seconds between two looks at the counters.
LOOK_EVERY = 0.2


class _Reports:
    """Counters that tasks raise as they go, told while a write runs."""

    def __init__(self, spark, tell: Callable[[int, int], None]):
        self.articles, self.bytes = (spark.sparkContext.accumulator(0) for _ in range(2))
        self.tell, self.told, self.ended = tell, (0, 0), threading.Event()

    def column(self, n_bytes: str):
        """The column itself; only its numbers pass through Python."""
        articles, size = self.articles, self.bytes

        def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                articles.add(len(part))
                size.add(int(part.fillna(0).sum()))
                yield part

        return F.pandas_udf(count, "long")(F.col(n_bytes).cast("long"))

    def look(self) -> None:
        now = (self.articles.value, self.bytes.value)
        if now != self.told:
            self.told = now
            self.tell(*now)

    def __enter__(self) -> _Reports:
        def watch() -> None:
            while not self.ended.wait(LOOK_EVERY):
                self.look()
        self.thread = threading.Thread(target=watch, daemon=True)
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.ended.set()
        self.thread.join()
        self.look()


def write_corpus_text(corpus: DataFrame, path: str, num_partitions: int | None = None,
                      progress: Callable[[int, int], None] | None = None) -> dict:
    """Write the blocks in ``ord`` order; returns the counters (articles,
    bytes) observed on the write itself — no second pass.  ``progress`` is
    told articles and bytes so far whenever tasks of the write have ended
    (a task that runs twice is counted twice there, not in what is returned)."""
    # a number given by the caller, or else the session's shuffle partitions
    body = F.expr("substring(block, 1, length(block) - 1)")
    obs = Observation("corpus_progress")
    # observed above the range shuffle: the bound-sampling job does not
    # pass through it, only the write does
    ranged = corpus.repartitionByRange(num_partitions, "ord") if num_partitions else corpus.repartitionByRange("ord")
    ordered = ranged.sortWithinPartitions("ord")
    observed = ordered.observe(obs, F.count(F.lit(1)).alias("articles"), F.sum("n_bytes").alias("bytes"))
    if progress is None:
        observed.select(body.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
        return obs.get
    with _Reports(corpus.sparkSession, progress) as reports:
        counted = observed.select(body.alias("value"), reports.column("n_bytes").alias("n"))
        # a filter on the counted column, so that it is computed
        counted.where(F.col("n").isNull() | (F.col("n") >= 0)).select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
    return obs.get


def write_json_rows(df: DataFrame, path: str) -> None:
    """Small result tables (manifest, config, report) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str) -> None:
    """One string column as it is, a row a line: a JSON document stays one
    and isn't quoted once more."""
    df.coalesce(1).write.mode("overwrite").text(path)
