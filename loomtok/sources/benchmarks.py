"""Benchmark text sets as ``bench(benchmark, ord, text)`` DataFrames.

Two loader shapes from the reference: a *row table* (keep rows whose text is
not blank, untrimmed) and a *text file* (split on newlines, strip, drop
blank lines).  ``max_docs`` keeps the first N in order (0 = all) and runs as
TakeOrderedAndProject.  The registry maps names to loaders; unknown names
are skipped with a warning.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtok.functions.text import has_non_ws, strip_ws
from loomtok.operators.ordering import row_number_global
from loomtok.sources.tables import table

BENCH_SCHEMA = "benchmark string, ord bigint, text string"
#: Parts of a line benchmark that can be asked for.
SPLITS = frozenset({"test"})


def _first_n(df: DataFrame, max_docs: int) -> DataFrame:
    if max_docs and max_docs > 0:
        return df.orderBy("ord").limit(max_docs)
    return df


def bench_rows(df: DataFrame, name: str, order_col: str, text_col: str = "text",
               max_docs: int = 0) -> DataFrame:
    rows = df.where(F.col(text_col).isNotNull() & has_non_ws(text_col)).select(
        F.lit(name).alias("benchmark"), F.col(order_col).cast("bigint").alias("ord"),
        F.col(text_col).alias("text"))
    return _first_n(rows, max_docs)


def bench_lines(df: DataFrame, name: str, key_col: str, text_col: str = "text",
                max_docs: int = 0, split: str = "test") -> DataFrame:
    """Each row's text is a file: lines stripped, blank lines dropped, ``ord``
    = position of the line in (key, line number) order."""
    if split not in SPLITS:
        raise ValueError(f"no part {split!r} of {name}; there are: {', '.join(sorted(SPLITS))}")
    lines = df.select(F.col(key_col).alias("_k"),
                      F.posexplode(F.split(F.col(text_col), "\n")).alias("_ln", "_line"))
    lines = lines.select("_k", "_ln", strip_ws("_line").alias("text")).where(F.length("text") > 0)
    numbered = row_number_global(lines, ["_k", "_ln"], "ord")
    rows = numbered.select(F.lit(name).alias("benchmark"), F.col("ord").cast("bigint"), "text")
    return _first_n(rows, max_docs)


def load_prose(spark: SparkSession, sf_dir: str, max_docs: int = 0) -> DataFrame:
    return bench_rows(table(spark, sf_dir, "benchmark"), "prose", "item_id", max_docs=max_docs)


def load_prose_lines(spark: SparkSession, sf_dir: str, max_docs: int = 0) -> DataFrame:
    return bench_lines(table(spark, sf_dir, "benchmark"), "prose_lines", "item_id", max_docs=max_docs)


def load_dialog(spark: SparkSession, sf_dir: str, max_docs: int = 0) -> DataFrame:
    conv = table(spark, sf_dir, "conversations").where(has_non_ws("text"))
    numbered = row_number_global(conv, ["conv_id", "turn"], "ord")
    return bench_rows(numbered, "dialog", "ord", max_docs=max_docs)


NAMED_SETS: dict[str, Callable[..., DataFrame]] = {
    "prose": load_prose,
    "dialog": load_dialog,
    "prose_lines": load_prose_lines,
}


def bench_union(spark: SparkSession, sf_dir: str, names: list[str], max_docs: int = 0,
                loaders: dict[str, Callable[..., DataFrame]] | None = None) -> DataFrame:
    loaders = NAMED_SETS if loaders is None else loaders
    out = None
    for name in names:
        if name not in loaders:
            warnings.warn(f"unknown benchmark {name!r}, skipping; available: {sorted(loaders)}")
            continue
        df = loaders[name](spark, sf_dir, max_docs=max_docs)
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], BENCH_SCHEMA)
    return out
