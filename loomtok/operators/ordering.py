"""Ordered running sums without a single-partition window.

A global ``sum(x) OVER (ORDER BY ord)`` puts every row in one task.  Here it
is two-level: rows are cut into ``n_buckets`` ranges of ``ord`` (split points
from ``percentile_approx``, so clustered ``ord`` values still give even
buckets), per-bucket totals are aggregated (tiny), turned into bucket offsets
on the driver (``n_buckets`` numbers), and the window runs *within* buckets
in parallel.  ``keep_buckets`` lets callers prune buckets before the window
shuffle (e.g. everything after a byte budget is crossed).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one bucket's window holds on average.
BUCKET_ROWS = 1_000_000


def bucket_count(df: DataFrame, n_rows: int) -> int:
    """Buckets follow the data: one for each core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // BUCKET_ROWS))


def bucket_splits(df: DataFrame, order_col: str, n_buckets: int) -> list:
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.select(F.percentile_approx(order_col, probs, 10000).alias("q")).first()
    return sorted(set(row.q or []))


def bucket_of(order: Column, splits: list) -> Column:
    if not splits:
        return F.lit(0)
    arr = F.array(*[F.lit(s) for s in splits])
    return F.when(order.isNull(), len(splits)).otherwise(F.size(F.filter(arr, lambda s: s <= order)))


def prefix_sum_before(df: DataFrame, order_col: str, value_col: str, out_col: str = "pre",
                      n_buckets: int | None = None,
                      keep_buckets: Callable[[list[int]], int] | None = None, tie: str | None = None) -> DataFrame:
    """Adds ``out_col`` = Σ value over rows with smaller ``order_col``
    (nulls come last; rows of one value go by ``tie``).

    ``keep_buckets(totals)`` may return the last bucket index worth keeping.
    """
    splits = bucket_splits(df, order_col, n_buckets or bucket_count(df, df.count()))
    b = df.withColumn("_bucket", bucket_of(F.col(order_col), splits))
    totals = {r["_bucket"]: r["t"] or 0 for r in
              b.groupBy("_bucket").agg(F.sum(value_col).alias("t")).collect()}
    n = (max(totals) + 1) if totals else 1
    seq = [totals.get(i, 0) for i in range(n)]
    offsets, acc = [], 0
    for t in seq:
        offsets.append(acc)
        acc += t
    if keep_buckets is not None:
        last = keep_buckets(seq)
        b = b.where(F.col("_bucket") <= last)
    off = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_bucket") + 1)
    keys = [F.col(order_col).asc_nulls_last(), *([F.col(tie)] if tie else [])]
    w = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return (b.withColumn(out_col, off + F.sum(value_col).over(w) - F.col(value_col))
            .drop("_bucket"))


def composite_splits(df: DataFrame, order_cols: list[str], n_buckets: int | None,
                     per_bucket: int = 20, seed: int = 17) -> list[tuple]:
    """Bucket bounds over the full composite order key from a seeded sample
    of about ``per_bucket`` keys per bucket (bounded, whatever the data
    size), so one hot leading value is still split across buckets."""
    total = df.count()
    n_buckets = n_buckets or bucket_count(df, total)
    if total == 0 or n_buckets <= 1:
        return []
    frac = min(1.0, n_buckets * per_bucket / total)
    sample = sorted(tuple(r) for r in df.select(*order_cols).sample(fraction=frac, seed=seed).collect()
                    if all(v is not None for v in r))
    if not sample:
        return []
    step = max(1, len(sample) // n_buckets)
    return sorted(set(sample[i] for i in range(step, len(sample), step)))


def row_number_global(df: DataFrame, order_cols: list[str], out_col: str = "ord",
                      n_buckets: int | None = None) -> DataFrame:
    """Dense 1-based row number over a global order, computed in parallel:
    composite-key bucket bounds, per-bucket counts (n_buckets numbers on the
    driver), offsets, and ``row_number`` within each bucket."""
    key = F.struct(*[F.col(c) for c in order_cols])
    splits = composite_splits(df, order_cols, n_buckets)
    if splits:
        arr = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(sp, order_cols)]) for sp in splits])
        bucket = F.size(F.filter(arr, lambda sp: sp <= key))
    else:
        bucket = F.lit(0)
    b = df.withColumn("_bucket", bucket)
    totals = {r["_bucket"]: r["t"] for r in b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("t")).collect()}
    n = (max(totals) + 1) if totals else 1
    offsets, acc = [], 0
    for i in range(n):
        offsets.append(acc)
        acc += totals.get(i, 0)
    off = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_bucket") + 1)
    w = Window.partitionBy("_bucket").orderBy(*order_cols)
    return b.withColumn(out_col, off + F.row_number().over(w)).drop("_bucket")
