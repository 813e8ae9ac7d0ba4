"""Rows dealt to ranges of one order, for work that follows it row by row.

A key is a string whose byte order is the wanted order: ``long_key`` of an
integer column (nulls first), ``hash_key`` of anything that only tells rows
apart, put together by ``concat``.  ``Ranges`` cuts the keys at bounds from a
sample (``PER_RANGE`` keys for each range reach the driver) into ranges of
about ``RANGE_ROWS`` rows, ``MAX_RANGES`` at most; a larger table has larger
ranges.  Each range is a number, in order; what the driver keeps is one bound
for each.  Rows of one key share a range, so keys should tell most rows apart:
a hot leading value is then cut like any other.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_ROWS = 1024
MAX_RANGES = 1 << 16
PER_RANGE = 12
#: Characters of a ``long_key``.
LONG_KEY = 17


def long_key(c: Column) -> Column:
    """17 characters, in the order of the number; null comes before all."""
    x = c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.coalesce(F.concat(F.lit("1"), F.lpad(F.hex(x), 16, "0")), F.lit("0" * LONG_KEY))


def hash_key(*columns: Column) -> Column:
    return F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")


class Ranges:
    """The ranges of the column ``key`` of ``rows``."""

    def __init__(self, rows: DataFrame, key: str, seed: int = 11):
        total = rows.count()
        n = min(MAX_RANGES, -(-total // RANGE_ROWS))
        self.bounds: list[str] = []
        if n > 1:
            some = rows.select(key).sample(fraction=min(1.0, n * PER_RANGE / total), seed=seed)
            keys = sorted(r[0] for r in some.collect())
            step = max(1, len(keys) // n)
            self.bounds = sorted(set(keys[step::step]))

    def of(self, key: Column) -> Column:
        """Number of the range: how many bounds are at or below the key, found in two steps."""
        if not self.bounds:
            return F.lit(0)
        width = max(1, int(len(self.bounds) ** 0.5))
        blocks = [self.bounds[i:i + width] for i in range(0, len(self.bounds), width)]
        # read from a text, which Spark does once, when it plans
        heads = F.from_json(F.lit(json.dumps([b[0] for b in blocks])), "array<string>")
        inner = F.from_json(F.lit(json.dumps(blocks)), "array<array<string>>")
        block = F.size(F.filter(heads, lambda b: b <= key))
        below = lambda at: (at - 1) * width + F.size(F.filter(F.element_at(inner, at), lambda b: b <= key))
        return F.when(block == 0, 0).otherwise(F.element_at(F.transform(F.array(block), below), 1))


def with_next(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt to ranges of ``key`` (``_range``).  Each range ends with a
    guest (``_guest``), a copy of the first row of the next range; after the
    last range comes the first.

    So ``lead`` over ``Window.partitionBy("_range").orderBy("_guest", key)``
    is the next row of the whole table, after which guests are dropped.
    ``rows`` is shuffled once."""
    spark = rows.sparkSession
    ranges = Ranges(rows, key)
    dealt = rows.withColumn("_home", ranges.of(F.col(key)).cast("int"))
    # one key for each range
    firsts = sorted((r[0], r[1]) for r in dealt.groupBy("_home").agg(F.min(key)).collect())
    guests = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    also = spark.createDataFrame(guests, f"{key} string, _visits int")
    both = dealt.join(F.broadcast(also), key, "left")
    places = F.array(F.struct(F.col("_home").alias("range"), F.lit(False).alias("guest")),
                     F.struct(F.col("_visits").alias("range"), F.lit(True).alias("guest")))
    both = both.withColumn("_place", F.explode(F.filter(places, lambda p: p["range"].isNotNull())))
    return both.withColumns({"_range": F.col("_place.range"), "_guest": F.col("_place.guest")}).drop("_home", "_visits", "_place").repartition("_range")
