"""Live tokenization: the token rows of arriving texts, and running totals.

``live_token_rows`` appends the tokens of each arriving text, with ids and
character offsets, to a parquet table; the file sink's log makes a replayed
batch leave no second copy.  ``live_token_totals`` keeps the totals of each
group in Spark's state store and takes the changed groups out in update mode:
a batch writes a new version of the table of totals (the groups it changed,
the others as they were) and drops all versions but the last two, so what is
kept follows the groups and not the number of batches.  A replayed batch
writes its own version again, from the one before it.

Both drain what has arrived and stop (``availableNow``); with a fixed
``out_dir`` in a folder that all executors share the next call goes on where
the last one ended.  Null texts have no tokens and count as empty ones; a
null group is a group.  Files of a table without rows give no rows.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtok.operators.encode import encode_documents
from loomtok.operators.model import BpeModel
from loomtok.session import ensure_checkpoint_dir
from loomtok.streaming.totals import TOTAL_COLUMNS, arriving, token_totals_stream

#: Versions of the totals that stay.
KEPT_VERSIONS = 2


def _own_folder(spark: SparkSession, out_dir: str | None, name: str) -> str:
    return out_dir or os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex[:12]}")


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def token_rows(df: DataFrame, model: BpeModel, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, pos, id, token, start, end: a row for each token; batch or stream."""
    found = encode_documents(df, model, text_col, key).select(key, F.posexplode(F.arrays_zip("ids", "tokens", "offsets")).alias("pos", "t"))
    return found.select(key, "pos", F.col("t.ids").alias("id"), F.col("t.tokens").alias("token"),
                        F.col("t.offsets.start").alias("start"), F.col("t.offsets.end").alias("end"))


def live_token_rows(spark: SparkSession, path: str, model: BpeModel, key: str = "doc_id", text_col: str = "text", glob: str | None = None,
                    max_files_per_trigger: int | None = None, out_dir: str | None = None) -> DataFrame:
    base = _own_folder(spark, out_dir, "token-rows")
    rows = token_rows(arriving(spark, path, [key, text_col], glob, max_files_per_trigger), model, key, text_col)
    _drain(rows.writeStream.format("parquet").outputMode("append").option("path", os.path.join(base, "rows"))
           .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    return spark.read.schema(rows.schema).parquet(os.path.join(base, "rows"))


class Versions:
    """Tables in folders ``v=<n>``, each whole once its write has ended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, *parts))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def all(self) -> list[int]:
        files, where = self._folder()
        if not files.exists(where):
            return []
        names = [s.getPath().getName() for s in files.listStatus(where)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and files.exists(self._folder(n, "_SUCCESS")[1]))

    def read(self, n: int) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, f"v={n}"))

    def write(self, df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(self.path, f"v={n}"))
        for old in [v for v in self.all() if v <= n][:-KEPT_VERSIONS]:
            files, where = self._folder(f"v={old}")
            files.delete(where, True)


def live_token_totals(spark: SparkSession, path: str, model: BpeModel, group_col: str = "lang", text_col: str = "text", glob: str | None = None,
                      max_files_per_trigger: int | None = None, out_dir: str | None = None) -> DataFrame:
    """group_col and ``TOTAL_COLUMNS``, of all that has arrived so far."""
    base = _own_folder(spark, out_dir, "token-totals")
    totals = token_totals_stream(arriving(spark, path, [group_col, text_col], glob, max_files_per_trigger), model, group_col, text_col)
    versions = Versions(spark, os.path.join(base, "totals"))

    def per_batch(changed: DataFrame, batch_id: int) -> None:
        earlier = [v for v in versions.all() if v < batch_id]
        rows = changed.withColumn("_new", F.lit(1))
        if earlier:
            rows = rows.unionByName(versions.read(earlier[-1]).withColumn("_new", F.lit(0)))
        last = rows.groupBy(group_col).agg(F.max_by(F.struct(*TOTAL_COLUMNS), "_new").alias("t"))
        versions.write(last.select(group_col, "t.*").coalesce(1), batch_id)

    _drain(totals.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", os.path.join(base, "checkpoint"))
           .trigger(availableNow=True).start())
    known = versions.all()
    return versions.read(known[-1]) if known else spark.createDataFrame([], totals.schema)
