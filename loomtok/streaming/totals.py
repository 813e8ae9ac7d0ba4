"""Live tokenization of arriving texts with running totals per group.

``stream_token_totals`` runs the batch plan on each micro-batch and keeps the
batch's totals as rows of their own, so a replayed batch replaces what it
wrote before.  ``token_totals_stream`` keeps the totals in Spark's streaming
state instead.  With ``trigger(availableNow=True)`` either drains what has
arrived and stops; the totals equal the batch totals, and a later call with
the same folder goes on from there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.functions.text import byte_len, char_len, word_count
from loomtok.operators.encode import Encoder
from loomtok.operators.model import BpeModel
from loomtok.session import ensure_checkpoint_dir


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def arriving(spark: SparkSession, path: str, columns: list[str], glob: str | None = None,
             max_files_per_trigger: int | None = None) -> DataFrame:
    """The parquet files of a folder as a stream; ``glob`` on their names, or
    the name of a table in it that is a folder of files."""
    if glob and is_folder(spark, own := os.path.join(path, glob)):
        path, glob = own, None
    static, reader = spark.read, spark.readStream
    if glob:
        static, reader = static.option("pathGlobFilter", glob), reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.schema(static.parquet(path).schema).parquet(path).select(*columns)


def token_count_udf(model: BpeModel):
    """Arrow UDF text -> number of tokens; the model ships in a broadcast."""
    shared = SparkSession.active().sparkContext.broadcast(model.plain())

    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in parts:
            yield pd.Series([len(encoder.ids(t)) if t else 0 for t in texts], dtype="int64")

    return F.pandas_udf(count, T.LongType())


def token_totals_stream(stream: DataFrame, model: BpeModel, group_col: str = "lang",
                        text_col: str = "text") -> DataFrame:
    tokens = token_count_udf(model)
    rows = stream.select(group_col, word_count(text_col).alias("w"), char_len(text_col).alias("c"),
                         byte_len(text_col).alias("b"), tokens(F.col(text_col)).alias("t"))
    return rows.groupBy(group_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("num_documents"),
        F.sum("w").cast("bigint").alias("total_words"),
        F.sum("t").cast("bigint").alias("total_tokens"),
        F.sum("c").cast("bigint").alias("total_chars"),
        F.sum("b").cast("bigint").alias("total_bytes_utf8"))


TOTAL_COLUMNS = ["num_documents", "total_words", "total_tokens", "total_chars", "total_bytes_utf8"]


def stream_token_totals(spark: SparkSession, path: str, model: BpeModel, group_col: str = "lang",
                        text_col: str = "text", max_files_per_trigger: int | None = None,
                        glob: str | None = None, out_dir: str | None = None) -> DataFrame:
    """Drain the parquet files arriving in directory ``path`` (optionally only
    names matching ``glob``) and return running totals per group.

    Each micro-batch runs the batch plan inside ``foreachBatch`` and writes
    its partial totals (a row for each group) to
    ``<out_dir>/partials/batch_id=<n>``.  A replayed batch overwrites its own
    partition, so the output is exactly-once; the totals are the sum over
    partitions.  Give ``out_dir`` a fixed folder that all executors share and
    the next call goes on where this one ended, files seen before are not
    read again; without it the stream has a new folder below the checkpoint
    folder and begins anew.
    """
    from loomtok.operators.evaluate import group_totals
    from loomtok.sources.tables import spread

    src = arriving(spark, path, [group_col, text_col], glob, max_files_per_trigger)
    name = f"token_totals_{uuid.uuid4().hex[:12]}"
    base = out_dir or os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}")
    partials = os.path.join(base, "partials")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        totals = group_totals(spread(batch), model, group_col, text_col)
        totals.write.mode("overwrite").parquet(os.path.join(partials, f"batch_id={batch_id}"))

    q = (src.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    out = spark.read.parquet(partials)
    return out.groupBy(group_col).agg(*[F.sum(c).cast("bigint").alias(c) for c in TOTAL_COLUMNS])


def stream_token_totals_in_state(spark: SparkSession, path: str, model: BpeModel, group_col: str = "lang",
                                 text_col: str = "text", glob: str | None = None) -> DataFrame:
    """Variant keeping the totals in Spark's streaming state (complete mode,
    memory sink): one row for each group reaches the driver."""
    src = arriving(spark, path, [group_col, text_col], glob)
    name = f"token_totals_{uuid.uuid4().hex[:12]}"
    ckpt = os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}")
    q = (token_totals_stream(src, model, group_col, text_col).writeStream
         .outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.table(name)
