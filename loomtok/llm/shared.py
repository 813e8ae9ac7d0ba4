"""The folder that the driver and all executors share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this machine only where that is
    unset and Spark runs on this machine alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loomtok-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps don't
    compute it once more, and it survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _watched:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_texts(spark: SparkSession) -> None:
    """Rows of whole texts, their ids and bytes are some 10 KB each: 1,000 of
    them make an Arrow batch, not Spark's 10,000, unless the session has a
    number of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


_watched: list[list[str]] = []


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that ``table`` writes within are removed at the end, when
    nothing reads them any more; so are folders put into the list."""
    paths: list[str] = []
    _watched.append(paths)
    try:
        yield paths
    finally:
        _watched[:] = [x for x in _watched if x is not paths]
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
