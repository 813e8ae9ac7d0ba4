"""A training-data pipeline over ``documents``, part of ``loomtok.llm``.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir)
and returns a frame that is written as Parquet and read again as the next
one's docs.  The stages, in order: quality classifier (rejected documents
go), line dedup, MinHash near-dedup (one document of each group stays),
benchmark decontamination (hit documents go), byte-level BPE.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomtok.llm import queries as q

STAGES = q.STAGES

#: SQL can't state the classifier, nor the near-dedup and BPE stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from the shared folder; what the stages
    before it wrote is removed as soon as the next one has ended."""
    from loomtok.llm.shared import removed_after, shared_folder

    docs = q.read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        with removed_after(spark) as used:
            stage(spark, docs, sf_dir).write.parquet(out)
            if before is not None:
                used.append(before)
        docs, before = spark.read.parquet(out), out
    return docs
