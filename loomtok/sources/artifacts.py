"""Reading the run's own artifacts back: evaluation report and training
config (the serving layer's report and vocab-size calls).

A missing report is an error (the API answered 404); a missing training
config means "no special tokens recorded" (the API answered with [])."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class ArtifactNotFound(FileNotFoundError):
    """Raised when a required artifact (e.g. the evaluation report) is absent."""


def _read_json(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("multiLine", "true").json(path)
    except AnalysisException as e:   # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def read_report(spark: SparkSession, path: str) -> DataFrame:
    df = _read_json(spark, path)
    if df is None:
        raise ArtifactNotFound(f"no evaluation report at {path}; run the evaluation first")
    return df


def read_special_tokens(spark: SparkSession, config_path: str) -> list[str]:
    """Special tokens recorded by training; [] when no config exists."""
    df = _read_json(spark, config_path)
    if df is None or "special_tokens" not in df.columns:
        return []
    row = df.select(F.col("special_tokens")).first()
    v = row[0] if row else None
    if v is None:
        return []
    return list(v)
