"""Shared trained models for the registered queries.

A model is small driver-side data (bounded by vocab_size); it is trained once
for each state of the documents (their files, sizes and times), number of
merges and frequency, and reused by every query in the process.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from loomtok.functions.bytelevel import ALPHABET, DEFAULT_SPECIAL_TOKENS
from loomtok.operators.model import BpeModel
from loomtok.operators.train import train_on_texts
from loomtok.sources.tables import table

TRAIN_MERGES = 2000     # the model of train_bpe_2000
QUERY_MERGES = 256      # the model every other query uses
BASELINE_MERGES = 64    # the comparison model (its first merges)
SPECIAL_MERGES = 64     # the model with special tokens of its own
_CACHE: dict[tuple, BpeModel] = {}


def vocab_for(merges: int) -> int:
    return len(DEFAULT_SPECIAL_TOKENS) + len(ALPHABET) + merges


def documents_model(spark: SparkSession, sf_dir: str, merges: int = QUERY_MERGES,
                    min_frequency: int = 2) -> BpeModel:
    docs = table(spark, sf_dir, "documents")
    files = table(spark, sf_dir, "documents", balance=False).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    key = (frozenset(map(tuple, files.distinct().collect())), merges, min_frequency)
    if key not in _CACHE:
        _CACHE[key] = train_on_texts(docs.select("text"), vocab_for(merges), min_frequency=min_frequency)
    return _CACHE[key]


def public_vocabulary() -> str | None:
    """The file of a public byte-level vocabulary of 50,256 entries, where
    the package that brings it is installed."""
    try:
        import public_tokenizers
    except ImportError:
        return None
    return public_tokenizers.path("byte_bpe_50k.json")
