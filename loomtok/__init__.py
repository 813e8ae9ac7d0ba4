"""loomtok: corpus building, byte-level BPE training, encoding and
tokenizer evaluation as PySpark DataFrame jobs."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship the (few) Python functions Spark runs on executors by value, so
# workers need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from loomtok.session import ensure_checkpoint_dir, get_spark  # noqa: E402,F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
