"""Arrow UDFs hold the Python objects of a few rows only."""
import tracemalloc

import pyarrow as pa

from loomtok.functions.text import SLICE_ROWS
from loomtok.operators import clean


def test_cleaning_holds_a_slice_of_a_batch():
    texts = pa.array([f"{{{{t|{i}}}}}" + "long text &amp; more " * 500 for i in range(4000)] + [None], pa.string())
    for udf in (clean.prose_udf, clean.strip_templates_udf, clean.entities_udf):
        tracemalloc.start()
        out = udf.func(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == len(texts) and out[4000].as_py() is None
        assert peak < 8 * SLICE_ROWS * 10_500
    assert clean.prose_udf.func(texts.slice(0, 1))[0].as_py() == "long text & more " * 500
    assert clean.prose_udf.func(pa.array([], pa.string())).to_pylist() == []
