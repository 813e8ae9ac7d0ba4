import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loomtok import get_spark
    s = get_spark("local[4]", app="loomtok-tests", shuffle_partitions=4, driver_memory="4g")
    yield s


@pytest.fixture(scope="session")
def toy_model(spark):
    from loomtok.operators.train import train_bpe
    lines = spark.createDataFrame([("aaaaaaa\n",)] * 3 + [("bcbc\n",)] * 5, "line string")
    return train_bpe(lines, vocab_size=300, min_frequency=2)
