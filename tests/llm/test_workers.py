"""Queries on workers that can't import the package: a session started in
another folder, the package known to the driver alone."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
from loomtok import get_spark
spark = get_spark("local[4]", shuffle_partitions=4)
assert spark.range(2).rdd.map(lambda i: __import__("importlib.util").util.find_spec("loomtok") is None).collect() == [True, True]
for name in sorted(n for n in E.queries() if n.startswith("op") or n == "pipeline"):
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
    assert len(run.stdout.split("\n")) >= 14
