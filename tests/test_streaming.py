"""The stream's totals: several files and batches, a restart in the middle, a
replayed batch, and the variant that keeps its totals in Spark's state."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from loomtok.operators.evaluate import group_totals
from loomtok.streaming.tokens import Versions, live_token_rows, live_token_totals, token_rows
from loomtok.streaming.totals import TOTAL_COLUMNS, stream_token_totals, stream_token_totals_in_state


def _rows(df):
    return sorted((r.lang, *(r[c] for c in TOTAL_COLUMNS)) for r in df.collect())


def _texts(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def arriving(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "text")
    path = str(tmp_path / "in")

    def arrive(low, high):
        docs.withColumn("n", F.pmod(F.xxhash64("text"), F.lit(6))).where(f"n >= {low} AND n < {high}").drop("n") \
            .repartition(2).write.mode("append").parquet(path)
    return docs, path, arrive


def test_restart_goes_on(spark, toy_model, arriving, tmp_path):
    docs, path, arrive = arriving
    out = str(tmp_path / "state")
    arrive(0, 2)
    first = stream_token_totals(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)
    low = docs.where(F.pmod(F.xxhash64("text"), F.lit(6)) < 2)
    assert _rows(first) == _rows(group_totals(low, toy_model, "lang"))
    arrive(2, 6)
    second = stream_token_totals(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)
    assert _rows(second) == _rows(group_totals(docs, toy_model, "lang"))
    batches = {r.batch_id for r in spark.read.parquet(out + "/partials").select("batch_id").distinct().collect()}
    assert len(batches) >= 4
    # a batch that is run again replaces its own rows
    last = max(batches)
    again = spark.read.parquet(f"{out}/partials/batch_id={last}").collect()
    spark.createDataFrame(again).write.mode("overwrite").parquet(f"{out}/partials/batch_id={last}")
    assert _rows(stream_token_totals(spark, path, toy_model, out_dir=out)) == _rows(group_totals(docs, toy_model, "lang"))


def test_totals_in_state(spark, toy_model, arriving):
    docs, path, arrive = arriving
    arrive(0, 6)
    assert _rows(stream_token_totals_in_state(spark, path, toy_model)) == _rows(group_totals(docs, toy_model, "lang"))


def _forget_last_batch(checkpoint):
    """The commit of the last batch is lost, as when the driver dies before
    it: the next start runs that batch again."""
    commits = os.path.join(checkpoint, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    return last


def test_live_totals_restart_and_replay(spark, toy_model, arriving, tmp_path):
    docs, path, arrive = arriving
    out = str(tmp_path / "totals")
    arrive(0, 2)
    low = docs.where(F.pmod(F.xxhash64("text"), F.lit(6)) < 2)
    assert _rows(live_token_totals(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)) == _rows(group_totals(low, toy_model, "lang"))
    last = _forget_last_batch(out + "/checkpoint")
    again = live_token_totals(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)
    assert _rows(again) == _rows(group_totals(low, toy_model, "lang")) and Versions(spark, out + "/totals").all()[-1] == last
    arrive(2, 6)
    assert _rows(live_token_totals(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)) == _rows(group_totals(docs, toy_model, "lang"))
    # the state grows with the groups: two versions are left, whatever the batches
    versions = Versions(spark, out + "/totals").all()
    assert len(versions) == 2 and versions[-1] >= 3
    # nothing new: the totals stay
    assert _rows(live_token_totals(spark, path, toy_model, out_dir=out)) == _rows(group_totals(docs, toy_model, "lang"))


def test_a_version_cut_short_is_not_read(spark, toy_model, arriving, tmp_path):
    docs, path, arrive = arriving
    out = str(tmp_path / "totals")
    arrive(0, 6)
    expected = _rows(live_token_totals(spark, path, toy_model, out_dir=out))
    os.makedirs(out + "/totals/v=99")
    assert _rows(live_token_totals(spark, path, toy_model, out_dir=out)) == expected == _rows(group_totals(docs, toy_model, "lang"))


def test_live_rows_restart_and_replay(spark, toy_model, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").where("doc_id < 30")
    docs = docs.unionByName(spark.createDataFrame([(1000, None), (1001, ""), (None, "aaaaaaa <s> b\u00e9")], "doc_id long, text string"))
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda df: sorted(map(str, df.collect()))
    early = docs.where("doc_id < 12")
    early.repartition(2).write.mode("append").parquet(path)
    assert rows(live_token_rows(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)) == rows(token_rows(early, toy_model))
    _forget_last_batch(out + "/checkpoint")
    assert rows(live_token_rows(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)) == rows(token_rows(early, toy_model))
    docs.where("doc_id >= 12 OR doc_id IS NULL").repartition(3).write.mode("append").parquet(path)
    got = live_token_rows(spark, path, toy_model, max_files_per_trigger=1, out_dir=out)
    assert rows(got) == rows(token_rows(docs, toy_model))
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {*range(30), None}


@pytest.mark.parametrize("folder", [False, True])
def test_a_table_may_be_a_file_or_a_folder_of_files(spark, toy_model, tmp_path, folder):
    docs = spark.createDataFrame([(1, "en", "aaaa bc"), (2, "fr", None), (3, None, "bcbc\n"), (3, "en", "")], "doc_id long, lang string, text string")
    path, table = str(tmp_path / "in"), str(tmp_path / "in" / "documents.parquet")
    if folder:
        docs.repartition(3).write.parquet(table)
    else:
        os.makedirs(path)
        docs.toPandas().to_parquet(table)
    docs.limit(1).toPandas().to_parquet(f"{path}/other.parquet")
    expected, glob = _texts(group_totals(docs, toy_model, "lang")), "documents.parquet"
    for totals in (stream_token_totals, live_token_totals, stream_token_totals_in_state):
        assert _texts(totals(spark, path, toy_model, glob=glob)) == expected
    rows = live_token_rows(spark, path, toy_model, glob=glob)
    assert _texts(rows) == _texts(token_rows(docs, toy_model))
