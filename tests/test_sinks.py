"""Sinks and artifacts: corpus text order, model tables, report JSON."""
import os
import tempfile

import pytest

from loomtok.operators import budget, evaluate
from loomtok.operators.model import BpeModel
from loomtok.sinks.writers import write_corpus_text, write_json_rows
from loomtok.sources import artifacts


def test_corpus_text_in_order_with_progress(spark):
    rows = [(i, f"t{i}", f"body {i}\nline") for i in (5, 1, 9, 3, 7)]
    df = spark.createDataFrame(rows, "ord long, title string, text string")
    ex = budget.extract_article_corpus(df, 100, 1)
    out = os.path.join(tempfile.mkdtemp(prefix="loomtok-corpus-"), "c")
    progress = write_corpus_text(ex.corpus, out, num_partitions=3)
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in parts)
    expected = "".join(f"\n\n=== t{i} ===\n\nbody {i}\nline\n" for i in sorted(r[0] for r in rows))
    assert text == expected
    assert progress["articles"] == 5 and progress["bytes"] == len(expected.encode())


def test_model_save_load(spark, toy_model):
    path = os.path.join(tempfile.mkdtemp(prefix="loomtok-model-"), "m")
    toy_model.save(spark, path)
    back = BpeModel.load(spark, path)
    assert back.tokens == toy_model.tokens and back.merges == toy_model.merges
    assert back.special_tokens == toy_model.special_tokens


def test_report_roundtrip_and_missing(spark, toy_model):
    d = tempfile.mkdtemp(prefix="loomtok-report-")
    rep = spark.createDataFrame([("x", 2, 10, 12, 40, 41, 1.2, 3.4167)],
                                "benchmark string, num_documents long, total_words long, total_tokens long, "
                                "total_chars long, total_bytes_utf8 long, tokens_per_word double, "
                                "compression_ratio_bytes_per_token double")
    write_json_rows(evaluate.report_json(rep, 300), os.path.join(d, "report"))
    got = artifacts.read_report(spark, os.path.join(d, "report")).first().report_json
    assert got.startswith('{"vocab_size":300,"benchmarks":{"x":{"num_documents":2')
    with pytest.raises(artifacts.ArtifactNotFound):
        artifacts.read_report(spark, os.path.join(d, "nope"))
    assert artifacts.read_special_tokens(spark, os.path.join(d, "nope")) == []


def test_ui_table_format(spark):
    rep = spark.createDataFrame([("x", 1.1457, 4.6419, 1274311.6, 15576465.9)],
                                "benchmark string, tokens_per_word double, compression_ratio_bytes_per_token double, "
                                "encode_chars_per_sec double, decode_chars_per_sec double")
    r = evaluate.ui_table(rep).first()
    assert (r.tokens_per_word, r.bytes_per_token, r.encode_speed, r.decode_speed) == \
        ("1.146", "4.642", "1274k chars/s", "15576k chars/s")


def test_run_pipeline_end_to_end(spark):
    from conftest import SF001
    from loomtok.plans.pipeline import run_pipeline
    out = os.path.join(tempfile.mkdtemp(prefix="loomtok-run-"), "run")
    res = run_pipeline(spark, SF001, out, merges=6, size_limit_mb=0.05)
    assert sorted(os.listdir(out)) == ["corpus", "evaluation_report", "extraction_manifest", "model",
                                       "tokenizer_json", "training_config"]
    report = artifacts.read_report(spark, os.path.join(out, "evaluation_report")).first()
    assert report.tokenizer_path.endswith("/model") and report.benchmarks.prose.total_tokens > 0
    text = spark.read.text(os.path.join(out, "tokenizer_json")).first().value
    assert BpeModel.from_json(text).tokens == BpeModel.load(spark, os.path.join(out, "model")).tokens
    assert artifacts.read_special_tokens(spark, os.path.join(out, "training_config")) == ["<unk>", "<s>", "</s>", "<pad>"]
    m = BpeModel.load(spark, os.path.join(out, "model"))
    assert len(m.merges) == 6 and res["train_rounds"] >= 1
    man = spark.read.json(os.path.join(out, "extraction_manifest")).first()
    assert man.bytes_written >= 0.05 * 1024 * 1024 and man.articles_kept > 0
    assert len(res["summary"]) == 2 and all(r.startswith("| ") for r in res["summary"])


def test_run_pipeline_from_a_dump(spark):
    from conftest import SF001
    from loomtok.plans.pipeline import run_pipeline
    from loomtok.sources import tables, xmldump
    top = tempfile.mkdtemp(prefix="loomtok-dump-")
    xmldump.write_pages(tables.wiki_pages(spark, SF001), os.path.join(top, "dump"))
    res = run_pipeline(spark, SF001, os.path.join(top, "out"), merges=3, size_limit_mb=0.05, dump_path=os.path.join(top, "dump"))
    man = spark.read.json(os.path.join(top, "out", "extraction_manifest")).first()
    assert man.articles_kept > 0 and man.articles_skipped > 0 and man.extraction_seconds > 0 and len(res["summary"]) == 2


def test_article_snapshot(spark, tmp_path):
    from loomtok.sources.tables import article_snapshot
    rows = [(i, f"t{i}", "en" if i % 2 else "de", "2024-01" if i < 6 else "2024-02", "x") for i in range(10)]
    spark.createDataFrame(rows, "ord long, title string, lang string, snapshot string, text string").write.partitionBy("snapshot", "lang").parquet(str(tmp_path / "a"))
    got = article_snapshot(spark, str(tmp_path / "a"), "en", "2024-01")
    assert sorted(r.ord for r in got.collect()) == [1, 3, 5]
    assert "PartitionFilters: [isnotnull(snapshot" in got._jdf.queryExecution().executedPlan().toString()


def test_progress_is_told_while_the_write_runs(spark, tmp_path, monkeypatch):
    """Several reports, ever larger, before the write ends; the last has all."""
    from pyspark.sql import functions as F

    from loomtok.sinks import writers
    monkeypatch.setattr(writers, "LOOK_EVERY", 0.005)
    rows = spark.range(0, 4000, 1, 16).select(F.col("id").alias("ord"), F.concat(F.lit("t"), "id").alias("block"))
    slow = F.udf(lambda x: __import__("time").sleep(0.002) or x, "string")
    corpus = rows.select("ord", F.concat(slow("block"), F.lit("\n")).alias("block"), (F.length("block") + 1).cast("long").alias("n_bytes"))
    told = []
    done = write_corpus_text(corpus, str(tmp_path / "c"), num_partitions=40, progress=lambda articles, size: told.append((articles, size)))
    n_bytes = sum(len(f"t{i}") + 1 for i in range(4000))
    assert done == {"articles": 4000, "bytes": n_bytes} and told[-1] == (4000, n_bytes)
    assert len(told) >= 3 and told == sorted(set(told)) and 0 < told[0][0] < 4000
    text = "".join(open(f, encoding="utf-8").read() for f in sorted((tmp_path / "c").glob("part-*")))
    assert text == "".join(f"t{i}\n" for i in range(4000))


def test_timed_report_in_one_pass(spark, toy_model):
    """The deterministic part equals the metrics; speeds follow from the
    seconds; one job, nothing cached."""
    from pyspark.sql import functions as F
    rows = [("a", 1, "aaaaaaa bcbc"), ("a", 2, "one two"), ("b", 1, "\u00e9\u00e9 <s> x"), ("b", 2, None), ("c", 1, "")]
    bench = spark.createDataFrame(rows, "benchmark string, ord long, text string")
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    spark.sparkContext.setJobGroup("timed", "timed")
    got = evaluate.timed_report(bench, toy_model).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("timed"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2 and spark.sparkContext._jsc.sc().getPersistentRDDs().size() == cached  # AQE runs a shuffle's map side as a job of its own
    plain = evaluate.eval_metrics(bench.fillna("", "text"), toy_model)
    assert sorted(tuple(r)[:8] for r in got) == sorted(map(tuple, plain.collect()))
    for r in got:
        assert r.encode_seconds >= 0 and r.decode_seconds >= 0
        if r.encode_seconds >= 0.001:
            assert abs(r.encode_chars_per_sec - r.total_chars / r.encode_seconds) <= 0.1 * r.encode_chars_per_sec
    assert all(r.encode_chars_per_sec > 0 and r.decode_chars_per_sec > 0 for r in got if r.total_chars)
