"""End-to-end runs: corpus -> vocabulary -> evaluation.

One driver program replaces the reference's three processes; intermediate
results stay DataFrames and are materialized only where reused (the kept
corpus, the model tables, the report).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtok.operators.budget import extract_article_corpus, extract_wiki_corpus
from loomtok.operators.evaluate import eval_metrics, report_json, summary_table, timed_report
from loomtok.operators.serving import training_config
from loomtok.operators.train import TrainStats, train_on_texts
from loomtok.plans.models import vocab_for
from loomtok.sinks.writers import write_corpus_text, write_json_rows, write_text
from loomtok.sources.benchmarks import bench_union
from loomtok.sources.tables import articles
from loomtok.sources.xmldump import read_pages


def flagship(spark: SparkSession, sf_dir: str, merges: int = 12, size_limit_mb: float = 100.0,
             min_chars: int = 500, benchmarks: tuple[str, ...] = ("prose", "dialog")) -> DataFrame:
    """documents -> budgeted article corpus -> exact BPE -> eval metrics."""
    ex = extract_article_corpus(articles(spark, sf_dir), size_limit_mb, min_chars)
    model = train_on_texts(ex.corpus, vocab_for(merges), text_col="block")
    return eval_metrics(bench_union(spark, sf_dir, list(benchmarks)), model)


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str, merges: int = 200,
                 size_limit_mb: float = 100.0, min_chars: int = 500, lang: str = "en",
                 benchmarks: tuple[str, ...] = ("prose", "dialog"), max_docs: int = 0,
                 dump_path: str | None = None) -> dict:
    """The full three-stage run with its files: corpus text + manifest,
    model tables and JSON + training config, evaluation report + summary
    table.  With ``dump_path`` the corpus comes from an XML dump, else from
    the articles of one language."""
    t0 = time.time()
    if dump_path is not None:
        ex = extract_wiki_corpus(read_pages(spark, dump_path), size_limit_mb, min_chars, lang=lang, output_file=f"{out_dir}/corpus")
    else:
        src = articles(spark, sf_dir).where(F.col("lang") == lang)
        ex = extract_article_corpus(src, size_limit_mb, min_chars, lang=lang,
                                    output_file=f"{out_dir}/corpus", source=sf_dir)
    corpus = ex.corpus.persist()
    write_corpus_text(corpus, f"{out_dir}/corpus")
    seconds = time.time() - t0
    write_json_rows(ex.manifest.withColumn("extraction_seconds", F.lit(round(seconds, 3))), f"{out_dir}/extraction_manifest")
    stats = TrainStats()
    model = train_on_texts(corpus, vocab_for(merges), text_col="block", stats=stats)
    model.save(spark, f"{out_dir}/model")
    write_text(spark.createDataFrame([(model.to_json(),)], "value string"), f"{out_dir}/tokenizer_json")
    write_json_rows(training_config(corpus, model, "block", f"{out_dir}/corpus", stats.seconds, f"{out_dir}/model"),
                    f"{out_dir}/training_config")
    corpus.unpersist()
    bench = bench_union(spark, sf_dir, list(benchmarks), max_docs=max_docs)
    report = timed_report(bench, model)
    write_text(report_json(report, model.vocab_size, f"{out_dir}/model"), f"{out_dir}/evaluation_report")
    table = [r.markdown_row for r in summary_table(report).orderBy("benchmark").collect()]
    return {"seconds": time.time() - t0, "train_rounds": stats.rounds, "summary": table}
