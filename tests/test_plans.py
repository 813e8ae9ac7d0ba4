"""Physical-plan properties that matter at scale: filters reach the parquet
scan, unused columns are not read, and the cleaning chain is not duplicated."""
from conftest import SF01

import __spark_entry__ as E
from loomtok.operators.budget import extract_article_corpus, extract_wiki_corpus
from loomtok.sources.tables import articles, wiki_pages


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_language_filter_pushed_into_scan(spark):
    p = _plan(E.queries()["scan_articles_by_lang"](spark, SF01))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p


def test_budget_prefix_pushed_and_pruned(spark):
    p = _plan(extract_article_corpus(articles(spark, SF01), 0.25, 500).corpus)
    assert "LessThanOrEqual(doc_id," in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_cleaning_chain_evaluated_once(spark):
    """Texts go to Python once, and what is returned was written before."""
    from loomtok.operators.budget import wiki_rows
    p = _plan(wiki_rows(wiki_pages(spark, SF01), 500))
    assert p.count("ArrowEvalPython") == 1
    p = _plan(extract_wiki_corpus(wiki_pages(spark, SF01), 0.25, 500).corpus)
    assert "Python" not in p and "LessThanOrEqual(ord," in p


def _cleaned(spark, pages, mb, monkeypatch):
    """The extraction, and how many texts went through the cleaning in all."""
    from loomtok.operators import budget, clean
    acc = spark.sparkContext.accumulator(0)

    def counting(df, text, out, real=clean.clean_pages):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T

        def count(x):
            acc.add(1)
            return x
        return real(df, F.udf(count, T.StringType())(text), out)

    monkeypatch.setattr(budget, "clean_pages", counting)
    ex = budget.extract_wiki_corpus(pages, mb, 500)
    return ex.corpus.collect(), ex.manifest.first(), acc.value


def test_pages_past_the_limit_are_not_cleaned(spark, monkeypatch):
    pages = wiki_pages(spark, SF01)
    rows, manifest, cleaned = _cleaned(spark, pages, 0.1, monkeypatch)
    assert 0 < manifest.articles_kept == len(rows) < 100 and cleaned < pages.count() / 2


def test_each_page_is_cleaned_once(spark, monkeypatch):
    """Rows, counters and all looks together, the budget reached or not."""
    pages = wiki_pages(spark, SF01)
    assert _cleaned(spark, pages, 100.0, monkeypatch)[2] == pages.count()
    assert _cleaned(spark, pages, 0.9, monkeypatch)[2] <= pages.count()


def test_queries_release_what_they_cache(spark):
    cached = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for name in ("extract_article_corpus", "extract_wiki_corpus", "compare_models", "vocab_usage", "stream_token_totals"):
        E.queries()[name](spark, SF01.replace("0.01", "0.001")).count()
        before = cached()
        E.queries()[name](spark, SF01.replace("0.01", "0.001")).count()
        assert cached() <= before, name


def test_scans_keep_their_partitions(spark):
    from loomtok.sources.tables import spread
    cores = spark.sparkContext.defaultParallelism
    for n in (1, cores, cores + 1, 2 * cores - 1, 3 * cores):
        assert spread(spark.range(0, 100, 1, n)).rdd.getNumPartitions() == max(n, cores)


def test_buckets_follow_the_data(spark):
    from loomtok.operators.ordering import BUCKET_ROWS, bucket_count
    df = spark.range(1)
    assert bucket_count(df, 10) == spark.sparkContext.defaultParallelism
    assert bucket_count(df, 1000 * BUCKET_ROWS + 1) == 1001


def test_the_session_sets_only_what_is_asked(spark, monkeypatch):
    from loomtok import session
    seen = {}

    class Builder:
        def appName(self, _):
            return self
        master = appName

        def config(self, map):
            seen.update(map)
            return self

        def getOrCreate(self):
            return spark
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.get_spark()
    assert "spark.sql.shuffle.partitions" not in seen and "spark.driver.memory" not in seen


def test_a_cluster_without_shared_folder_is_an_error():
    import pytest

    from loomtok.session import ensure_checkpoint_dir

    class Fake:
        master = "spark://host:7077"
        conf = {}
        sparkContext = property(lambda self: self)

        def getCheckpointDir(self):
            return None
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Fake())
