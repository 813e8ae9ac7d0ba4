"""Filters, cleaning, budget cut, XML scan, benchmark loaders, evaluation."""
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from loomtok.operators import budget, clean, evaluate
from loomtok.sources import benchmarks, tables, xmldump


def test_page_validity_goldens(spark):
    got = {r.reason: r["count"] for r in
           clean.page_validity(tables.wiki_pages(spark, SF01), 500).groupBy("reason").count().collect()}
    assert got == {"null_text": 44, "redirect": 87, "disambig": 67, "namespace": 86, "short": 27, "ok": 689}


def test_filter_edges(spark):
    rows = [(0, None, "x" * 600), (1, "A", None), (2, "B", "　\xa0#Redirect [[x]]" + "y" * 600),
            (3, "C", "a #redirect " + "y" * 600), (4, "category:Z", "y" * 600), (5, "Category:Z", "y" * 600)]
    df = spark.createDataFrame(rows, "ord long, title string, wikitext string")
    got = {r.ord: r.reason for r in clean.page_validity(df, 500).collect()}
    assert got == {0: "ok", 1: "null_text", 2: "redirect", 3: "ok", 4: "ok", 5: "namespace"}


def test_clean_wikitext_fixture(spark):
    raw = ("{{Infobox|a={{b|c}}|d={{e|{{f}}}}}}\n== Head ==\n<!-- note -->[[Quito|a high city]] and [[Rome]] body"
           "[1][22]<ref name=\"x\"/><ref>cite</ref>  &lt;ok&gt; &amp;amp;\n\n\n\ntail\t end "
           "[[File:x.jpg|thumb|see [[Oslo]]]] [[Category:Z]] [https://a.b label] '''bold''' {| x\n| y |}")
    df = spark.createDataFrame([(raw,)], "t string")
    got = df.select(clean.clean_wikitext("t").alias("c")).first().c
    assert got == "Head\na high city and Rome body <ok> &amp;\n\ntail end label bold"


def _python_budget(rows, limit):
    kept, skipped, written = [], 0, 0
    for ord_, valid, n in sorted(rows):
        if not valid:
            skipped += 1
            continue
        kept.append(ord_)
        written += n
        if written >= limit:
            break
    return kept, skipped, written


def test_budget_matches_sequential_loop(spark):
    import random
    rnd = random.Random(7)
    rows = [(i * 3 + rnd.randint(0, 2), rnd.random() > 0.2, rnd.randint(1, 50)) for i in range(300)]
    rows = [(o, v, n if v else 0) for o, v, n in rows]
    df = spark.createDataFrame(rows, "ord long, valid boolean, n_bytes long")
    total = sum(n for _, v, n in rows if v)
    for limit in [0, 1, 49, 500, total, total + 1, 10 ** 9]:
        kept, counters = budget.cut_at_budget(df, limit, n_buckets=7)
        exp_kept, exp_skipped, exp_bytes = _python_budget(rows, max(limit, 1))
        c = counters.first()
        assert sorted(r.ord for r in kept.collect()) == exp_kept, limit
        assert (c.articles_kept, c.articles_skipped, c.bytes_written) == (len(exp_kept), exp_skipped, exp_bytes)


def test_budget_with_null_and_equal_ord(spark):
    """Rows and counters come from one cut; equal articles are kept as far
    as they fit, null places come last."""
    rows = [(1, 7, True, 10), (2, 1, True, 10), (2, 1, True, 10), (2, 1, True, 10), (2, 0, False, 0), (None, 3, True, 10), (None, 2, True, 10)]
    df = spark.createDataFrame(rows, "ord long, tie long, valid boolean, n_bytes long")
    for limit, expected in [(5, (1, 0, 10)), (20, (2, 1, 20)), (21, (3, 1, 30)), (40, (4, 1, 40)), (41, (5, 1, 50)), (60, (6, 1, 60)), (99, (6, 1, 60))]:
        kept, counters = budget.cut_at_budget(df, limit, n_buckets=3)
        c, out = counters.first(), kept.collect()
        assert (c.articles_kept, c.articles_skipped, c.bytes_written) == expected == (len(out), expected[1], sum(r.n_bytes for r in out)), limit
    ex = budget.extract_article_corpus(spark.createDataFrame([(None, "a", "x" * 9), (1, "b", "y" * 9), (None, None, "z" * 9)], "ord long, title string, text string"), 1, 5)
    assert ex.manifest.first().articles_kept == 3 == ex.corpus.count()


def test_early_looks_find_the_same_cut(spark):
    """Rows of even and of very uneven size, so that the guess of how many
    ranges to look at is right, too small and too large."""
    for size in (lambda i: 11, lambda i: 1 if i < 700 else 500, lambda i: 500 if i < 200 else 1):
        rows = [(i, i % 5, i % 7 > 0, size(i) if i % 7 else 0) for i in range(900)]
        df = spark.createDataFrame(rows, "ord long, tie long, valid boolean, n_bytes long")
        looks = []

        def written(part):
            looks.append(sorted(r.ord for r in part.collect()))
            return part
        for limit in (1, 5000) if size(0) == 500 else (300, 10 ** 6):
            looks.clear()
            a, b = budget.cut_at_budget(df, limit), budget.cut_at_budget(df, limit, order=df.select("ord"), written=written)
            kept, skipped, n_bytes = _python_budget([(o, v, n) for o, _, v, n in rows], limit)
            assert a[1].collect() == b[1].collect() and sorted(a[0].collect()) == sorted(b[0].collect())
            assert sorted(r.ord for r in b[0].collect()) == kept and tuple(b[1].first()) == (len(kept), skipped, n_bytes)
            assert [x for look in looks for x in look] == list(range(len([x for look in looks for x in look])))  # in order, each row once


def test_nested_markup_of_any_depth(spark):
    cases = {
        "{{a" * 30 + "}}" * 30 + " tail": "tail",
        "{{Infobox|x=\n{| a\n| b {{c}}\n|}\n}}after": "after",
        "{{{1|q}}} x {{t|{{{2}}}}}y": "x y",
        "pre <references> mid <ref>a</ref> post": "pre mid post",
        "a < b and c\n\nsecond paragraph d > e end": "a < b and c\n\nsecond paragraph d > e end",
        "&ndash;&eacute;&#8211;&#x2013;&amp;amp;": "–é––&amp;",
        "[[File:x|[[a|b]] {{c}}]]d [[e|f|g]]": "d f|g",
        "{| open\ntext }} and {{": "{| open\ntext }} and {{",
        "{{a|b|}}c": "c",
        None: None, "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.select("t", clean.clean_wikitext("t").alias("c")).collect()} == cases
    assert {r.t: r.c for r in clean.clean_pages(df, F.col("t"), "c").collect()} == cases
    html_cases = {"<p>a < b and c\n\nd > e</p>": "a < b and c\n\nd > e", "<a title='x>y'>z</a>&mdash;&#39;": "z —'"}
    df = spark.createDataFrame([(k,) for k in html_cases], "t string")
    assert {r.t: r.c for r in df.select("t", clean.clean_html("t").alias("c")).collect()} == html_cases


def test_budget_golden_articles(spark):
    ex = budget.extract_article_corpus(tables.articles(spark, SF01), 1.0, 500)
    m = ex.manifest.first()
    assert (m.articles_kept, m.articles_skipped, m.bytes_written) == (383, 44, 1048722)


def test_xml_roundtrip_with_spaces_and_empty_text(spark):
    rows = [(1, "A", "  leading spaces and trailing newline\n"), (2, "B", None), (3, "", "x")]
    df = spark.createDataFrame(rows, "ord long, title string, wikitext string")
    path = os.path.join(tempfile.mkdtemp(prefix="loomtok-xml-"), "dump")
    xmldump.write_pages(df, path)
    got = {r.ord: (r.title, r.wikitext) for r in xmldump.read_pages(spark, path).collect()}
    assert got == {1: ("A", "  leading spaces and trailing newline\n"), 2: ("B", None), 3: ("", "x")}


def test_bench_loaders(spark):
    df = spark.createDataFrame([(1, "  a  "), (2, "   "), (3, "b\n\n  c \n")], "item_id long, text string")
    rows = benchmarks.bench_rows(df, "x", "item_id").orderBy("ord").collect()
    assert [r.text for r in rows] == ["  a  ", "b\n\n  c \n"]
    lines = benchmarks.bench_lines(df, "y", "item_id").orderBy("ord").collect()
    assert [(r.ord, r.text) for r in lines] == [(1, "a"), (2, "b"), (3, "c")]
    assert [r.text for r in benchmarks.bench_rows(df, "x", "item_id", max_docs=1).collect()] == ["  a  "]
    try:
        benchmarks.bench_lines(df, "y", "item_id", split="train")
        raise AssertionError("split guard")
    except ValueError:
        pass


def test_unknown_benchmark_skipped(spark):
    import warnings
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        df = benchmarks.bench_union(spark, SF01, ["prose", "nope"])
    assert any("nope" in str(x.message) for x in w)
    assert {r.benchmark for r in df.select("benchmark").distinct().collect()} == {"prose"}


def test_report_arithmetic_goldens(spark):
    df = spark.createDataFrame([(201093, 175517, 933452), (50181, 41757, 232925), (0, 0, 5)], "t long, w long, b long")
    got = df.select(evaluate.ratio("t", "w").alias("tpw"), evaluate.ratio("b", "t").alias("bpt")).collect()
    assert [(r.tpw, r.bpt) for r in got] == [(1.1457, 4.6419), (1.2017, 4.6417), (None, None)]


def test_ratios_of_any_size(spark):
    """Half up on the exact quotient, far past what doubles hold."""
    pairs = [(76388307813262, 57160360490896), (10 ** 15, 3), (10 ** 17, 7 * 10 ** 16 + 1), (123456789012345678, 99999999999999999), (1, 8), (3, 20000)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.q for r in df.select(evaluate.ratio("a", "b").alias("q")).collect()]
    expected = [((a * 20000 + b) // (2 * b)) / 10000 for a, b in pairs]
    assert all(abs(x - y) <= 1e-15 * y for x, y in zip(got, expected)) and got[0] == 1.3364 and got[2:] == expected[2:]


def test_row_number_global_hot_leading_key(spark):
    from loomtok.operators.ordering import row_number_global
    rows = [(1 if i % 3 == 0 else i, i) for i in range(600)]   # a third share key 1
    df = spark.createDataFrame(rows, "a long, b long")
    got = row_number_global(df, ["a", "b"], "rn", n_buckets=8)
    exp = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {(r.a, r.b): r.rn for r in got.collect()} == exp
    from loomtok.operators.ordering import composite_splits
    splits = composite_splits(df, ["a", "b"], 8)
    counts = {}
    for r in rows:
        k = sum(1 for sp in splits if sp <= r)
        counts[k] = counts.get(k, 0) + 1
    assert max(counts.values()) <= 3 * len(rows) / 8   # the hot key is split across buckets


def test_overlap_broadcast_and_shuffle_paths_agree(spark):
    bench = spark.createDataFrame([("p", 1, "alpha\n beta \n\ngamma"), ("q", 2, "delta")],
                                  "benchmark string, ord long, text string")
    corpus = spark.createDataFrame([(" beta", ), ("x\ndelta\nalpha  ",), ("zeta",)], "text string")
    a = {r.benchmark: (r.total_lines, r.overlapping_lines, r.overlap_ratio)
         for r in evaluate.benchmark_overlap(bench, corpus).collect()}
    b = {r.benchmark: (r.total_lines, r.overlapping_lines, r.overlap_ratio)
         for r in evaluate.benchmark_overlap(bench, corpus, max_broadcast_lines=0).collect()}
    assert a == b == {"p": (3, 2, 0.6667), "q": (1, 1, 1.0)}
