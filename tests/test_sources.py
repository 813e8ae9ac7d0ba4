"""Dumps made elsewhere, dated snapshots, benchmarks against each other, and
workers that can't import the package."""
import bz2
import os
import random
import subprocess
import sys
import xml.etree.ElementTree as ET

from conftest import SF01
from loomtok.operators import evaluate
from loomtok.sources import benchmarks, tables, xmldump

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEAD = '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="en">\n  <siteinfo><sitename>W</sitename></siteinfo>\n'


def _page(i, title, revisions, extra=""):
    body = "".join(f'    <revision>\n      <id>{i}{n}</id>\n      <contributor><username>u&amp;v</username><id>7</id></contributor>\n      <text{attrs}>{text}</text>\n'
                   f'      <sha1>x</sha1>\n    </revision>\n' for n, (attrs, text) in enumerate(revisions))
    return f"  <page>\n    <title>{title}</title>\n    <ns>0</ns>\n    <id>{i}</id>\n{extra}{body}  </page>\n"


def _pages(n):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    out = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randint(1, 300))) + " &lt;ref&gt;&amp;amp; é日\n"
        attrs = rng.choice([' bytes="9" xml:space="preserve"', ' xml:space="preserve"', ""])
        revisions = [(attrs, text)] + ([(attrs, "second " + text)] if i % 5 == 0 else [])
        if i % 11 == 0:
            revisions = [(' bytes="0"', "")] + revisions[1:]
        out.append(_page(i + 1, f"T {i} &amp; co", [] if i % 13 == 7 else revisions, '    <redirect title="x" />\n' if i % 7 == 0 else ""))
    return out


def _sequential(xml):
    """One page after the other, the first revision of each."""
    ns = "{http://www.mediawiki.org/xml/export-0.10/}"
    out = []
    for page in ET.fromstring(xml).iter(ns + "page"):
        text = page.find(f"{ns}revision/{ns}text")
        out.append((int(page.find(ns + "id").text), page.find(ns + "title").text, (text.text or None) if text is not None else None))
    return sorted(out)


def test_a_dump_of_several_streams_read_in_splits(spark, tmp_path):
    pages = _pages(900)
    xml = HEAD + "".join(pages) + "</mediawiki>\n"
    path = str(tmp_path / "dump.xml.bz2")
    with open(path, "wb") as f:  # a stream for the head, one for each 100 pages, one for the end
        f.write(bz2.compress(HEAD.encode()))
        for a in range(0, len(pages), 100):
            f.write(bz2.compress("".join(pages[a:a + 100]).encode()))
        f.write(bz2.compress(b"</mediawiki>\n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(20_000, os.path.getsize(path) // 6)))
    try:
        got = xmldump.read_pages(spark, path)
        assert got.rdd.getNumPartitions() >= 3
        assert sorted(map(tuple, got.collect()), key=str) == sorted(_sequential(xml), key=str)
        plain = str(tmp_path / "dump.xml")
        open(plain, "w", encoding="utf-8").write(xml)
        assert sorted(map(tuple, xmldump.read_pages(spark, plain).collect()), key=str) == sorted(_sequential(xml), key=str)
        assert xmldump.broken_pages(spark, plain) == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_broken_pages_are_rows_of_their_own(spark, tmp_path):
    good = _pages(30)
    bad = ["  <page>\n    <title>Bad</title><id>77</id>\n    <revision><text>no end of <b>this</text></revision>\n  </page>\n",
           "  <page>\n    <title>Bad & worse</title><id>78</id>\n  </page>\n"]
    path = str(tmp_path / "dump.xml")
    open(path, "w", encoding="utf-8").write(HEAD + "".join(good[:10] + bad[:1] + good[10:] + bad[1:]) + "</mediawiki>\n")
    expected = _sequential(HEAD + "".join(good) + "</mediawiki>\n")
    assert sorted(map(tuple, xmldump.read_pages(spark, path).collect()), key=str) == sorted(expected, key=str)
    rows = xmldump.scan_pages(spark, path).where("broken IS NOT NULL").collect()
    assert len(rows) == 2 == xmldump.broken_pages(spark, path)
    assert all(r.ord is None and r.title is None and r.wikitext is None and "Bad" in r.broken for r in rows)


def test_snapshots_are_partitions(spark, tmp_path):
    dated = tables.dated_articles(spark, SF01)
    path = str(tmp_path / "snapshots")
    tables.write_snapshots(dated, path)
    got = tables.article_snapshot(spark, path, "de", "20231101")
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "(snapshot" in filters and "(lang" in filters and "= 20231101" in filters and "= de" in filters
    expected = dated.where("lang = 'de' AND snapshot = '20231101'").select("ord", "title", "lang", "text")
    assert sorted(got.collect()) == sorted(expected.collect()) and got.count() > 0
    files = {f.split("snapshots/")[1].rsplit("/", 1)[0] for f in got.inputFiles()}
    assert "snapshot=20231101/lang=de" in files and tables.article_snapshot(spark, path, "xx", "20231101").count() == 0


def test_benchmarks_against_each_other(spark):
    rows = [("a", 1, "one\n two \n\nthree"), ("a", 2, "one"), ("b", 1, "two\nfour"), ("c", 1, "five"), ("d", 1, "  \n "), ("e", 1, None), ("f", 1, "two\none\nthree")]
    got = evaluate.benchmark_disjointness(spark.createDataFrame(rows, "benchmark string, ord long, text string"))
    lines = {"a": {"one", "two", "three"}, "b": {"two", "four"}, "c": {"five"}, "d": set(), "e": set(), "f": {"one", "two", "three"}}
    names = sorted(lines)
    expected = {(x, y): (len(lines[x]), len(lines[y]), len(lines[x] & lines[y])) for i, x in enumerate(names) for y in names[i + 1:]}
    assert {(r.benchmark_a, r.benchmark_b): (r.lines_a, r.lines_b, r.shared_lines) for r in got.collect()} == expected
    by = {(r.benchmark_a, r.benchmark_b): r for r in got.collect()}
    assert by["a", "f"].jaccard == 1.0 and by["a", "b"].jaccard == 0.25 and by["d", "e"].jaccard is None
    assert all(r.disjoint == (r.shared_lines == 0) for r in by.values())
    one = benchmarks.bench_union(spark, SF01, ["prose"])
    assert evaluate.benchmark_disjointness(one).count() == 0 and evaluate.benchmark_disjointness(one.limit(0)).count() == 0


CODE = """
import sys
sys.path.insert(0, {repo!r})
from loomtok.plans.registry import QUERIES
from loomtok import get_spark
spark = get_spark("local[4]", shuffle_partitions=4)
assert spark.range(2).rdd.map(lambda i: __import__("importlib.util").util.find_spec("loomtok") is None).collect() == [True, True]
import loomtok.plans.models as m
import loomtok.plans.registry as r
m.TRAIN_MERGES = r.TRAIN_MERGES = 40
m.documents_model.__defaults__ = (40, 2)
for name, query in QUERIES.items():
    print(name, query(spark, "/root/testdata/sf0.001").count())
from loomtok.operators.evaluate import timed_report
from loomtok.sources.benchmarks import bench_union
print(timed_report(bench_union(spark, "/root/testdata/sf0.001", ["prose"]), m.documents_model(spark, "/root/testdata/sf0.001")).count())
"""


def test_queries_on_workers_without_the_package(tmp_path):
    """A session started in another folder, the package known to the driver alone."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
