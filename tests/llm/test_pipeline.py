"""The pipeline's stages against brute force, and the registered queries."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
from loomtok.llm import bpe_prefix, nbsvm, queries
from tests.llm.test_near import classes
from tests.llm.test_text_ops import decontaminated

SF = "/root/testdata/sf0.001"


def rows(df):
    return df.select("doc_id", "text", "lang", "source", "n_chars").collect()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (docs before, docs after), each written and read."""
    docs, out, top = queries.read(spark, SF, "documents"), {}, tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(top / name))
        after = spark.read.parquet(str(top / name))
        out[name] = docs, after
        docs = after
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "bpe"]
    for name, (before, after) in stages.items():
        assert name == "bpe" or after.columns == before.columns


def test_quality(spark, stages):
    before, after = stages["quality"]
    good = nbsvm.score(before, queries.quality_model(spark, SF)).where("score >= 0.3")
    assert sorted(rows(after)) == sorted(rows(good)) and 0 < after.count() < before.count()


def test_lines(stages):
    before, after = map(rows, stages["line_dedup"])
    sites = defaultdict(set)
    for r in before:
        for line in r.text.split("\n"):
            sites[line.strip(" ")].add(r.source)
    expected = []
    for r in before:
        lines = r.text.split("\n")
        left = [x for x in lines if len(sites[x.strip(" ")]) < 10 or not x.strip(" ")]
        expected.append((r.doc_id, "\n".join(left)))
    assert sorted((r.doc_id, r.text) for r in after) == sorted(expected)
    assert all(r.n_chars == len(r.text) for r in after)


def test_near(stages):
    before, after = map(rows, stages["near_dedup"])
    assert sorted(r.doc_id for r in after) == sorted({c for _, c, _ in classes([(r.doc_id, r.text) for r in before])})


def test_decontamination(spark, stages):
    before, after = map(rows, stages["decontamination"])
    items = [(r.item_id, r.text) for r in queries.read(spark, SF, "benchmark").collect()]
    hit = {t for t, _, n, _ in decontaminated([r.text for r in before], items) if n}
    assert sorted(after) == sorted(r for r in before if r.text not in hit) and hit


def test_bpe(stages):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(bpe_prefix.load_ranks(queries_path()))})
    before, after = stages["bpe"]
    assert after.count() == before.count()
    for r in after.collect():
        assert r.exact and r.ids == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids)


def queries_path():
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in stages["bpe"][1].collect())


ODD = [c for c in ("_score", "score", "row", "hits", "items", "n_words", "n_lines", "n_removed", "_k1", "class_id", "first", "key", "id", "root",
                                  "_text", "_h", "_decoded", "ids", "n_tokens")]


def folder_of(spark, path, docs, labels, bench):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_on_odd_rows(spark, docs, corpus, tmp_path):
    """Nulls, empty texts, repeated rows, null keys, clashing names."""
    labels = [(i, i % 2, 0) for i in range(0, 30, 3)] + [(None, 1, 0), (4, None, 0)]
    sf = folder_of(spark, tmp_path / "odd", docs.withColumns({c: F.lit("clash") for c in ODD}), labels, [(1, " ".join(corpus[8][1].split()[5:30])), (2, None), (None, "")])
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns[:len(now.columns)] == now.columns or name == "bpe"
        kept = Counter(map(str, after.select("doc_id", "text", "lang", "source").collect()))
        if name in ("quality", "near_dedup", "decontamination"):
            assert not kept - Counter(map(str, now.select("doc_id", "text", "lang", "source").collect()))
        else:
            assert after.count() == now.count()
        if name == "near_dedup":
            # texts without words are nobody's copies
            blank = "text IS NULL OR trim(replace(text, chr(10), ' ')) = ''"
            assert after.where(blank).count() == now.where(blank).count() > 0
        if name != "bpe":
            assert {tuple(r) for r in after.select(*ODD).collect()} == {("clash",) * len(ODD)}
        now = after
    assert now.where("NOT exact").count() == 0 and now.where("text IS NULL AND size(ids) > 0").count() == 0


def test_stages_on_empty_tables(spark, docs, no_docs, tmp_path):
    none = folder_of(spark, tmp_path / "none", no_docs, [], [])
    assert corpus_pipeline.run(spark, none).count() == 0
    # documents without labels and test items: nothing is rejected
    bare = folder_of(spark, tmp_path / "bare", docs, [], [])
    given = spark.read.parquet(f"{bare}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert name in ("near_dedup",) or stage(spark, given, bare).count() == given.count()
        assert stage(spark, given.limit(0), bare).count() == 0


def test_run_removes_what_it_no_longer_reads(spark, tmp_path, monkeypatch):
    from loomtok.llm import shared
    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path))
    assert corpus_pipeline.run(spark, SF).count() > 0
    left = sorted(str(p.relative_to(tmp_path)).split("/", 1) for p in tmp_path.glob("*/*"))
    assert {x[0].split("-")[0] for x in left} == {"pipeline"} and {x[1] for x in left} == {"bpe"}


def test_registered():
    names = __spark_entry__.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert {"op6_decontaminate", "op10_line_spread", "op11_hard_negatives", "op12_turn_repair", "op13_fingerprints"} <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", ["op6_decontaminate", "op10_line_spread", "op11_hard_negatives", "op12_turn_repair", "op13_fingerprints"])
def test_oracle(spark, name):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    found = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(found.columns)
    expected = con.execute(__spark_entry__.oracle_sql()[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(map(str, (tuple(r) for r in found.select(columns).collect()))) == sorted(str(tuple(r[i] for i in order)) for r in expected)


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES))
def test_each_query_has_its_rows(spark, name):
    out = queries.QUERIES[name](spark, SF)
    table = {"op5_page_text": "pages", "op9_neighbours": "embeddings", "op11_hard_negatives": "embeddings", "op12_turn_repair": "conversations"}.get(name, "documents")
    n = queries.read(spark, SF, table).count()
    if name == "op11_hard_negatives":
        n = out.dropDuplicates(["anchor_id", "positive_id", "rank"]).count()
        assert n > 0
    if name == "op12_turn_repair":
        n = queries.read(spark, SF, table).select("conv_id").distinct().count()
    if name == "op9_neighbours":
        n = queries.read(spark, SF, table).where(F.col("vec_id") % 20 == 0).count() * min(20, n - 1)
    assert out.count() == n
