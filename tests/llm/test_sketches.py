"""Scaled sketches and hard negatives against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtok.llm import negatives, ordered, queries, scaled_sketch


def sketch(text, scale=scaled_sketch.SCALE):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    h = {hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:16] for i in range(max(len(w) - 4, min(len(w), 1)))}
    return sorted(x for x in h if int(x, 16) < 2 ** 64 // scale) or sorted(h)[:1]


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_sketches(spark, docs, corpus, no_docs):
    odd = docs.withColumn("sketch", F.lit("clash")).withColumn("_h", F.lit(1))
    got = scaled_sketch.add_sketch(odd)
    assert got.columns == [*docs.columns, "_h", "sketch"]
    assert sorted((str(r.doc_id), r.text or "", r.sketch) for r in got.collect()) == sorted((str(r[0]), r[1] or "", sketch(r[1])) for r in corpus)
    assert scaled_sketch.add_sketch(no_docs).count() == 0
    coarse = scaled_sketch.add_sketch(docs).select("text", scaled_sketch.coarser(F.col("sketch"), 32).alias("s")).collect()
    assert all(r.s == sketch(r.text, 32) for r in coarse)
    assert all(r.s == sketch(r.text, 1) for r in docs.select("text", scaled_sketch.sketch(F.col("text"), 1).alias("s")).collect())


def test_merged_sketches_tell_containment(spark, docs, corpus):
    own = scaled_sketch.add_sketch(docs)
    got = {}
    for r in scaled_sketch.merged(own, "lang").collect():
        got.setdefault(r.lang, []).append(r.hash)
    expected = {lang: set().union(*(sketch(r[1]) for r in corpus if r[2] == lang)) for lang in ("en", None)}
    low = {lang: sorted(x for x in h if x < scaled_sketch.threshold(4)) for lang, h in expected.items()}
    assert {lang: sorted(h) for lang, h in got.items()} == low
    few = scaled_sketch.merged(scaled_sketch.add_sketch(spark.createDataFrame([(1, "a"), (1, "b c"), (1, "c")], "g long, text string"), scale=1 << 40), "g", scale=1 << 40)
    assert [r.hash for r in few.collect()] == [min(sketch(t, 1 << 40)[0] for t in ("a", "b c", "c"))]
    rest = scaled_sketch.merged(own.where("doc_id % 2 = 0"))
    held = {r.hash for r in rest.collect()}
    share = {(r.doc_id, r.contained) for r in scaled_sketch.contained(own.where("doc_id IS NOT NULL"), rest, "doc_id").collect()}
    assert share == {(i, sum(x in held for x in sketch(t)) / len(sketch(t)) if sketch(t) else 1.0) for i, t, *_ in corpus if i is not None}
    # a short text inside a long one, seen from either side
    long, short = corpus[9][1], " ".join(corpus[9][1].split()[100:400])
    row = spark.createDataFrame([(long, short)], "a string, b string").select(scaled_sketch.sketch(F.col("a")).alias("a"), scaled_sketch.sketch(F.col("b")).alias("b"))
    inside, outside = row.select(scaled_sketch.containment(F.col("b"), F.col("a")), scaled_sketch.containment(F.col("a"), F.col("b"))).first()
    assert inside == 1.0 and 0.25 < outside < 0.6


@pytest.mark.parametrize("size", [1024, 4])
def test_fingerprints(spark, corpus, tmp_path, monkeypatch, size):
    """Edited texts and neighbours over range borders, in a loop."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", size)
    rows = [(r[0], r[1], "x") for r in corpus]
    spark.createDataFrame(rows, "doc_id long, text string, sketch string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op13_fingerprints(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    nulls = [t or "" for i, t, _ in rows if i is None]
    for start in (nulls, nulls[::-1]):  # rows of one key have one order, either
        order = [(None, t) for t in start] + sorted(((i, t or "") for i, t, _ in rows if i is not None), key=key)
        expected = []
        for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
            n = len(t) // 4
            e = t[:len(t) - n] + following[:n]
            expected.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), ",".join(sketch(t)), ",".join(sketch(e)),
                             alike(sketch(t), sketch(e)), alike(sketch(t), sketch(following))))
        if sorted(map(str, got)) == sorted(map(str, expected)):
            break
    else:
        raise AssertionError("neither order of the rows without key")
    prints = {}
    for r in got:
        prints.setdefault(r[3], set()).add(r[0])
    assert {6, 10, 11} <= prints[",".join(sketch(corpus[6][1]))]
    alone = tmp_path / "one"
    spark.createDataFrame(rows[4:5], "doc_id long, text string, sketch string").write.parquet(str(alone / "documents.parquet"))
    assert queries.op13_fingerprints(spark, str(alone)).first().near_next == 1.0
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op13_fingerprints(spark, str(tmp_path / "none")).count() == 0


def test_the_main_path_has_no_python(spark, docs):
    plan = scaled_sketch.add_sketch(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


@pytest.mark.parametrize("size", [1024, 7])
def test_ranges_and_guests(spark, monkeypatch, size):
    monkeypatch.setattr(ordered, "RANGE_ROWS", size)
    values = [None, -(1 << 63), -5, 0, 3, 3, 3, (1 << 63) - 1, *range(10, 90)]
    frame = spark.createDataFrame([(v,) for v in values], "v long").withColumn("key", F.concat(ordered.long_key(F.col("v")), ordered.hash_key(F.lit(1))))
    rows = ordered.with_next(frame, "key").withColumn("next", F.lead("v").over(Window.partitionBy("_range").orderBy("_guest", "key")))
    got = [(r.v, r.next) for r in rows.where(~F.col("_guest")).collect()]
    low = lambda v: (v is not None, v or 0)
    order = sorted(values, key=low)
    assert sorted(got, key=str) == sorted(zip(order, order[1:] + order[:1]), key=str)


def mined(rows, is_anchor, k, least):
    def score(a, b):
        return sum(int(np.floor(256 * float(x))) * int(np.floor(256 * float(y))) for x, y in zip(a, b))
    def first(found):
        return sorted(found, key=lambda x: (-x[1], x[0]))[:k]
    out = []
    for i, v, label in rows:
        if is_anchor(i):
            near = [(j, score(v, w), other) for j, w, other in rows if j != i and len(w) == len(v)]
            for p, ps in first([(j, s) for j, s, other in near if other == label]):
                fits = first([(j, s) for j, s, other in near if other != label and least * ps <= 100 * s <= 100 * ps])
                out += [(i, p, r + 1, j, ps, s) for r, (j, s) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PART_ROWS", 60)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 0.3, (3, 24))
    rows = [(i, (centres[i % 3] + rng.normal(0, 0.2, 24)).tolist(), 0 if i % 3 == 0 else i % 4) for i in range(260)]
    rows += [(i, rows[9][1], i % 2) for i in range(300, 340)]  # a crowd of equal vectors
    rows += [(400 + i, rng.normal(0, 1, 5).tolist(), i % 2) for i in range(12)] + [(500, [], 0), (501, [], 0), (502, [], 1)]
    rows += [(600, [3e5] * 24, 0), (601, [2e5] * 24, 1), (602, [2.5e5] * 24, 0), (-100, rows[0][1], 0)]
    odd = [(700, None, 1), (None, [0.1] * 24, 1), (720, [0.1] * 24, None), (740, [None] + [0.1] * 23, 1), (760, [float("nan")] * 24, 1),
           (780, [float("inf")] * 24, 1), (800, [1e300] * 24, 1), rows[20]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("clash"), "part": F.lit(1), "rank": F.lit(2)})
    out = negatives.mine(frame, F.col("vec_id") % 20 == 0, k=5, least=80)
    got = sorted(map(tuple, out.collect()))
    expected = mined(rows, lambda i: i % 20 == 0, 5, 80)
    assert got == expected and len({r[0] for r in got}) > 10 and any(r[0] == 600 for r in got) and any(r[0] == 500 for r in got)
    assert negatives.mine(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert negatives.mine(frame, F.lit(False)).count() == 0
    alone = frame.where("vec_id = 20")
    assert negatives.mine(alone, F.lit(True)).count() == 0


def test_bounds_hold_and_the_narrowest_level_follows_from_the_summaries():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    for width in (1, 5, 16, 64, 70):
        q = rng.integers(-300, 300, (40, width))
        mean, off = negatives.summaries(q.astype(float))
        rows = negatives.Vectors(pa.table({"id": np.arange(40), "label": ["x"] * 40, "q": q.tolist(), "mean": mean.tolist(), "off": off.tolist()}))
        exact = rows.whole @ rows.whole.T
        at, widths = np.arange(40), []
        for level in range(len(rows.levels)):
            low, high = (np.array(x) for x in zip(*(rows.bounds(level, at, rows, j) for j in range(40))))
            assert (low <= exact).all() and (exact <= high).all()
            widths.append((high - low).mean())
        assert widths == sorted(widths, reverse=True)
        whole = rows.levels[0]
        assert np.allclose(whole[1][:, 0], rows.whole.mean(axis=1)) and np.allclose(whole[2][:, 0] ** 2, ((rows.whole - rows.whole.mean(axis=1)[:, None]) ** 2).sum(axis=1))
