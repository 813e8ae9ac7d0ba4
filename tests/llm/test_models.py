"""Quality classifier and language profiles."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from loomtok.llm import hdc_langid, nbsvm


def quality_rows(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(20, 120))]
        good = i % 4 > 0
        rows.append((i, " ".join(w) if good else "%%% ".join(w), int(good)))
    return rows


def test_quality(spark, docs, no_docs):
    rows = quality_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = frame.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 7), (9999, 1)], "doc_id long, quality int"))
    own = frame.drop("quality").withColumn("quality", F.lit("clash")).withColumn("score", F.lit("clash"))
    model = nbsvm.fit(own, labels, may_learn=F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scored = {r.doc_id: r.score for r in nbsvm.score(own, model).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((scored[i] >= 0.3) == bool(y) for i, y in held)
    others = nbsvm.score(docs, model)
    assert others.count() == docs.count() and others.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    blank = {r.score for r in others.where("text IS NULL OR trim(text) = ''").collect()}
    assert len(blank) == 1
    assert nbsvm.score(no_docs, model).count() == 0


def test_without_both_classes_nothing_is_learned(spark):
    frame = spark.createDataFrame([(1, "a b", 1), (2, "c d", 1)], "doc_id long, text string, quality int")
    for docs, labels in ((frame, frame), (frame, frame.limit(0)), (frame.limit(0), frame)):
        model = nbsvm.fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
        assert {r.score for r in nbsvm.score(frame, model).collect()} == {0.5}


def test_scores_by_hand(spark):
    """Each score from the features, weights and sigmoid by plain sums."""
    rows = quality_rows(60)
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = nbsvm.fit(frame.drop("quality"), frame.select("doc_id", "quality"))
    weight, scale = ({int(f): float(x) for f, x in zip(model.features, v)} for v in (model.weights, model.scale))
    one = nbsvm.Features()
    for r in nbsvm.score(frame, model).collect():
        data = np.frombuffer(r.text.encode(), np.uint8)
        found = set(one.of(data, np.array([0, len(data)]))[0].tolist())
        size = sum(scale.get(f, 0) for f in found) ** 0.5
        margin = sum(weight.get(f, 0) for f in found) / max(size, 1e-9) + model.constant
        assert abs(r.score - 1 / (1 + np.exp(-(model.slope * margin + model.shift)))) < 1e-6
    least = nbsvm.LEAST_TEXTS
    holders = {}
    for _, text, _ in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        for f in set(one.of(data, np.array([0, len(data)]))[0].tolist()):
            holders[f] = holders.get(f, 0) + 1
    assert sorted(f for f, n in holders.items() if n >= least) == model.features.tolist()


def test_coordinate_descent_reaches_the_optimum():
    """The dual's conditions: margin over 1 at multiplier 0, under 1 at its bound."""
    rng = np.random.default_rng(0)
    texts = [rng.choice(30, 6, replace=False) for _ in range(80)]
    y = np.where([1 if 3 in t or 4 in t else -1 for t in texts], 1, -1)
    y = np.array([1 if 3 in t or 4 in t else -1 for t in texts])
    values = [np.ones(6) for _ in texts]
    w, b = nbsvm.descend(texts, values, y, 30, rounds=2000)
    primal = 0.5 * (w @ w + b * b) + sum(max(0, 1 - y[i] * (w[t].sum() + b)) for i, t in enumerate(texts))
    for _ in range(200):  # no small step is better
        d, db = rng.normal(0, 0.01, 30), rng.normal(0, 0.01)
        v, c = w + d, b + db
        assert 0.5 * (v @ v + c * c) + sum(max(0, 1 - y[i] * (v[t].sum() + c)) for i, t in enumerate(texts)) > primal - 1e-3


def test_languages(spark, docs, no_docs):
    rng = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "hijklmno", "cc": "äöüßae"}
    rows = []
    for i in range(90):
        lang = list(letters)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(rng.randint(2, 60))).upper(), lang))
    rows += [(1000, None, "aa"), (1001, "12 !", "bb"), (1002, "hij", None), (1003, "", "cc")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    prototypes = hdc_langid.fit(frame, may_learn=F.col("doc_id") % 4 != 2)
    assert list(prototypes) == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in hdc_langid.predict(frame, prototypes).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows[:90])
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1003))
    assert all(0 <= r.score <= 1 for r in found.values())
    assert hdc_langid.predict(no_docs, prototypes).count() == 0
    assert {r.lang_pred for r in hdc_langid.predict(docs, {}).collect()} == {"und"}


def test_vectors_by_hand():
    """Bundles of bound, permuted letter vectors, whatever the slicing."""
    v = hdc_langid.Vectors(64)
    text = "Ab, ba"
    letter = lambda c: v.letter(ord(c) if c else 0).astype(int)
    expected = sum(np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in ((0, "a", "b"), ("a", "b", 0), (0, "b", "a"), ("b", "a", 0)))
    many = v.of(["x y", text, "", "日本", text])
    assert (many[1] == expected).all() and (many[4] == expected).all() and not many[2].any()
