"""Near duplicates against all pairs; components; signatures."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from loomtok.llm import dart_minhash
from loomtok.llm.components import components

from tests.llm.conftest import words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def classes(rows, least=0.8):
    """(id, smallest id of the class, size), None ids apart from the rest."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= least:
                root[find(i)] = find(j)
    own = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        own[find(i)].append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [k for k in own[find(i)] if k is not None]
        out.append((key, key if not sets[i] else min(keys, default=None), len(own[find(i)])))
    return out


def found(df):
    return [tuple(r) for r in dart_minhash.groups(df).select("doc_id", "class_id", "class_size").collect()]


def test_groups(docs, corpus):
    assert sorted(found(docs), key=str) == sorted(classes([r[:2] for r in corpus]), key=str)


def test_one_of_each_class_stays(docs, corpus):
    kept = dart_minhash.keep_first(docs.withColumns({"root": F.lit(1), "class_size": F.lit(2)}))
    assert kept.columns == [*docs.columns, "root", "class_size"]
    expected = classes([r[:2] for r in corpus])
    alone = sum(1 for (k, _, n), r in zip(expected, corpus) if not shingles(r[1]))
    n = len({c for (k, c, n), r in zip(expected, corpus) if shingles(r[1])})
    assert kept.count() == alone + n


def test_a_crowd_of_near_copies_in_several_components(spark, monkeypatch):
    """Random edits of one text: many pairs lie on either side of the
    threshold, so buckets stay open after the first comparison."""
    rng = random.Random(5)
    base = words(rng, 120)
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 2, 3, 5, 8])):
            w[at] = rng.choice(base) + "q"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(found(df)) == sorted(classes(rows))
    monkeypatch.setattr(dart_minhash, "BLOCK_BYTES", 20_000)
    assert sorted(found(df)) == sorted(classes(rows))


def test_by_shuffle(docs, corpus, monkeypatch):
    monkeypatch.setattr(dart_minhash, "MAX_BROADCAST", 0)
    assert sorted(found(docs), key=str) == sorted(classes([r[:2] for r in corpus]), key=str)


def test_clashing_columns_and_empty_tables(docs, no_docs):
    odd = docs.withColumns({"class_id": F.lit("x"), "first": F.lit(1), "band": F.lit(2), "sig": F.lit(3)})
    out = dart_minhash.groups(odd)
    assert out.columns == [*docs.columns, "band", "sig", "class_id", "class_size", "first"] and out.count() == odd.count()
    assert dart_minhash.groups(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(200, i) for i in range(201, 240)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    best = {n: n for p in pairs for n in p}
    for _ in range(60):
        for a, b in pairs:
            best[a] = best[b] = min(best[a], best[b])
    assert {n: roots.get(n, n) for n in best} == best
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(1)
    darts, k = dart_minhash.Darts(4000), 4000
    for n, shared in ((3, 1), (50, 30), (2000, 1500)):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 1 << 62, n - shared).astype(np.uint64)])
        b = np.concatenate([b, b[:1], b[:1]])  # weight 3
        h = np.concatenate([np.sort(a), np.sort(b)])
        x, y = darts.signatures(h, np.array([0, len(a), len(h)]))
        both = shared
        assert abs((x == y).mean() - both / (len(a) + len(b) - both)) < 0.04 and (x != 0).all() and k
