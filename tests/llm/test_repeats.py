"""Exact repeats against brute force over all windows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtok.llm import cover_repeats, repeats, rlz_repeats


def brute(seqs, w):
    count = Counter(tuple(q[i:i + w]) for q in seqs for i in range(len(q) - w + 1))
    out = []
    for q in seqs:
        gone = [False] * len(q)
        for i in range(len(q) - w + 1):
            if count[tuple(q[i:i + w])] > 1:
                gone[i:i + w] = [True] * w
        out.append(gone)
    return out


def by_bytes(rows, w):
    seqs = [(t or "").encode() for t in rows]
    out = []
    for q, gone in zip(seqs, brute(seqs, w)):
        kept = bytes(c for c, g in zip(q, gone) if not g)
        out.append((len(q), sum(gone), len(re.findall("1+", "".join("01"[g] for g in gone))), kept))
    return out


def by_words(rows, w):
    seqs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in rows]
    return [(len(q), sum(gone), " ".join(c for c, g in zip(q, gone) if not g)) for q, gone in zip(seqs, brute(seqs, w))]


def cut_bytes(df, w):
    out = cover_repeats.remove(df, w).select("text", "n_bytes", cover_repeats.n_removed(), F.size("spans"), "kept").collect()
    return [(r[0], *r[1:4], bytes(r[4])) for r in out]


def same(found, texts, expected):
    key = lambda r: (r[0] is None, str(r))
    assert sorted(found, key=key) == sorted([(t, *e) for t, e in zip(texts, expected)], key=key)


@pytest.mark.parametrize("w", [400, 64, 7])
def test_bytes(docs, corpus, w):
    texts = [r[1] for r in corpus]
    same(cut_bytes(docs, w), texts, by_bytes(texts, w))


@pytest.mark.parametrize("w", [35, 5, 1])
def test_words(docs, corpus, w):
    texts = [r[1] for r in corpus]
    found = [tuple(r) for r in rlz_repeats.remove(docs, w).select("text", "n_words", "n_removed", "kept").collect()]
    same(found, texts, by_words(texts, w))


def test_random_overlaps(spark):
    rng = random.Random(11)
    parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(5, 60))) for _ in range(25)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    same(cut_bytes(df, 50), texts, by_bytes(texts, 50))
    found = [tuple(r) for r in rlz_repeats.remove(df, 6).select("text", "n_words", "n_removed", "kept").collect()]
    same(found, texts, by_words(texts, 6))


def test_crowded_anchors(docs, corpus, monkeypatch):
    """Windows of anchors with many contexts are grouped by fingerprint."""
    monkeypatch.setattr(repeats, "CROWD", 1)
    monkeypatch.setattr(repeats, "PIECE", 100)
    texts = [r[1] for r in corpus]
    same(cut_bytes(docs, 64), texts, by_bytes(texts, 64))
    found = [tuple(r) for r in rlz_repeats.remove(docs, 10).select("text", "n_words", "n_removed", "kept").collect()]
    same(found, texts, by_words(texts, 10))


@pytest.mark.parametrize("crowd", [10_000, 1])
def test_factors_have_sources(spark, docs, corpus, monkeypatch, crowd):
    """Each factor's words stand at its source too, another place; factors
    cover the windows that occur twice, no others, and none overlaps another."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    w = 10
    keys = {(r._k1, r._k2): re.findall(r"[^\x20\x09-\x0D]+", r._text) for r in repeats.texts_of(docs, "text").collect()}
    found = rlz_repeats.factors(docs, w).collect()
    count = Counter(tuple(q[i:i + w]) for q in keys.values() for i in range(len(q) - w + 1))
    covered, joined = {k: [] for k in keys}, 0
    for r in found:
        own, n = keys[r._k1, r._k2], r.n + w - 1
        other = keys[r.source._k1, r.source._k2]
        assert own[r.lo:r.lo + n] == other[r.source.lo:r.source.lo + n] and len(own[r.lo:r.lo + n]) == n
        assert (r._k1, r._k2, r.lo) != (r.source._k1, r.source._k2, r.source.lo)
        covered[r._k1, r._k2] += range(r.lo, r.lo + r.n)
        joined += r.n > w
    for k, q in keys.items():
        assert sorted(covered[k]) == [i for i in range(len(q) - w + 1) if count[tuple(q[i:i + w])] > 1]
    assert found and (crowd == 1 or joined > 0)


def test_the_longest_match_stands_next_in_the_index():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.integers(1, 12, 8)
        owner, h = np.repeat(np.arange(8), lengths), rng.integers(0, 3, lengths.sum()).astype(np.uint64)
        best, n = rlz_repeats.Index(owner, h).longest()
        ends = np.cumsum(lengths)

        def common(a, b):
            m = 0
            while a + m < ends[owner[a]] and b + m < ends[owner[b]] and h[a + m] == h[b + m]:
                m += 1
            return m
        for a in range(len(h)):
            assert n[a] == max(common(a, b) for b in range(len(h)) if b != a) and (n[a] == 0 or common(a, int(best[a])) == n[a])


def test_planted_passages(spark):
    """Passages of over 50 words in two texts each: those of 400 bytes go from
    both, whole and nothing beside them, shorter ones and clean texts stay."""
    rng = random.Random(29)
    some = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passages = [some(n) for n in range(51, 101)]
    texts = {some(150): (0, None) for _ in range(20)}
    for p in [*passages, some(100)[:400], some(100)[:399]]:
        for a, b in ("()", "[]"):
            head, tail = some(40) + a, b + some(40)
            texts[head + p + tail] = (len(p), (head + tail).encode()) if len(p) >= 400 else (0, None)
    assert 15 < sum(len(p) >= 400 for p in passages) < 40
    found = cut_bytes(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), 400)
    assert {t: (n, spans, kept) for t, _, n, spans, kept in found} == {t: (n, int(n > 0), kept or t.encode()) for t, (n, kept) in texts.items()}


def test_by_shuffle(docs, corpus, monkeypatch):
    """Tables too large to broadcast are joined by shuffle."""
    monkeypatch.setattr(repeats, "MAX_BYTES", 0)
    texts = [r[1] for r in corpus]
    same(cut_bytes(docs, 400), texts, by_bytes(texts, 400))


def test_clashing_columns_and_empty_tables(docs, no_docs):
    odd = docs.limit(4).withColumns({"kept": F.lit(1), "spans": F.lit(2), "hits": F.lit(3), "n_words": F.lit(4), "place": F.lit(5), "g": F.lit(6)})
    out = cover_repeats.remove(odd)
    assert out.columns[-3:] == ["n_bytes", "spans", "kept"] and {r.hits for r in out.collect()} == {3}
    assert {r.place for r in rlz_repeats.remove(odd).collect()} == {5}
    assert cover_repeats.remove(no_docs).count() == 0 and rlz_repeats.remove(no_docs).count() == 0


def test_covers():
    for length in (400, 64, 7, 2, 1):
        v, d = cover_repeats.cover_for(length)
        assert {int(a - b) % v for a in d for b in d} == set(range(v)) and v <= length


def test_least_in():
    x = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    for w in (1, 2, 7, 299, 300):
        assert repeats.least_in(x, w).tolist() == [x[i:i + w].min() for i in range(300 - w + 1)]


def test_a_frequent_fingerprint_does_not_fill_its_bucket(spark):
    def sample(data, offs):
        n = len(offs) - 1  # one fingerprint in every text, one of its own
        own = data[offs[:-1]].astype(np.uint64) << np.uint64(56) | data[offs[:-1] + 1].astype(np.uint64)
        h = np.stack([np.full(n, 7 << 60, np.uint64), own], axis=1).ravel()
        return h, np.repeat(np.arange(n), 2), np.tile([0, 1], n)

    texts = spark.createDataFrame([(chr(33 + i // 90) + chr(33 + i % 90) + "text",) for i in range(4000)], "text string").repartition(8)
    texts = repeats.texts_of(texts, "text")
    hot = repeats.dealt_out(texts, sample, 6).where(F.col("bucket") == 7 << 2).select("h").collect()
    assert sum(np.count_nonzero(np.frombuffer(r.h, np.uint64) == 7 << 60) for r in hot) <= 8
    found = repeats.ties(texts, sample, 0.1).collect()
    assert len(found) == 4000 and all(r.places == [0] for r in found)
