"""Byte-level BPE, decontamination, line spread, page text, neighbours."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomtok.llm import bpe_prefix, decontaminate, kmeans_tree, line_spread, page_text

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="session")
def ranks():
    return bpe_prefix.Ranks(bpe_prefix.load_ranks(PATH))


@pytest.fixture(scope="session")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(bpe_prefix.load_ranks(PATH))})


def test_bpe(spark, docs, corpus, library, no_docs):
    more = ["two  spaces " * 40, "a  b", " lead", "trail ", "x  y", "tab\t z", "it's we'll 'S", "😀 é‍", "\x1c \x1d a", "a \n b", "<|endoftext|>", "\x00 a"]
    frame = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    frame = frame.withColumns({"ids": F.lit("clash"), "decoded": F.lit("clash")})
    both = bpe_prefix.decode(bpe_prefix.encode(frame, PATH, public_tokenizers.PATTERN), PATH)
    rows = both.select("text", "ids", "decoded", *bpe_prefix.digests(both)).collect()
    assert len(rows) == len(corpus) + len(more)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        assert r.ids == ids and bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe_prefix.decode(bpe_prefix.encode(no_docs, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_any_bytes_appends_and_edits(ranks, library):
    rng = random.Random(6)
    one = library._core_bpe.encode_single_piece
    for alphabet in (b"abcdeth ing", bytes(range(256)), b"a"):
        for _ in range(150):
            raw = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
            table = bpe_prefix.PrefixTable(ranks, raw)
            assert table.ids() == one(raw)
            more = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 9)))
            assert table.append(more).ids() == one(raw + more)
            a = rng.randint(0, len(raw))
            b = rng.randint(a, len(raw))
            if edited := raw[:a] + more + raw[b:] + more:
                assert table.replace(a, b, more).ids() == one(edited)
            assert table.become(raw).ids() == one(raw)


def test_white_space_of_all_kinds(spark, library):
    """Words are cut beside ASCII and wide white space as the pattern asks."""
    rng = random.Random(12)
    spaces = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2000", "\u200a", "\u200b", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\u180e"]
    words = ["a", "word", "é", "it's", "Å", "\u2026", "“q”", "日", "😀", "x1", "9", "©", "‰", "\u0085b"]
    texts = ["".join(rng.choice([rng.choice(spaces), " ", " "]) + rng.choice(words) for _ in range(rng.randint(1, 12))) + rng.choice(["", " ", "\u3000"]) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert all(r.ids == library.encode_ordinary(r.text) for r in bpe_prefix.encode(frame, PATH, public_tokenizers.PATTERN).collect())


def test_a_small_cache_gives_the_same_ids(spark, docs, library, monkeypatch):
    monkeypatch.setattr(bpe_prefix, "KEPT_WORDS", 40)
    monkeypatch.setattr(bpe_prefix, "KEPT_STEPS", 50)
    monkeypatch.setattr(bpe_prefix, "row_slices", lambda offs, _: ((i, i + 1) for i in range(len(offs) - 1)))
    rows = bpe_prefix.encode(docs, PATH, public_tokenizers.PATTERN).select("text", "ids").collect()
    assert all(r.ids == library.encode_ordinary(r.text or "") for r in rows)


def decontaminated(texts, items, n=10):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = defaultdict(set)
    for item, text in items:
        w = low(text)
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[i:i + m])].add("" if item is None else str(item))
    out = []
    for t in texts:
        w, hit, found = low(t), set(), set()
        for m in {len(g) for g in grams}:
            for i in range(len(w) - m + 1):
                if g := grams.get(tuple(w[i:i + m])):
                    found |= g
                    hit |= set(range(i, i + m))
        out.append((t, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_decontamination(spark, docs, corpus, no_docs, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    w = corpus[8][1].split()
    items = [(1, " ".join(w[5:30])), (2, " ".join(w[20:32]).upper() + "!"), (3, "Ééé, ÜBER"), (3, "über straße"), (4, " ".join(corpus[5][1].split()[:10])),
             (5, corpus[3][1]), (6, ""), (7, None), (None, corpus[2][1]), (10, " ".join(w[5:30])), (11, "never there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    odd = docs.withColumns({"n_words": F.lit("clash"), "items": F.lit("clash"), "h": F.lit(1)})
    scanned = decontaminate.scan(odd, bench)
    found = [(r.text, r.n_words, r.n, r["items"]) for r in scanned.select("text", "n_words", decontaminate.n_hit().alias("n"), "items").collect()]
    assert sorted(found, key=str) == sorted(decontaminated([r[1] for r in corpus], items), key=str)
    assert any(n for _, _, n, _ in found)
    clean = decontaminate.remove(scanned)
    assert clean.count() == sum(not n for _, _, n, _ in found)
    cut = decontaminate.remove(scanned, spans=True)
    again = decontaminate.scan(cut, bench.where("item_id IN (1, 2, 10)"))
    assert again.where(F.size("hits") > 0).count() == 0
    left = {r.text for r in cut.where("doc_id = 8").collect()}
    assert left == {" ".join(w[:5]) + "  " + " ".join(w[32:])}
    assert decontaminate.scan(no_docs, bench).count() == 0
    assert decontaminate.scan(docs, bench.limit(0)).where(F.size("hits") > 0).count() == 0


def test_line_spread(spark, no_docs):
    rows = []
    for i in range(40):
        lines = ["own text of document %d that is long enough to be most of it all" % i, " on all sites ", "on twelve", ""]
        if i % 20 < 10:
            lines[2] = "on ten"
        if i % 20 < 9:
            lines.append("on nine")
        rows.append((i, "\n".join(lines), f"s{i % 20}"))
    rows += [(50, None, "s1"), (51, "", "s2"), (52, " on all sites ", "s3"), (53, "on all sites\nx", None), (None, rows[0][1], "s0"), rows[0], (54, rows[1][1], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"n_lines": F.lit("clash"), "_h": F.lit(1)})
    out = line_spread.remove_lines(frame, min_sites=10)
    sites = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if s is not None and line.strip(" "):
                sites[line.strip(" ")].add(s)
    expected = []
    for k, t, _ in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if len(sites[x.strip(" ")]) < 10 or not x.strip(" ")]
        expected.append((k, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    assert sorted((tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str) == sorted(expected, key=str)
    assert (52, "", 1, 1) in expected and (53, "x", 2, 1) in expected and max(n for *_, n in expected) > 1 and out.columns == ["doc_id", "text", "source", "_h", "n_lines", "n_removed"]
    assert line_spread.remove_lines(no_docs).count() == 0


PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>home</a></nav><article><h1>Head &amp; more</h1><p>One  two\n three <b>four"
     "<p>five six&nbsp;seven</p><div class='ad'>buy now</div><p>eight</article><div class=comments><p>I like it</div><footer>&copy; me</footer>",
     "Head & more\n\nOne two three four\n\nfive six seven\n\neight"),
    ("<body><header>Site</header><main><p>all of it<br>here &lt;ok&gt; &am &amp", "all of it here <ok> &am &"),
    ("<article><ul><li>a<li>b</ul><script>var x='</p><p>no';</script><!-- <p>no</p> --><form><p>no</p></form><p>c <em>d</em>e</p></article>", "a\n\nb\n\nc de"),
    ("<article><img alt=It's src=x><p>don't <a href='a>b'>go</a> it's</p><p title=\"unclosed>kept</p></article>", "don't go it's\n\nkept"),
    ("<article><p>x <!-- open <p>no</p></article>", "x"), ("<article><p>1 < 2 <3 <b</article>", "1 < 2 <3"),
    ("", ""), (None, ""), ("   ", ""), ("<nav>only</nav>", ""), ("<article></article>", ""),
]


def test_page_text(spark):
    many = [(i, "u", h) for i, (h, _) in enumerate(PAGES * 30)] + [(1000, "u", "<p>" + "long words " * 30000)]
    frame = spark.createDataFrame(many, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    weights = page_text.fit(frame)
    out = {r.page_id: r.text for r in page_text.extract(frame, weights).collect()}
    assert [out[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert out[1000] == ("long words " * 30000).strip()
    end = "eight and some more words at the end of the story"
    unmarked = PAGES[0][0].replace("<article>", "<div class=story>").replace("eight</article>", end + "</div>")
    assert page_text.main_text(unmarked, weights) == PAGES[0][1].replace("eight", end)
    assert page_text.fit(frame.limit(0)) == {} and page_text.extract(frame.limit(0), {}).count() == 0
    assert page_text.main_text("<div><a>x</a><p>" + "plain words here " * 9 + "</p></div>", {}).startswith("plain words")


def test_page_text_weighs_every_frequent_feature(spark):
    n = page_text.LEAST_TOKENS
    page = "<article><p>words of the story</p></article>" + "".join(f"<x-{i} />" * (n if i < 5200 else n - 1) for i in range(5201))
    weights = page_text.fit(spark.createDataFrame([(1, page)], "page_id long, html string"))
    assert {f"tag out x-{i}" for i in range(5200)} <= weights.keys() and "tag out x-5200" not in weights


def test_best_region_is_the_maximum():
    rng = random.Random(8)
    for _ in range(40):
        page = "".join(rng.choice(["<p>", "<i>", "</i>", "some words ", "one ", "<div>", "</div>"]) for _ in range(30))
        found = [page_text.weight({}, t[0], t[1], t[2], t[4]) for t in page_text.tokens(page)]
        best = max([0.0] + [sum(found[a:b]) for a in range(len(found)) for b in range(a + 1, len(found) + 1)])
        assert (best == 0) == (page_text.main_text(page, {}) == "")


def test_the_region_is_the_one_of_the_largest_sum():
    """Against all regions, and the text is that region's."""
    rng = random.Random(9)
    for _ in range(60):
        parts = [rng.choice(["<p>", "<i>", "</i>", f"some{i} words{i} ", f"one{i} ", "<div>", "</div>", "<br>"]) for i in range(30)]
        page = "".join(parts)
        found = list(page_text.tokens(page))
        w = [page_text.weight({}, t[0], t[1], t[2], t[4]) for t in found]
        a, b = page_text.best_region(w)
        sums = {(i, j): sum(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        best = max([0.0, *sums.values()])
        assert sum(w[a:b]) == pytest.approx(best)
        words = [x for t in found[a:b] if t[0] == "text" for x in t[1].split()]
        assert page_text.main_text(page, {}).split() == words


def test_pages_of_many_elements_take_time_in_proportion():
    import time
    for page in ("<div>" * 100_000 + "text", "<div><i>" * 50_000 + "x" + "</i>" * 50_000, "<article>" + "<div class=sidebar>" * 50_000 + "<article>t",
                 "<svg>" * 100_000 + "<p>words here", "<p><b>" * 60_000, "<a class=menu>" * 60_000 + "</b>" * 60_000, "<li>" * 100_000 + "x", "<ul><li>" * 50_000):
        t0 = time.perf_counter()
        page_text.main_text(page, {})
        assert time.perf_counter() - t0 < 6, page[:30]


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "PART_ROWS", 300)
    monkeypatch.setattr(kmeans_tree, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, (1500, 12)), np.tile(rng.normal(0, 1, (1, 12)), (400, 1))])
    rows = [(i, x.tolist()) for i, x in enumerate(v.tolist() and v)]
    odd = [(3000, None), (3020, [0.0] * 12), (3040, [1.0, None] + [1.0] * 10), (3060, [float("nan")] * 12), (3080, [float("inf")] * 12),
           (None, [1.0] * 12), (3100, [1.0] * 5), (3120, []), rows[20], rows[1600]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "score": F.lit(1), "id": F.lit(1)})
    out = kmeans_tree.search(frame, F.col("vec_id") % 20 == 0, k=20).toPandas()
    hit = total = 0
    for q, own in out.groupby("query_id"):
        own = own.sort_values("rank")
        s = v @ v[q]
        s = (v * v[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(v)), -s)) if i != q][:20]
        hit += len(set(order) & set(own.vec_id))
        total += 20
        assert own["rank"].tolist() == list(range(1, 21)) and own.vec_id.is_unique
        assert np.allclose(own.score, s[own.vec_id], atol=1e-12)
        if q >= 1500:  # a crowd of equal vectors: ties go by id
            assert own.vec_id.tolist() == order
    assert len(out.query_id.unique()) == 95 and hit / total >= 0.9
    few = kmeans_tree.search(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=20).collect()
    assert len(few) == 4
    assert kmeans_tree.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_beyond_leaves_with_few_rows(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "calibrate", lambda *_: 1)
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(0, 0.01, (600, 6)) + np.eye(6)[rng.integers(0, 6, 600)], 50 * np.eye(6)[:3]])
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(602, (40 * np.eye(6)[2]).tolist())] * 30
    out = kmeans_tree.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") >= 600, k=20).toPandas()
    assert sorted(out.query_id.unique()) == [600, 601, 602]
    for q, own in out.groupby("query_id"):
        assert own["rank"].tolist() == list(range(1, 21)) and q not in set(own.vec_id)
