"""Exact BPE training: fixture corpora and batched == one-at-a-time."""
import random
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st

from loomtok.operators.train import TrainStats, train_bpe, train_on_texts


def _merge_strings(model):
    return [model.tokens[n] for _, _, n, _ in model.merges]


def test_fixture_order(toy_model):
    assert _merge_strings(toy_model) == ["aa", "bc", "aaaa", "bcbc", "aaa", "aaaaaaa"]


def test_newline_runs_never_learned(spark):
    m = train_on_texts(spark.createDataFrame([("ab\n\n\n\n",)] * 50, "text string"), 300)
    assert _merge_strings(m) == ["ab"]


def test_min_frequency(spark):
    df = spark.createDataFrame([("xy",), ("zw zw",)], "text string")
    assert _merge_strings(train_on_texts(df, 300)) == ["zw"]
    assert _merge_strings(train_on_texts(df, 300, min_frequency=3)) == []


def test_crlf_is_learnable(spark):
    m = train_on_texts(spark.createDataFrame([("a\r\n",)] * 3, "text string"), 300)
    assert "čĊ" in _merge_strings(m)


def test_small_vocab_keeps_alphabet(spark):
    m = train_on_texts(spark.createDataFrame([("hello",)], "text string"), 100)
    assert m.vocab_size == 260 and m.merges == []
    assert m.tokens[:4] == ["<unk>", "<s>", "</s>", "<pad>"]


def test_special_tokens_ordinary_in_training(spark):
    m = train_on_texts(spark.createDataFrame([("<unk><unk>",)] * 4, "text string"), 300)
    assert any("unk" in t for t in _merge_strings(m))


def reference_bpe(texts, vocab_size, min_frequency=2):
    """Plain one-merge-at-a-time greedy BPE on the same pieces (test oracle)."""
    import regex
    from loomtok.functions.bytelevel import ALPHABET, GPT2_SPLIT, byte_symbol
    specials = ["<unk>", "<s>", "</s>", "<pad>"]
    tokens = specials + list(ALPHABET)
    index = {t: i for i, t in enumerate(tokens)}
    counts = {}
    for t in texts:
        for line in t.splitlines(keepends=True):
            for p in regex.findall(GPT2_SPLIT, line):
                counts[p] = counts.get(p, 0) + 1
    words = [([index[byte_symbol(b)] for b in p.encode()], c) for p, c in counts.items()]
    merges = []
    while len(tokens) < vocab_size:
        pairs = {}
        for w, c in words:
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] = pairs.get((a, b), 0) + c
        best = sorted(((-f, a, b) for (a, b), f in pairs.items() if f >= min_frequency))
        if not best:
            break
        f, a, b = best[0]
        s = tokens[a] + tokens[b]
        n = index.get(s)
        if n is None:
            n = len(tokens)
            tokens.append(s)
            index[s] = n
        merges.append((a, b, n, -f))
        nw = []
        for w, c in words:
            out, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and w[i] == a and w[i + 1] == b:
                    out.append(n)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            nw.append((out, c))
        words = nw
    return merges


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abcab \n", min_size=1, max_size=30), min_size=1, max_size=12))
def test_batched_equals_sequential(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    m = train_on_texts(df, 260 + 15)
    assert m.merges == reference_bpe(texts, 260 + 15)


def test_batched_equals_sequential_on_documents(spark):
    from conftest import SF001
    rows = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(40).collect()
    texts = [r.text for r in rows]
    m = train_on_texts(spark.createDataFrame([(t,) for t in texts], "text string"), 260 + 40)
    assert m.merges == reference_bpe(texts, 260 + 40)


def test_pair_table_equals_a_recount(spark):
    """After each batch the corrected pair table is that of the new words,
    steps that were tried but not accepted among them."""
    from conftest import SF001
    from loomtok.operators.model import BpeModel
    from loomtok.operators.pieces import pair_counts, piece_counts, words_from_pieces
    from loomtok.operators.train import Guess, Tried, apply_merges, corpus_lines, packed, tried, unpacked, update_pairs
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(30)
    words = words_from_pieces(piece_counts(corpus_lines(docs), "line"), 4).persist()
    model, pairs, cut, blocks = BpeModel(), pair_counts(words), 0, packed(words).persist()
    assert sorted(map(tuple, unpacked(blocks).collect())) == sorted(map(tuple, words.select("cnt", "ids").collect()))
    guess = Guess([(r.ids, r.cnt) for r in words.orderBy(words.cnt.desc(), "ids").limit(40).collect()])
    for _ in range(4):
        top = [tuple(r) for r in pairs.orderBy(pairs.freq.desc(), "left_id", "right_id").limit(50).collect()]
        known, last = model.vocab_size, (-top[-1][2], *top[-1][:2])
        batch = guess.batch(top, model, 30, top[-1][2])
        changes = tried(blocks, batch, top, known)
        merges, steps, ids = Tried(batch, known, top, last, changes).accept(model, 10 ** 6)
        assert merges and merges[0][:2] == top[0][:2]
        cut += len(batch) - len(merges)
        guess.apply(merges)
        pairs = update_pairs(pairs, [(changes, ids, known, steps)]).persist()
        blocks = apply_merges(blocks, merges).persist()
        assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, pair_counts(unpacked(blocks)).collect()))
    assert cut > 0


@pytest.mark.parametrize("hints, top, batch", [(0, 20, 50), (3, 200, 64), (60, 4096, 512), (100_000, 4096, 512)])
def test_any_guess_gives_the_greedy_order(spark, hints, top, batch):
    """Few pieces to guess from, few ranked pairs: the same merges in more rounds."""
    from conftest import SF001
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(25).collect()]
    stats = TrainStats()
    m = train_on_texts(spark.createDataFrame([(t,) for t in texts], "text string"), 260 + 120, hint_pieces=hints, top=top, batch=batch, stats=stats)
    assert m.merges == reference_bpe(texts, 260 + 120)
    assert sum(stats.accepted) == 120 and min(stats.accepted) >= 1 and stats.rounds == len(stats.accepted)
    if hints == 100_000:
        assert stats.rounds <= 3


def test_long_runs_and_ids_used_again(spark):
    """Self pairs, nested repeats, strings that two merges make."""
    texts = ["aaaaaaaaaaaa aaaa aaa\n", "abcabcabc bcab abca abcd bcda\n", "abab baba ababab\n", "aabb abb aab\n"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for vocab in (260 + 5, 260 + 25, 260 + 200):
        m = train_on_texts(df, vocab)
        assert m.merges == reference_bpe(texts, vocab)


def test_2000_merges_equal_a_sequential_trainer(spark):
    """The public library, in its own order of merges, on the same lines."""
    tokenizers = pytest.importorskip("tokenizers")
    from conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    stats = TrainStats()
    m = train_on_texts(docs, 260 + 2000, stats=stats)
    lib = tokenizers.Tokenizer(tokenizers.models.BPE())
    lib.normalizer = tokenizers.normalizers.NFKC()
    lib.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    lines = [line for r in docs.collect() for line in r.text.splitlines(keepends=True)]
    lib.train_from_iterator(lines, tokenizers.trainers.BpeTrainer(
        vocab_size=260 + 2000, min_frequency=2, special_tokens=m.special_tokens, show_progress=False,
        initial_alphabet=tokenizers.pre_tokenizers.ByteLevel.alphabet()))
    import json
    found = json.loads(lib.to_str())["model"]
    assert [[m.tokens[a], m.tokens[b]] for a, b, _, _ in m.merges] == [list(x) for x in found["merges"]]
    assert {t: i for i, t in enumerate(m.tokens)} == found["vocab"]
    assert len(m.merges) == 2000 and stats.rounds < 60


def test_piece_counts_in_parts(spark, monkeypatch):
    """Counts are whole when a task hands its pieces on in parts; no row of the JVM's cutting is made."""
    from collections import Counter

    import regex

    from loomtok.functions.bytelevel import GPT2_SPLIT
    from loomtok.operators import pieces
    monkeypatch.setattr(pieces, "HELD_PIECES", 5)
    monkeypatch.setattr(pieces, "OUT_PIECES", 2)
    texts = ["a b a 12 ﬁne x\n", "a  b's\x1c 　\n", None, "", "a é <s> a\n"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "line string").coalesce(1)
    expected = Counter(p for t in texts if t for p in regex.findall(GPT2_SPLIT, unicodedata.normalize("NFKC", t)))
    found = pieces.piece_counts(df, "line")
    assert {r.piece: r.cnt for r in found.collect()} == expected
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
