"""Encoding, decoding, offsets and the two piece encoders."""
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from loomtok.operators import encode as E
from loomtok.operators.encode import decode_documents, encode_documents, token_totals


def _enc(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in encode_documents(df, model).collect()}


def test_special_tokens_split_and_dropped_on_decode(spark, toy_model):
    out = _enc(spark, toy_model, ["the <unk> was </s> end"])[0]
    assert out.ids[4] == 0 and out.tokens[4] == "<unk>" and out.ids[10] == 2
    dec = decode_documents(spark.createDataFrame([(0, out.ids)], "doc_id long, ids array<int>"), toy_model)
    assert dec.first().text == "the  was  end"
    keep = decode_documents(spark.createDataFrame([(0, out.ids)], "doc_id long, ids array<int>"), toy_model,
                            skip_special=False)
    assert keep.first().text == "the <unk> was </s> end"


def test_offsets_multibyte(spark, toy_model):
    out = _enc(spark, toy_model, ["é", "\U0001F600"])
    assert [(o.start, o.end) for o in out[0].offsets] == [(0, 1), (0, 1)]
    assert [(o.start, o.end) for o in out[1].offsets] == [(0, 1)] * 4


def test_merges_applied(spark, toy_model):
    out = _enc(spark, toy_model, ["aaaaaaa bcbc"])[0]
    assert out.tokens == ["aaaaaaa", "Ġ", "bcbc"]
    assert [(o.start, o.end) for o in out.offsets] == [(0, 7), (7, 8), (8, 12)]


def test_unknown_id_dropped_and_cut_utf8(spark, toy_model):
    ids = [_enc(spark, toy_model, ["é"])[0].ids[0], 99999]   # first byte of é only + unknown id
    dec = decode_documents(spark.createDataFrame([(0, ids)], "doc_id long, ids array<int>"), toy_model)
    assert dec.first().text == "�"


def test_empty_text_keeps_row(spark, toy_model):
    out = _enc(spark, toy_model, [""])[0]
    assert out.ids == [] and out.num_tokens == 0


def _lowest_rank_first(ids, merges):
    """One merge at a time, all of its occurrences from the left."""
    ranks = {(l, r): (k, n) for k, (l, r, n, _) in reversed(list(enumerate(merges)))}
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        if not found:
            return ids
        (_, new), i = min(found)
        ids = ids[:i] + [new] + ids[i + 2:]


def test_a_reused_id_is_encoded_by_rank(spark):
    """abcd is reached by two ways; the later merges use the first one's id."""
    from loomtok.operators.model import BpeModel
    m = BpeModel()
    i = {c: m.token_id(c) for c in "abcd"}
    for left, right in [x.split() for x in ("a b", "b c", "a bc", "abc d", "ab c")]:
        new, _ = m.add_token(left + right)
        m.merges.append((m.token_id(left), m.token_id(right), new, 1))
    out = _enc(spark, m, ["abcd", "abcdabc bcab"])
    for text, row in zip(["abcd", "abcdabc bcab"], out.values()):
        parts = ["abcd"] if " " not in text else ["abcdabc", " bcab"]
        expected = [x for p in parts for x in _lowest_rank_first([i.get(c, m.token_id("Ġ")) for c in p], m.merges)]
        assert row.ids == expected
    assert out[0].tokens == ["abcd"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", max_size=40), st.integers(0, 2 ** 30))
def test_heap_equals_one_merge_at_a_time(text, seed):
    import random

    from loomtok.operators.model import BpeModel
    rng, m = random.Random(seed), BpeModel()
    known = [m.token_id(c) for c in "abc"]
    for _ in range(12):
        a, b = rng.choice(known), rng.choice(known)
        if any(x[:2] == (a, b) for x in m.merges):
            continue
        new, _ = m.add_token(m.tokens[a] + m.tokens[b])
        known.append(new)
        m.merges.append((a, b, new, 1))
    assert E.Encoder(m).merged(text.encode()) == _lowest_rank_first([m.token_id(c) for c in text], m.merges)


def test_keys_may_be_null_repeated_or_composite(spark, toy_model):
    rows = [(1, 1, "ab cd"), (1, 1, "xyz"), (None, 2, "hello"), (1, 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, turn long, text string")
    one = encode_documents(df, toy_model).collect()
    two = encode_documents(df, toy_model, key=["doc_id", "turn"]).collect()
    texts = lambda out: sorted("".join(r.tokens) for r in out)
    assert texts(one) == texts(two) == ["", "abĠcd", "hello", "xyz"]
    assert {(r.doc_id, r.turn): r.num_chars for r in two}[None, 2] == 5
    dec = decode_documents(encode_documents(df, toy_model, key=["doc_id", "turn"]), toy_model, key=["doc_id", "turn"])
    assert sorted(r.text for r in dec.collect()) == ["", "ab cd", "hello", "xyz"]


def test_nothing_is_shuffled_or_cached(spark, toy_model):
    cached = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = cached()
    df = spark.createDataFrame([(0, "aaaaaaa bcbc aaa"), (1, "bcbc")], "doc_id long, text string")
    enc = encode_documents(df, toy_model)
    for out in (enc, decode_documents(enc, toy_model)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 2
    token_totals(df, toy_model, "text", ["doc_id"]).collect()
    assert cached() == before


def test_a_long_unbroken_run(spark, toy_model):
    out = _enc(spark, toy_model, ["a" * 300_000])[0]
    assert "".join(out.tokens) == "a" * 300_000 and out.offsets[-1].end == 300_000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40).filter(lambda s: "<" not in s), min_size=1, max_size=6))
def test_decode_encode_is_nfkc(spark, toy_model, texts):
    import unicodedata
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dec = {r.doc_id: r.text for r in decode_documents(encode_documents(df, toy_model), toy_model).collect()}
    assert dec == {i: unicodedata.normalize("NFKC", t) for i, t in enumerate(texts)}


def test_token_totals_equal_sum_of_encodings(spark, toy_model):
    texts = ["aaaaaaa bcbc", "x <s> aaa", "éé"]
    df = spark.createDataFrame([("g", t) for t in texts], "g string, text string")
    tot = token_totals(df, toy_model, "text", ["g"]).first().total_tokens
    enc = _enc(spark, toy_model, texts)
    assert tot == sum(v.num_tokens for v in enc.values())


def test_offsets_where_units_compose():
    """Hangul letters become one syllable; the text around keeps its places."""
    from loomtok.functions.text import nfkc_alignment
    starts, ends = nfkc_alignment("ab \u1100\u1161\u11a8 c \ufb01", [])
    assert starts == [0, 1, 2, 3, 6, 7, 8, 9, 9] and ends == [1, 2, 3, 6, 7, 8, 9, 10, 10]


def test_model_json(spark, toy_model):
    from loomtok.operators.model import BpeModel
    again = BpeModel.from_json(toy_model.to_json())
    assert again.tokens == toy_model.tokens and [m[:3] for m in again.merges] == [m[:3] for m in toy_model.merges]


def test_a_public_vocabulary_of_50k(spark):
    """All merges of a public byte-level file: ids equal the library's."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    from loomtok.operators.model import BpeModel
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = BpeModel.from_json(open(path, encoding="utf-8").read())
    lib = tokenizers.Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    enc = encode_documents(docs, model)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert model.vocab_size == 50256
    for r in enc.collect():
        assert r.ids == lib.encode(texts[r.doc_id], add_special_tokens=False).ids
    assert {r.doc_id: r.text for r in decode_documents(enc, model).collect()} == texts


def test_decoding_stays_in_the_jvm(spark, toy_model):
    df = spark.createDataFrame([(0, [1, 2])], "doc_id long, ids array<int>")
    for out in (E.add_tokens(df, toy_model), E.add_text(df, toy_model), decode_documents(df, toy_model)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_any_ids_decode_as_python_does(spark, toy_model):
    """Cut and overlong sequences, surrogates, unknown, negative and null ids."""
    import random

    from loomtok.functions.bytelevel import ALPHABET, ALPHABET_BYTE_ORDER
    raw_of = dict(zip(ALPHABET, ALPHABET_BYTE_ORDER))
    rng, n = random.Random(2), toy_model.vocab_size
    hard = [0x80, 0xBF, 0xC0, 0xC3, 0xE0, 0xE2, 0xED, 0xA0, 0xF0, 0x9F, 0x98, 0xF4, 0x90, 0xFF, 0x41]
    byte_id = {raw_of[t]: i for i, t in enumerate(toy_model.tokens) if len(t) == 1 and i >= 4}
    rows = [[byte_id[rng.choice(hard)] for _ in range(rng.randint(0, 7))] for _ in range(1500)]
    rows += [[rng.randint(-2, n + 2) if rng.random() < 0.95 else None for _ in range(rng.randint(0, 12))] for _ in range(300)] + [None, []]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")
    for skip in (True, False):
        low = 4 if skip else 0
        got = {r.doc_id: r.text for r in decode_documents(df, toy_model, skip_special=skip).collect()}
        for i, ids in enumerate(rows):
            known = None if ids is None else [x for x in ids if x is not None and low <= x < n]
            raw = None if known is None else b"".join(toy_model.tokens[x].encode() if x < 4 else bytes(raw_of[c] for c in toy_model.tokens[x]) for x in known)
            assert got[i] == (None if raw is None else raw.decode("utf-8", "replace")), (ids, raw)
    tokens = {r.doc_id: r.tokens for r in E.add_tokens(df, toy_model).collect()}
    for i, ids in enumerate(rows):
        assert tokens[i] == (None if ids is None else [toy_model.tokens[x] for x in ids if x is not None and 0 <= x < n])


def test_kept_pieces_are_bounded_and_change_nothing(toy_model, monkeypatch):
    """Pieces turn over in two generations; a text's encoding doesn't depend on what was met before."""
    texts = [f"aaaaaaa bcbc w{i} éﬁ{i % 7} <s>" for i in range(300)]
    fresh = [E.Encoder(toy_model).full(t) for t in texts]
    monkeypatch.setattr(E, "KEPT_PIECES", 40)
    encoder = E.Encoder(toy_model)
    for text, (ids, spans) in zip(texts, fresh):
        got = encoder.full(text)
        assert got[0].tolist() == ids.tolist() == encoder.ids(text).tolist() and got[1].tolist() == spans.tolist()
        assert len(encoder.kept) + len(encoder.older) <= 40
    assert encoder.kept["aaaaaaa"] and " bcbc" in encoder.kept


def test_latin_texts_are_cut_as_the_pattern_says():
    import random

    import regex

    from loomtok.functions.bytelevel import GPT2_SPLIT, piece_finder
    rng, find, whole = random.Random(5), piece_finder(), regex.compile(GPT2_SPLIT).findall
    often = "  \n\t'stmrelvd09a.\xa0\x85\x1c\x1f\xe9\xb2\u4e2d\u2019"
    texts = ["".join(rng.choice((chr(rng.randrange(256)), rng.choice(often))) for _ in range(rng.randint(0, 16))) for _ in range(5000)]
    assert [find(t) for t in texts] == [whole(t) for t in texts]


def test_token_stream_has_one_ratio_a_document(spark, toy_model):
    """Worked out below the step that makes rows of the tokens; the widths are
    those of the rule."""
    from loomtok.operators.serving import token_stream
    df = spark.createDataFrame([(1, "aaaaaaa bcbc \u00e9"), (2, None), (3, "a" * 40)], "doc_id long, text string")
    out = token_stream(encode_documents(df, toy_model))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38,0)" in plan.split("Generate")[1] and "decimal(38,0)" not in plan.split("Generate")[0]
    rows = out.collect()
    assert {r.doc_id for r in rows} == {1, 3}
    from pyspark.sql import functions as F
    spans = spark.range(1, 41).select(F.col("id").cast("int").alias("n"), F.round(F.least(F.lit(1.0) + F.lit(0.18) * F.col("id").cast("int"), F.lit(4.0)), 4).alias("w"))
    widths = {r.n: r.w for r in spans.collect()}
    assert all(r.width_scale == widths[r.char_span] == min(round(1 + 0.18 * r.char_span, 4), 4.0) for r in rows)
    assert [widths[n] for n in range(1, 41)] == [min(round(1 + 0.18 * n, 4), 4.0) for n in range(1, 41)]
