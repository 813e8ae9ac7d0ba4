"""Scalar text functions against Python's own string semantics."""
import re
import unicodedata

from pyspark.sql import functions as F

from loomtok.functions import text as T
from loomtok.functions.bytelevel import pretokenize, symbols_to_text, to_symbols

EDGE = ["", "   ", "x \x0b\x0c y\x85z\xa0\xa0w　q\x1c\x1d r", "a  b\n\n c\t d  ",
        "it's 'S we'll١٢ x²", "é\U0001F600 café", "é ﬁ Ａ"]


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_words_and_strip_match_python(spark):
    assert _one(spark, EDGE, T.word_count("t")) == [len(v.split()) for v in EDGE]
    assert _one(spark, EDGE, T.strip_ws("t")) == [v.strip() for v in EDGE]
    assert _one(spark, EDGE, T.has_non_ws("t")) == [bool(v.strip()) for v in EDGE]


def test_sizes_match_python(spark):
    assert _one(spark, EDGE, T.char_len("t")) == [len(v) for v in EDGE]
    assert _one(spark, EDGE, T.byte_len("t")) == [len(v.encode()) for v in EDGE]


def test_nfkc_matches_unicodedata(spark):
    assert _one(spark, EDGE, T.nfkc("t")) == [unicodedata.normalize("NFKC", v) for v in EDGE]


def test_pretokenize_fixture(spark):
    got = _one(spark, ["a  b\n\n c\t d  ", "it's 'S we'll١٢ x²"], pretokenize("t"))
    assert got[0] == ["a", " ", " b", "\n\n", " c", "\t", " d", "  "]
    assert got[1] == ["it", "'s", " '", "S", " we", "'ll", "١٢", " x", "²"]


def test_nbsp_run_is_whitespace(spark):
    got = _one(spark, ["a\xa0\xa0b"], pretokenize("t"))[0]
    # NBSP is whitespace under (?U); only U+0020 attaches to the next word
    assert got == ["a", "\xa0", "\xa0", "b"]


def test_byte_map_roundtrip_all_bytes(spark):
    text = bytes(range(256)).decode("latin-1")  # every code point 0..255
    sym = _one(spark, [text], to_symbols("t"))[0]
    assert len(sym) == len(text.encode("utf-8"))
    assert all(c.isprintable() and not c.isspace() for c in sym)
    assert _one(spark, [text], symbols_to_text(to_symbols("t")))[0] == text


def test_truncated_utf8_decodes_to_replacement(spark):
    # symbols of bytes F0 9F 98 (a cut 4-byte sequence)
    from loomtok.functions.bytelevel import byte_symbol
    cut = "".join(byte_symbol(b) for b in b"a\xf0\x9f\x98")
    assert _one(spark, [cut], symbols_to_text("t"))[0] == b"a\xf0\x9f\x98".decode("utf-8", "replace")


def test_lines_keep_newline(spark):
    vals = ["a\nb\n", "x", "\n\n", "p\nq"]
    got = _one(spark, vals, T.lines_keep_newline("t"))
    assert got == [v.splitlines(keepends=True) for v in vals]


def test_normalize_whitespace(spark):
    v = "  a[1][22] b\n\n\n\nc  \t d  "
    exp = "a b\n\nc d"
    assert _one(spark, [v], T.normalize_whitespace("t"))[0] == exp


def test_nfkc_fast_path_is_exact(spark):
    import unicodedata
    from loomtok.functions.text import nfkc_stable_pattern
    cps = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in cps], "t string")
    flagged = {r.t for r in df.where(F.col("t").rlike(nfkc_stable_pattern())).collect()}
    assert all(unicodedata.normalize("NFKC", c) == c for c in flagged)
    assert {"é", "ß", "ñ", "ü", "ç", "a"} <= flagged
    assert not ({"ﬁ", "²", "\xa0", "ĳ", "́"} & flagged)
    # a stable letter followed by a combining mark is not stable as a text
    assert df.sparkSession.createDataFrame([("é",)], "t string") \
        .where(F.col("t").rlike(nfkc_stable_pattern())).count() == 0


def test_nfkc_of_runs_equals_whole_texts(spark):
    """Runs at the borders, compositions with the letter before, Hangul,
    reordered marks, expansions, astral characters."""
    import random
    rng = random.Random(4)
    pool = list("ab z\u00e9\u00df\u0416\u03b1") + ["\u0301", "\u0323", "\u0327", "\ufb01", "\u00b2", "\u00bd", "\u1100", "\u1161", "\u11a8", "\uac00", "\u11a7",
                                       "\uff21", "\u3099", "\u304b", "\u212b", "\u1e9b", "\u0345", "\u0f71", "\u0f72", "\U0001d400", "\U0001f600", "\u4e2d", "\u2026", "\u2019", "\n", "\u0344"]
    texts = EDGE + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(3000)] + [None]
    assert _one(spark, texts, T.nfkc("t")) == [None if v is None else unicodedata.normalize("NFKC", v) for v in texts]


def test_whole_texts_do_not_go_through_python(spark):
    from conftest import SF001
    from loomtok.sources.tables import variants
    plan = variants(spark, SF001).select(T.nfkc("text").alias("x"))._jdf.queryExecution().executedPlan().toString()
    assert "_nfkc_runs(regexp_extract_all(" in plan and plan.count("ArrowEvalPython") == 1


def test_nfkc_search_looks_through_few_ranges():
    """The class of the search is tried on every character of a text."""
    assert T.unstable_run_pattern().count("-") <= 4
    run = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", T.unstable_run_pattern()))
    assert run.findall("plain \u00e9t\u00e9, \ufb01ne e\u0301 x") == [" \ufb01", "e\u0301"]
