"""Scalar text functions on Spark Columns.

Everything here is a built-in expression except :func:`nfkc`, which has no
JVM equivalent: the runs of characters that it may change, and only they, go
through an Arrow UDF.
"""

from __future__ import annotations

import functools
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# The characters Python's str.isspace() accepts, i.e. the
# whitespace used by str.split() and str.strip(), written as regex escapes
# valid in both Java and RE2.
WS = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS_CLASS = "[" + WS + "]"
NON_WS_CLASS = "[^" + WS + "]"

#: Rows whose values are Python objects at the same time.
SLICE_ROWS = 64
NFKC_RUN_LIMIT, WIDE_RANGE = 0x0140, 20
NFKC_SCAN_LIMIT = 0x0530   # Latin, Greek and Cyrillic: few ranges, cheap per character


@functools.lru_cache(maxsize=1)
def _stable_ranges() -> list[tuple[int, int]]:
    """Ranges of code points that can never change under NFKC, derived
    from the Unicode database: c is NFKC-invariant, a starter (combining
    class 0) and never the second element of a canonical composition."""
    seconds = set()
    for cp in range(0x110000):
        d = unicodedata.decomposition(chr(cp))
        if d and not d.startswith("<"):
            parts = d.split()
            if len(parts) == 2:
                seconds.add(int(parts[1], 16))
    safe = [cp for cp in range(NFKC_SCAN_LIMIT)
            if not (0xD800 <= cp <= 0xDFFF) and cp not in seconds
            and unicodedata.combining(chr(cp)) == 0
            and unicodedata.normalize("NFKC", chr(cp)) == chr(cp)]
    runs, start, prev = [], safe[0], safe[0]
    for cp in safe[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        runs.append((start, prev))
        if cp is not None:
            start = prev = cp
    return runs


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in ranges)


def nfkc_stable_pattern() -> str:
    """A text made only of stable characters is NFKC-stable."""
    return f"^[{_class(_stable_ranges())}]*$"


def unstable_run_pattern() -> str:
    """Runs of characters that NFKC may change, with the stable one before
    them, which they may compose with.  A stable character never changes and
    never composes with what is before it, so each run is normalized by
    itself and what is between the runs stays.  Only the wide ranges below
    ``NFKC_RUN_LIMIT`` count as stable: with five more ranges the search takes
    ten times as long."""
    inside = _class([(a, b) for a, b in _stable_ranges() if b < NFKC_RUN_LIMIT and b - a >= WIDE_RANGE])
    return f"[{inside}]?[^{inside}]++"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()``: drop leading and trailing Python whitespace."""
    return F.regexp_replace(col(c), F.lit(f"^{WS_CLASS}+|{WS_CLASS}+$"), F.lit(""))


def lstrip_ws(c) -> Column:
    return F.regexp_replace(col(c), F.lit(f"^{WS_CLASS}+"), F.lit(""))


def has_non_ws(c) -> Column:
    """``bool(s.strip())`` for a non-null string."""
    return col(c).rlike(NON_WS_CLASS)


def word_count(c) -> Column:
    """``len(s.split())``."""
    return F.regexp_count(col(c), F.lit(NON_WS_CLASS + "+"))


def char_len(c) -> Column:
    """``len(s)`` in code points."""
    return F.length(col(c))


def byte_len(c) -> Column:
    """``len(s.encode('utf-8'))``."""
    return F.octet_length(col(c))


def lines_keep_newline(c) -> Column:
    """Lines of a text with their ``\\n`` kept (the file-reading rule of the
    trainer); a last line without newline is kept as is."""
    return F.regexp_extract_all(col(c), F.lit(r"[^\n]*\n|[^\n]+"), 0)


def normalize_whitespace(c) -> Column:
    """Citation markers out, blank-line runs to one blank line, space/tab
    runs to one space, then strip — in that order."""
    x = F.regexp_replace(col(c), F.lit(r"\[\p{Nd}+\]"), F.lit(""))
    x = F.regexp_replace(x, F.lit(r"\n{3,}"), F.lit("\n\n"))
    x = F.regexp_replace(x, F.lit(r"[ \t]{2,}"), F.lit(" "))
    return strip_ws(x)


def by_slices(one, kind: T.DataType = T.StringType()):
    """An Arrow UDF of ``one`` over values that aren't null, ``SLICE_ROWS`` at
    a time: a task holds a batch, its result and the Python objects of a
    slice."""
    arrow = to_arrow_type(kind)

    def run(values: pa.Array) -> pa.Array:
        parts = [pa.array([v if v is None else one(v) for v in values.slice(a, SLICE_ROWS).to_pylist()], arrow)
                 for a in range(0, len(values), SLICE_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    run.__name__ = one.__name__
    return F.arrow_udf(run, kind)


def _nfkc_runs(runs: list[str]) -> list[str]:
    return [unicodedata.normalize("NFKC", run) for run in runs]


_nfkc_udf = by_slices(_nfkc_runs, T.ArrayType(T.StringType()))


def nfkc(c) -> Column:
    """Unicode NFKC.  ASCII texts are told by their sizes.  Of the others,
    curly quotes and CJK among them, only the runs of characters that may
    change go to Python; the JVM puts them back in between the stable parts."""
    c = col(c)
    plain, run = F.octet_length(c) == F.length(c), unstable_run_pattern()
    other = F.when(~plain, c)
    runs = _nfkc_udf(F.regexp_extract_all(other, F.lit(run), F.lit(0)))
    # one part more than runs: before the first, between, after the last
    pairs = F.arrays_zip(F.split(other, run).alias("part"), runs.alias("run"))
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(p["part"], F.coalesce(p["run"], F.lit("")))), "")
    return F.when(c.isNull() | plain, c).otherwise(joined)


def _composes(a: str, b: str) -> bool:
    nfkc = unicodedata.normalize
    return nfkc("NFKC", a + b) != nfkc("NFKC", a) + nfkc("NFKC", b)


def nfkc_alignment(text: str, specials: list[str]) -> tuple[list[int], list[int]]:
    """Original character span of every character of the normalized text
    (special tokens untouched, other segments NFKC), per normalization unit
    (a character and the combining marks after it): 'ﬁ' -> 'fi' gives both
    characters the span of 'ﬁ'; a composed 'é' from 'e' + U+0301 gets the
    span of 'e'.  Units that compose with each other (Hangul letters) make
    one span together."""
    import re
    starts: list[int] = []
    ends: list[int] = []
    if specials:
        alts = "|".join(re.escape(x) for x in sorted(specials, key=len, reverse=True))
        parts = re.split(f"({alts})", text)
    else:
        parts = [text]
    base = 0
    special_set = set(specials)
    for k, seg in enumerate(parts):
        if not seg:
            continue
        if specials and k % 2 == 1 and seg in special_set:
            starts += range(base, base + len(seg))
            ends += range(base + 1, base + len(seg) + 1)
            base += len(seg)
            continue
        target = unicodedata.normalize("NFKC", seg)
        s_, e_, out, i = [], [], [], 0
        while i < len(seg):
            j = i + 1
            while j < len(seg) and unicodedata.combining(seg[j]) != 0:
                j += 1
            nu = unicodedata.normalize("NFKC", seg[i:j])
            out.append(nu)
            # output char m <- original char min(i + m, j - 1): expansions
            # ('ﬁ' -> 'fi') share the source char, compositions ('e' + U+0301
            # -> 'é') keep the base char, as the reference tokenizer aligns
            for m in range(len(nu)):
                c = base + min(i + m, j - 1)
                s_.append(c)
                e_.append(c + 1)
            i = j
        if "".join(out) != target:
            # some units compose with their neighbours: those make one span
            s_, e_, spans, i = [], [], [], 0
            while i < len(seg):
                j = i + 1
                while j < len(seg) and unicodedata.combining(seg[j]) != 0:
                    j += 1
                if spans and _composes(seg[spans[-1][0]:i], seg[i:j]):
                    spans[-1][1] = j
                else:
                    spans.append([i, j])
                i = j
            for a, b in spans:
                n = len(unicodedata.normalize("NFKC", seg[a:b]))
                s_ += [base + a] * n
                e_ += [base + b] * n
        starts += s_
        ends += e_
        base += len(seg)
    return starts, ends
