"""Byte-level pre-tokenization and the byte <-> symbol alphabet.

A piece of text becomes a string of *symbols*, one per UTF-8 byte, each a
printable character; token ids follow the alphabet order.  All of it is
expressed with built-in expressions (regexp_extract_all, encode/decode,
translate, transform) so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtok.functions.text import col

# The GPT-2 byte-level pre-tokenizer split pattern.  ``(?U)``
# makes \s the Unicode White_Space class, as in the original tokenizer.
GPT2_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
              r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPARK_SPLIT = "(?U)" + GPT2_SPLIT
# The same letters, numbers and white space up to U+00FF, written out.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_SPLIT = rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

# Special tokens reserved at the lowest ids, in this order.
DEFAULT_SPECIAL_TOKENS = ["<unk>", "<s>", "</s>", "<pad>"]


def is_printable_byte(b: int) -> bool:
    """Bytes that stand for themselves in the byte alphabet (GPT-2 rule):
    '!'..'~', '¡'..'¬', '®'..'ÿ'.  The other 68 are shifted to U+0100+."""
    return 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255


SHIFTED_BYTES = [b for b in range(256) if not is_printable_byte(b)]
# Symbol order by code point = printable bytes ascending, then shifted bytes
# ascending (their symbols are U+0100.. in byte order).
ALPHABET_BYTE_ORDER = [b for b in range(256) if is_printable_byte(b)] + SHIFTED_BYTES


def byte_symbol(b: int) -> str:
    return chr(b) if is_printable_byte(b) else chr(256 + SHIFTED_BYTES.index(b))


ALPHABET = [byte_symbol(b) for b in ALPHABET_BYTE_ORDER]  # sorted by code point
_SRC = "".join(chr(b) for b in SHIFTED_BYTES)
_DST = "".join(chr(256 + i) for i in range(len(SHIFTED_BYTES)))


def _class_of(chars: set[str]) -> str:
    """A regex character class of code-point ranges, as \\x{..} escapes
    (valid in Java and RE2)."""
    cps = sorted(ord(c) for c in chars)
    runs, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        runs.append(f"\\x{{{start:x}}}" + (f"-\\x{{{prev:x}}}" if prev > start else ""))
        if cp is not None:
            start = prev = cp
    return "[" + "".join(runs) + "]"


# UTF-8 continuation bytes 0x80..0xBF as symbols.
CONTINUATION_CLASS = _class_of({byte_symbol(b) for b in range(0x80, 0xC0)})


def piece_finder():
    """A function that cuts a text into pieces within a task.  Texts without
    characters past U+00FF go by ``LATIN_SPLIT``, which needs no Unicode
    properties and so Python's own, faster matcher."""
    import regex

    latin, every = re.compile(LATIN_SPLIT).findall, regex.compile(GPT2_SPLIT).findall

    def find(text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return every(text)
        return latin(text)

    return find


def pretokenize(c) -> Column:
    """array<string> of pieces (GPT-2 split, no prefix space)."""
    return F.regexp_extract_all(col(c), F.lit(SPARK_SPLIT), 0)


def to_symbols(c) -> Column:
    """UTF-8 bytes of the text as a symbol string (one char per byte)."""
    latin = F.decode(F.encode(col(c), "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _SRC, _DST)


def symbols_to_text(c) -> Column:
    """Inverse of :func:`to_symbols`; invalid UTF-8 becomes U+FFFD.

    ``translate`` deletes characters mapped to NUL, so the symbol of byte 0
    is handled with ``replace`` first.
    """
    x = F.replace(col(c), F.lit(_DST[0]), F.lit(_SRC[0]))
    x = F.translate(x, _DST[1:], _SRC[1:])
    raw = F.encode(x, "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def symbol_id(cp: Column, n_special: int) -> Column:
    """Token id of a one-symbol token from its code point (alphabet rank)."""
    idx = (F.when(cp <= 126, cp - 33)
           .when(cp <= 172, cp - 161 + 94)
           .when(cp <= 255, cp - 174 + 106)
           .otherwise(cp - 256 + 188))
    return (idx + F.lit(n_special)).cast("int")


def symbol_ids(symbols, n_special: int) -> Column:
    """array<int> of base ids for a symbol string."""
    chars = F.split(col(symbols), "")
    return F.transform(F.filter(chars, lambda ch: F.length(ch) > 0),
                       lambda ch: symbol_id(F.ascii(ch), n_special))
