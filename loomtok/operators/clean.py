"""Page filters and markup-to-prose cleaning.

Nested markup (templates, tables, links with captions) has no bound on its
depth, which regular expressions can't follow.  One linear scan takes it out,
in Arrow batches; what is left is flat and goes through regular expressions,
declared once as data (pattern, replacement).
"""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtok.functions.text import by_slices, col, lstrip_ws, normalize_whitespace

# Marks of pages that aren't articles, and title prefixes of non-article pages (case-sensitive).
NAMESPACE_PREFIXES = ["Category:", "Template:", "File:", "Wikipedia:", "Portal:", "Help:"]
REDIRECT_MARK = "#redirect"
DISAMBIG_MARK = "{{disambig"

# (pattern, replacement); an int replacement means "capture group n".
BEFORE_NESTED: list[tuple[str, object]] = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<ref\b[^<>]*/>", ""),
    (r"(?is)<ref\b[^<>]*>.*?</ref\s*>", ""),
    (r"(?i)</?references\b[^<>]*>", ""),
]
# a tag begins with a letter right after the bracket and lies within a line:
# a bare < is text
TAG = r"</?[A-Za-z][^<>\n]*>"
AFTER_NESTED: list[tuple[str, object]] = [
    (r"\[https?://[^ \]]+ ([^\]]*)\]", 1),
    (r"\[https?://[^ \]]+\]", ""),
    (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", 1),
    (r"'{2,5}", ""),
    (TAG, ""),
]

HTML_STEPS: list[tuple[str, object]] = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script>", ""),
    (r"(?is)<style\b.*?</style>", ""),
    (r"(?s)</?[A-Za-z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|<![^<>]*>", " "),
]

# Link prefixes whose links are dropped with their captions.
DROPPED_LINKS = ("file:", "image:", "category:")
_MARK = re.compile(r"\{\{+|\}\}+|\{\||\|\}(?!\})|\[\[|\]\]")


def _without_nested(text: str, links: bool) -> str:
    """Templates {{..}}, parameters {{{..}}}, tables {|..|} and, if
    ``links``, [[..]] links (dropped for ``DROPPED_LINKS``, else the text
    after their first bar, or all of it).  Each opening mark is held on a stack with the text since; a mark
    that never closes is text, and so is one that closes nothing."""
    stack: list[tuple[str, list[str]]] = []
    out: list[str] = []
    at = 0

    def put(piece: str) -> None:
        (stack[-1][1] if stack else out).append(piece)

    def close(kinds: tuple[str, ...], mark: str) -> bool:
        """The innermost open mark of these kinds ends here; marks opened
        within it that never closed go with it."""
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in kinds:
                inner = "".join(stack[depth][1]) + "".join(k + "".join(p) for k, p in stack[depth + 1:])
                kind = stack[depth][0]
                del stack[depth:]
                if kind == "[[":
                    if not inner.strip().lower().startswith(DROPPED_LINKS):
                        put(inner.split("|", 1)[-1])
                return True
        put(mark)
        return False

    for m in _MARK.finditer(text):
        put(text[at:m.start()])
        at, mark = m.end(), m[0]
        if mark[:2] == "{{":
            n = len(mark)
            while n >= 2:
                size = 3 if n == 3 or n >= 5 else 2
                stack.append(("{" * size, []))
                n -= size
            if n:
                put("{")
        elif mark[:2] == "}}":
            n = len(mark)
            while n >= 2:
                kind = next((k for k, _ in reversed(stack) if k in ("{{", "{{{")), None)
                size = min(n, len(kind)) if kind else n
                if kind is None:
                    put("}" * n)
                    n = 0
                    break
                close((kind,), "}" * size)
                n -= size
            if n:
                put("}")
        elif mark == "{|":
            stack.append((mark, []))
        elif mark == "|}":
            close(("{|",), mark)
        elif links and mark == "[[":
            stack.append((mark, []))
        elif links and mark == "]]":
            close(("[[",), mark)
        else:
            put(mark)
    put(text[at:])
    while stack:
        kind, parts = stack.pop()
        put(kind + "".join(parts))
    return "".join(out)


def _no_templates(text: str) -> str:
    return _without_nested(text, False)


strip_templates_udf = by_slices(_no_templates)


def _entities(text: str) -> str:
    return html.unescape(text) if "&" in text else text


entities_udf = by_slices(_entities)


def _java(pattern: str) -> str:
    # (?d): only \n ends a line for '.', '^' and '$' — the RE2 behaviour
    return "(?d)" + pattern


def apply_steps(c, steps) -> Column:
    x = col(c)
    for pattern, rep in steps:
        r = f"${rep}" if isinstance(rep, int) else rep.replace("\\", "\\\\").replace("$", "\\$")
        x = F.regexp_replace(x, F.lit(_java(pattern)), F.lit(r))
    return x


def decode_entities(c) -> Column:
    """All named and numeric character references, each once; texts without
    an ampersand stay in the JVM."""
    x = col(c)
    return F.when(F.instr(x, "&") == 0, x).otherwise(entities_udf(F.when(F.instr(x, "&") > 0, x)))


def strip_templates(c) -> Column:
    """Templates, parameters and tables out, whatever their depth."""
    x = col(c)
    marked = F.instr(x, "{") > 0
    return F.when(~marked, x).otherwise(strip_templates_udf(F.when(marked, x)))


_AFTER = [(re.compile(pattern), rf"\g<{rep}>" if isinstance(rep, int) else rep) for pattern, rep in AFTER_NESTED]


def _prose(text: str) -> str:
    """Nested markup, the steps after it and character references."""
    text = _without_nested(text, True)
    for pattern, rep in _AFTER:
        text = pattern.sub(rep, text)
    return html.unescape(text) if "&" in text else text


prose_udf = by_slices(_prose)


def clean_wikitext(c) -> Column:
    """Templates, tables, refs, comments, file/category links out; link
    text kept; headings unmarked; entities decoded; whitespace rules.  A text
    goes to Python and back once."""
    return normalize_whitespace(prose_udf(apply_steps(c, BEFORE_NESTED)))


def clean_pages(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``clean_wikitext`` as a column, step by step, so that no step stands
    twice in the plan: texts go to Python and back once."""
    df = df.withColumn(out, prose_udf(apply_steps(text, BEFORE_NESTED)))
    return df.withColumn(out, normalize_whitespace(out))


def clean_html(c) -> Column:
    """Comments, script and style blocks out, tags to spaces, entities
    decoded, same whitespace rules."""
    return normalize_whitespace(decode_entities(apply_steps(c, HTML_STEPS)))


def validity_reason(title, text, min_chars: int = 500) -> Column:
    """First failing rule of the article filter, or 'ok'."""
    t = col(text)
    title = F.coalesce(col(title), F.lit(""))
    lowered = F.lower(t)
    ns = None
    for p in NAMESPACE_PREFIXES:
        c = title.startswith(p)
        ns = c if ns is None else (ns | c)
    return (F.when(t.isNull(), "null_text")
            .when(lstrip_ws(lowered).startswith(REDIRECT_MARK), "redirect")
            .when(F.instr(lowered, DISAMBIG_MARK) > 0, "disambig")
            .when(ns, "namespace")
            .when(F.length(t) < min_chars, "short")
            .otherwise("ok"))


def page_validity(pages: DataFrame, min_chars: int = 500, title_col: str = "title",
                  text_col: str = "wikitext") -> DataFrame:
    return pages.withColumn("reason", validity_reason(title_col, text_col, min_chars))
