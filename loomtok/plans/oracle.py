"""DuckDB SQL oracles for the registered queries.

Generated from the same fixed values and regex lists the Spark operators
use, so both sides state one contract.  Differences between the dialects
are handled here: RE2 has no look-ahead, so the pre-tokenizer splits a
whitespace run before its last character by inserting chr(1) markers first
(and excludes chr(1) from the symbol class); training is a recursive CTE with
one merge a step, all pairs counted anew each time (an independent check of
the batched Spark loop); pieces are encoded by another one, the merge of
lowest rank first.  In both a token is one character, chr(0x20000 + id), and a
merge replaces two of them by one.
"""

from __future__ import annotations

import json

from loomtok.functions.bytelevel import CONTINUATION_CLASS, DEFAULT_SPECIAL_TOKENS, GPT2_SPLIT
from loomtok.functions.text import WS
from loomtok.operators import budget
from loomtok.operators.clean import DISAMBIG_MARK, NAMESPACE_PREFIXES, REDIRECT_MARK
from loomtok.plans.models import BASELINE_MERGES, QUERY_MERGES, SPECIAL_MERGES, TRAIN_MERGES, public_vocabulary

N_SPECIAL = len(DEFAULT_SPECIAL_TOKENS)
BASE = N_SPECIAL + 256
MIN_CHARS = 500
LIMIT_BYTES = budget.limit_bytes(1.0)


def s(x: str) -> str:
    """SQL string literal; control characters go through chr()."""
    parts, buf = [], ""
    for ch in x:
        if ord(ch) < 32 or 127 <= ord(ch) < 160 or ord(ch) == 160:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


WS_CLASS = "[" + WS + "]"
NON_WS = "[^" + WS + "]"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, {s('^' + WS_CLASS + '+|' + WS_CLASS + '+$')}, '', 'g')"


def normalize_ws(e: str) -> str:
    x = f"regexp_replace({e}, {s(r'\[\p{Nd}+\]')}, '', 'g')"
    x = f"regexp_replace({x}, {s(r'\n{3,}')}, chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, {s(r'[ \t]{2,}')}, ' ', 'g')"
    return strip_ws(x)


def word_count(e: str) -> str:
    return f"len(regexp_extract_all({e}, {s(NON_WS + '+')}))"


def ratio(a: str, b: str, digits: int = 4) -> str:
    """round-half-up(a / b, digits) on the exact rational; null when b = 0."""
    sc = 10 ** digits
    return (f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST((CAST({a} AS HUGEINT) * {2 * sc} + CAST({b} AS HUGEINT)) "
            f"// (2 * CAST({b} AS HUGEINT)) AS DOUBLE) / CAST({sc} AS DOUBLE) END")


_MARKED_SPLIT = GPT2_SPLIT.replace(r"|\s+(?!\S)", "").replace(r"[^\s\p{L}\p{N}]", r"[^\s\p{L}\p{N}\x01]")


def pretok(e: str) -> str:
    marked = f"regexp_replace({e}, {s(r'(\s+)(\s\S)')}, chr(1) || '\\1' || chr(1) || '\\2', 'g')"
    return f"regexp_extract_all({marked}, {s(_MARKED_SPLIT)})"


def byte_id(b: str) -> str:
    return (f"({N_SPECIAL} + CASE WHEN {b} BETWEEN 33 AND 126 THEN {b} - 33 "
            f"WHEN {b} BETWEEN 161 AND 172 THEN {b} - 161 + 94 WHEN {b} >= 174 THEN {b} - 174 + 106 "
            f"WHEN {b} <= 32 THEN {b} + 188 WHEN {b} <= 160 THEN {b} - 127 + 221 ELSE 255 END)")


def sym_cp(b: str) -> str:
    return (f"(CASE WHEN ({b} BETWEEN 33 AND 126) OR ({b} BETWEEN 161 AND 172) OR {b} >= 174 THEN {b} "
            f"WHEN {b} <= 32 THEN 256 + {b} WHEN {b} <= 160 THEN 256 + {b} - 94 ELSE 256 + 67 END)")


def byte_of_cp(cp: str) -> str:
    return (f"(CASE WHEN {cp} < 256 THEN {cp} WHEN {cp} - 256 <= 32 THEN {cp} - 256 "
            f"WHEN {cp} - 256 <= 66 THEN {cp} - 256 + 94 ELSE 173 END)")


def bytes_of(e: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({e})), '..'), lambda h: ('0x' || h)::INTEGER)"


def symbols(e: str) -> str:
    return f"array_to_string(list_transform({bytes_of(e)}, lambda b: chr(CAST({sym_cp('b')} AS INTEGER))), '')"


def lines(e: str) -> str:
    return f"regexp_extract_all({e}, {s(r'[^\n]*\n|[^\n]+')})"


# ---------------------------------------------------------------------------
# views
# ---------------------------------------------------------------------------
ARTICLES = ("SELECT doc_id AS ord, 'doc' || CAST(doc_id AS VARCHAR) AS title, lang, text FROM documents")

WIKI_PAGES = """SELECT doc_id AS ord,
 CASE WHEN doc_id % 17 = 0 THEN 'Category:' WHEN doc_id % 19 = 0 THEN 'File:'
      WHEN doc_id % 29 = 0 THEN 'category:' ELSE '' END || 'doc' || CAST(doc_id AS VARCHAR) AS title,
 CASE WHEN doc_id % 23 = 0 THEN NULL
      WHEN doc_id % 11 = 0 THEN '  #REDIRECT [[doc' || CAST(doc_id+1 AS VARCHAR) || ']]' || text
      WHEN doc_id % 13 = 0 THEN text || '{{Disambig}}'
      ELSE '{{Infobox|a={{b|c}}|d={{e|{{f}}}}}}' || chr(10) || '== Head ==' || chr(10)
        || '<!-- note -->[[Quito|a high city]] and [[Rome]] ' || text
        || '[1][22]<ref name="x"/><ref>cite</ref>  &lt;ok&gt; &amp;amp;' || repeat(chr(10),4)
        || 'tail' || chr(9) || ' end [[File:x.jpg|thumb|see [[Oslo]]]] [[Category:Z]] [https://a.b label] ''''''bold'''''' {| x'
        || chr(10) || '| y |}' END AS wikitext
FROM documents"""


def block(title: str, body: str) -> str:
    return f"(chr(10) || chr(10) || '=== ' || {title} || ' ===' || chr(10) || chr(10) || {body} || chr(10))"


def apply_steps(e: str, steps) -> str:
    x = e
    for pattern, rep in steps:
        r = f"'\\{rep}'" if isinstance(rep, int) else s(rep)
        x = f"regexp_replace({x}, {s(pattern)}, {r}, 'g')"
    return x


# The oracle's own cleaning, for the markup in the given views only: nesting
# is undone level by level, as deep as the views go, and only the character
# references that occur in them are known.
_FILE_LINK = (r"(?i)\[\[(?:file|image|category):[^\[\]]*\]\]", "")
WIKI_STEPS: list[tuple[str, object]] = [
    (r"(?s)<!--.*?-->", ""), (r"<ref[^<>]*/>", ""), (r"(?s)<ref[^<>]*>.*?</ref>", ""),
    *[(r"\{\{[^{}]*\}\}", "")] * 4, (r"(?s)\{\|.*?\|\}", ""), _FILE_LINK,
    (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", 1), (r"\[\[([^\[\]|]*)\]\]", 1), _FILE_LINK,
    (r"\[https?://[^ \]]+ ([^\]]*)\]", 1), (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", 1), (r"'{2,5}", "")]
PAGE_STEPS: list[tuple[str, object]] = [
    (r"(?s)<!--.*?-->", ""), (r"(?is)<script\b.*?</script>", ""), (r"(?is)<style\b.*?</style>", ""),
    (r"<!DOCTYPE html>", " "), (r"</?[a-z][a-z0-9]*(?: [a-z]+=\"[^\"]*\")*>", " ")]
SQL_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7")]


def entities(e: str) -> str:
    x = e
    for ent, ch in SQL_ENTITIES:
        x = f"replace({x}, {s(ent)}, {s(ch)})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def clean_wikitext(e: str) -> str:
    return normalize_ws(entities(apply_steps(e, WIKI_STEPS)))


def clean_html(e: str) -> str:
    return normalize_ws(entities(apply_steps(e, PAGE_STEPS)))


# What is left of each of the markup forms in front of a text, before the
# white-space rules.
FORMS_LEFT = [
    "deep ", "table in template ", "parameter ", "pre  mid post ", "a < b and c > d, xz 1<2\n\n",
    "\u2013\u2014\u00e9\u2013\u2013&lt; &nosuch; & ", "Romen a high city ",
    "the label  == no head ==\nHead\nbold it ", "open  closed, stray }} and [[ open "]


def markup_forms() -> str:
    cases = " ".join(f"WHEN {i} THEN {s(x)}" for i, x in enumerate(FORMS_LEFT))
    return f"SELECT doc_id AS ord, {normalize_ws(f'(CASE doc_id % {len(FORMS_LEFT)} {cases} END || text)')} AS cleaned FROM documents"


def reason(title: str, text: str) -> str:
    ns = " OR ".join(f"starts_with({title}, {s(p)})" for p in NAMESPACE_PREFIXES)
    return (f"CASE WHEN {text} IS NULL THEN 'null_text' "
            f"WHEN starts_with(regexp_replace(lower({text}), {s('^' + WS_CLASS + '+')}, ''), {s(REDIRECT_MARK)}) "
            f"THEN 'redirect' "
            f"WHEN contains(lower({text}), {s(DISAMBIG_MARK)}) THEN 'disambig' "
            f"WHEN {ns} THEN 'namespace' "
            f"WHEN length({text}) < {MIN_CHARS} THEN 'short' ELSE 'ok' END")


def budget_ctes(rows_sql: str, limit: int = LIMIT_BYTES) -> str:
    """rows(ord, title, valid, block, n_bytes) -> kept(...), counters."""
    lim = max(limit, 1)
    return f"""rows AS ({rows_sql}),
pre AS (SELECT *, COALESCE(SUM(n_bytes) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
        FROM rows WHERE valid),
kept AS (SELECT ord, title, block, CAST(n_bytes AS BIGINT) AS n_bytes FROM pre WHERE pre < {lim}),
st AS (SELECT count(*) AS k, COALESCE(sum(n_bytes), 0) AS b, max(ord) AS last_ord FROM kept),
counters AS (SELECT CAST(st.k AS BIGINT) AS articles_kept,
  CAST((SELECT count(*) FROM rows WHERE NOT valid AND (st.b < {lim} OR ord < st.last_ord)) AS BIGINT) AS articles_skipped,
  CAST(st.b AS BIGINT) AS bytes_written FROM st)"""


def article_rows_sql(where: str = "true") -> str:
    t = "COALESCE(title, '')"
    x = "COALESCE(text, '')"
    valid = f"length({x}) >= {MIN_CHARS}"
    return (f"SELECT ord, {t} AS title, {valid} AS valid, CASE WHEN {valid} THEN {block(t, x)} END AS block, "
            f"CASE WHEN {valid} THEN strlen({block(t, x)}) ELSE 0 END AS n_bytes FROM ({ARTICLES}) WHERE {where}")


def wiki_rows_sql() -> str:
    staged = (f"SELECT ord, COALESCE(title, '') AS title, {reason('COALESCE(title, %s)' % s(''), 'wikitext')} AS reason, "
              f"wikitext FROM ({WIKI_PAGES})")
    cleaned = f"SELECT ord, title, reason, CASE WHEN reason = 'ok' THEN {clean_wikitext('wikitext')} END AS body FROM ({staged})"
    valid = f"(reason = 'ok' AND length(body) >= {MIN_CHARS})"
    return (f"SELECT ord, title, COALESCE({valid}, false) AS valid, CASE WHEN {valid} THEN {block('title', 'body')} END AS block, "
            f"CASE WHEN {valid} THEN strlen({block('title', 'body')}) ELSE 0 END AS n_bytes FROM ({cleaned})")


# ---------------------------------------------------------------------------
# training (unrolled) and encoding
# ---------------------------------------------------------------------------
def piece_counts_sql() -> str:
    return (f"SELECT piece, CAST(count(*) AS BIGINT) AS cnt FROM (SELECT unnest({pretok('line')}) AS piece FROM "
            f"(SELECT unnest({lines('text')}) AS line FROM documents)) GROUP BY piece")


FIRST = 0x20000


def char_of(i: str) -> str:
    return f"chr(CAST({FIRST} + ({i}) AS INTEGER))"


def word_chars(piece: str) -> str:
    return f"array_to_string(list_transform({bytes_of(piece)}, lambda b: {char_of(byte_id('b'))}), '')"


def ids_of(w: str) -> str:
    return f"list_transform(string_split({w}, ''), lambda c: unicode(c) - {FIRST})"


def model_ctes(n_merges: int = QUERY_MERGES, min_frequency: int = 2) -> str:
    """CTEs up to merges (rank, left_id, right_id, new_id, freq, pair, new)
    and vocab.  ``st`` holds words (kind 0, positive keys), tokens with the
    byte tokens they stand for (kind 1) and merges (kind 2)."""
    specials = " UNION ALL ".join(f"SELECT {i} AS id, {s(t)} AS token" for i, t in enumerate(DEFAULT_SPECIAL_TOKENS))
    symbol = f"chr(CAST({sym_cp('b')} AS INTEGER))"
    return f"""pc AS ({piece_counts_sql()}),
w0 AS MATERIALIZED (SELECT row_number() OVER () AS k, cnt, {word_chars('piece')} AS w FROM pc WHERE strlen(piece) >= 2),
bytes AS (SELECT {byte_id('b')} AS id, {symbol} AS token FROM range(256) t(b)),
st(k, kind, step, cnt, w) USING KEY (k) AS (
  SELECT k, 0, 0, CAST(cnt AS BIGINT), w FROM w0
  UNION ALL SELECT -1 - id, 1, 0, CAST(id AS BIGINT), {char_of('id')} FROM bytes
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT p, CAST(sum(cnt) AS BIGINT) AS f
     FROM (SELECT cnt, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) AS p FROM recurring.st WHERE kind = 0)
     GROUP BY p HAVING sum(cnt) >= {min_frequency} ORDER BY f DESC, p LIMIT 1),
   parts AS (SELECT count(*) + {N_SPECIAL} AS n FROM recurring.st WHERE kind = 1),
   now AS MATERIALIZED (
     SELECT best.p, best.f, (SELECT max(step) + 1 FROM st) AS step, n, l.w || r.w AS text
     FROM best, parts, recurring.st AS l, recurring.st AS r
     WHERE l.kind = 1 AND r.kind = 1 AND l.cnt = unicode(best.p[1]) - {FIRST} AND r.cnt = unicode(best.p[2]) - {FIRST} AND n < {BASE + n_merges}),
   made AS MATERIALIZED (SELECT *, coalesce((SELECT min(x.cnt) FROM recurring.st AS x WHERE x.kind = 1 AND x.w = now.text), n) AS id FROM now)
   SELECT x.k, 0, made.step, x.cnt, replace(x.w, made.p, {char_of('made.id')}) FROM recurring.st AS x, made WHERE x.kind = 0 AND contains(x.w, made.p)
   UNION ALL SELECT -1 - id, 1, step, id, text FROM made WHERE id = n
   UNION ALL SELECT -10000000 - step, 2, step, f, p || {char_of('id')} FROM made)),
trained AS MATERIALIZED (SELECT kind, step, cnt, w FROM st WHERE kind > 0),
merges AS MATERIALIZED (
  SELECT step - 1 AS rank, unicode(w[1]) - {FIRST} AS left_id, unicode(w[2]) - {FIRST} AS right_id, unicode(w[3]) - {FIRST} AS new_id, cnt AS freq,
         w[1:2] AS pair, w[3] AS new FROM trained WHERE kind = 2),
vocab AS MATERIALIZED (
  SELECT id, token, CASE WHEN id < {N_SPECIAL} THEN 'special' WHEN id < {BASE} THEN 'byte' ELSE 'merge' END AS kind FROM (
    {specials} UNION ALL SELECT CAST(t.cnt AS BIGINT) AS id, string_agg(b.token, '' ORDER BY t.i) AS token
    FROM (SELECT cnt, unnest({ids_of('w')}) AS b, generate_subscripts({ids_of('w')}, 1) AS i FROM trained WHERE kind = 1) AS t JOIN bytes AS b ON b.id = t.b GROUP BY t.cnt)),
vm AS MATERIALIZED (SELECT map(list(id), list(token)) AS m FROM vocab)"""


def with_model(body: str, n_merges: int = QUERY_MERGES, extra: str = "") -> str:
    ctes = model_ctes(n_merges)
    if extra:
        ctes += ",\n" + extra
    return f"WITH RECURSIVE {ctes}\n{body}"


def _doc_pieces(text: str = "text", src: str = "documents", key: str = "doc_id") -> str:
    return (f"occ AS (SELECT {key} AS doc_id, CAST(generate_subscripts(p, 1) AS BIGINT) AS pos, unnest(p) AS piece "
            f"FROM (SELECT {key}, {pretok(text)} AS p FROM {src}))")


def _pieces_by(name: str) -> str:
    """Pieces of ``occ`` by the merges ``<name>_m`` (pair, rank, new), the
    lowest rank in each piece first."""
    return f"""{name}_p AS MATERIALIZED (SELECT row_number() OVER () AS k, piece, {word_chars('piece')} AS w FROM (SELECT DISTINCT piece FROM occ)),
{name}_s(k, w) USING KEY (k) AS (
  SELECT k, w FROM {name}_p
  UNION ALL
  SELECT k, replace(w, one.pair, one.new) FROM (
    SELECT x.k, any_value(x.w) AS w, min({{'rank': m.rank, 'pair': m.pair, 'new': m.new}}) AS one
    FROM (SELECT k, w, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) AS pair FROM {name}_s) AS x JOIN {name}_m AS m ON m.pair = x.pair
    GROUP BY x.k))"""


def _enc(n: int | None = None, name: str = "enc") -> str:
    """Pieces of ``occ`` by the merges (the first ``n``)."""
    where = f" WHERE rank < {n}" if n is not None else ""
    return f"""{name}_m AS MATERIALIZED (SELECT pair, max(rank) AS rank, arg_max(new, rank) AS new FROM merges{where} GROUP BY pair),
{_pieces_by(name)},
{name} AS MATERIALIZED (
  SELECT p.piece, {ids_of('e.w')} AS ids, list_transform({ids_of('e.w')}, lambda i: m[i]) AS tokens FROM {name}_p AS p JOIN {name}_s AS e USING (k), vm)"""


def _public_enc(path: str) -> str:
    """``pub``: the pieces under the merges of a public vocabulary file; a
    merge's result has the number 300 + rank."""
    return f"""pub_f AS MATERIALIZED (
  SELECT generate_subscripts(m, 1) - 1 AS rank, unnest(m) AS pair FROM (SELECT model.merges AS m FROM read_json({s(path)}, maximum_object_size=100000000,
    columns={{'model': 'STRUCT(merges VARCHAR[][])'}}))),
pub_t AS MATERIALIZED (SELECT pair[1] || pair[2] AS token, 300 + rank AS id FROM pub_f UNION ALL SELECT token, id FROM bytes),
pub_m AS MATERIALIZED (
  SELECT {char_of('l.id')} || {char_of('r.id')} AS pair, rank, {char_of('300 + rank')} AS new
  FROM pub_f JOIN pub_t AS l ON l.token = pair[1] JOIN pub_t AS r ON r.token = pair[2]),
{_pieces_by('pub')},
pub AS MATERIALIZED (SELECT p.piece, {ids_of('e.w')} AS ids, {ids_of('e.w')} AS tokens FROM pub_p AS p JOIN pub_s AS e USING (k))"""


_TOK_ROWS = (f"tok AS (SELECT doc_id, pos, tp, id, token, length(regexp_replace(token, {s(CONTINUATION_CLASS)}, '', 'g')) AS lead, "
             f"CASE WHEN regexp_matches(token, {s('^' + CONTINUATION_CLASS)}) THEN 1 ELSE 0 END AS cf FROM "
             f"(SELECT o.doc_id, o.pos, generate_subscripts(e.ids, 1) AS tp, unnest(e.ids) AS id, "
             f"unnest(e.tokens) AS token FROM occ o JOIN enc e USING (piece))),\n"
             f"offs AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos, tp) - 1 AS BIGINT) AS pos, "
             f"id, token, before - cf AS start, before + lead AS \"end\" FROM "
             f"(SELECT *, SUM(lead) OVER (PARTITION BY doc_id ORDER BY pos, tp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
             f"- lead AS before FROM tok))")


def _doc_enc_body(name: str = "enc") -> str:
    return (f"SELECT d.doc_id, COALESCE(x.ids, '') AS ids, COALESCE(x.tokens, '') AS tokens, "
            f"CAST(COALESCE(x.num_tokens, 0) AS BIGINT) AS num_tokens, CAST(length(d.text) AS BIGINT) AS num_chars "
            f"FROM documents d LEFT JOIN (SELECT o.doc_id, string_agg(array_to_string(e.ids, ' '), ' ' ORDER BY o.pos) AS ids, "
            f"string_agg(array_to_string(e.tokens, ' '), ' ' ORDER BY o.pos) AS tokens, sum(len(e.ids)) AS num_tokens "
            f"FROM occ o JOIN {name} e USING (piece) GROUP BY o.doc_id) x ON x.doc_id = d.doc_id")


def _bench_sql() -> str:
    prose = (f"SELECT 'prose' AS benchmark, CAST(item_id AS BIGINT) AS ord, text FROM benchmark "
             f"WHERE text IS NOT NULL AND regexp_matches(text, {s(NON_WS)})")
    dialog = (f"SELECT 'dialog' AS benchmark, CAST(row_number() OVER (ORDER BY conv_id, turn) AS BIGINT) AS ord, text "
              f"FROM conversations WHERE text IS NOT NULL AND regexp_matches(text, {s(NON_WS)})")
    return f"{prose} UNION ALL {dialog}"


def _bench_lines_sql() -> str:
    raw = (f"SELECT item_id, generate_subscripts(l, 1) AS ln, unnest(l) AS line FROM "
           f"(SELECT item_id, string_split(text, chr(10)) AS l FROM benchmark)")
    stripped = f"SELECT item_id, ln, {strip_ws('line')} AS text FROM ({raw})"
    return (f"SELECT 'prose_lines' AS benchmark, CAST(row_number() OVER (ORDER BY item_id, ln) AS BIGINT) AS ord, text "
            f"FROM ({stripped}) WHERE length(text) > 0")


def _metrics_sql() -> str:
    body = f"""SELECT z.benchmark, z.num_documents, z.total_words, CAST(COALESCE(t.total_tokens, 0) AS BIGINT) AS total_tokens,
 z.total_chars, z.total_bytes_utf8,
 {ratio('COALESCE(t.total_tokens, 0)', 'z.total_words')} AS tokens_per_word,
 {ratio('z.total_bytes_utf8', 'COALESCE(t.total_tokens, 0)')} AS compression_ratio_bytes_per_token
FROM (SELECT benchmark, CAST(count(*) AS BIGINT) AS num_documents, CAST(sum({word_count('text')}) AS BIGINT) AS total_words,
        CAST(sum(length(text)) AS BIGINT) AS total_chars, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes_utf8
      FROM bench GROUP BY benchmark) z
LEFT JOIN (SELECT o.doc_id AS benchmark, sum(len(e.ids)) AS total_tokens FROM occ o JOIN enc e USING (piece)
           GROUP BY o.doc_id) t ON t.benchmark = z.benchmark"""
    return body


def _metrics_ctes() -> str:
    return (f"bench AS ({_bench_sql()}),\n"
            f"occ AS (SELECT benchmark AS doc_id, unnest({pretok('text')}) AS piece FROM bench),\n{_enc()},\n"
            f"metrics AS ({_metrics_sql()})")


def _decode(tokens_str: str) -> str:
    chars = f"string_split({tokens_str}, '')"
    hexes = f"list_transform({chars}, lambda c: printf('%02X', {byte_of_cp('unicode(c)')}))"
    return f"decode(unhex(array_to_string({hexes}, '')))"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["text_sizes"] = ("SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, "
                       "CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
    q["word_counts"] = f"SELECT doc_id, CAST({word_count('text')} AS BIGINT) AS n_words FROM documents"
    q["corpus_lines"] = (f"SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no, unnest(l) AS line "
                         f"FROM (SELECT doc_id, {lines('text')} AS l FROM documents)")
    q["scan_articles_by_lang"] = f"SELECT * FROM ({ARTICLES}) WHERE lang = 'en'"
    q["corpus_blocks"] = f"SELECT ord, title, block, CAST(n_bytes AS BIGINT) AS n_bytes FROM ({article_rows_sql()}) WHERE valid"
    q["normalize_whitespace"] = f"SELECT doc_id, {normalize_ws('text')} AS text_norm FROM documents"
    q["pretokenize"] = (f"SELECT doc_id, CAST(len(p) AS BIGINT) AS n_pieces, array_to_string(p, chr(1)) AS pieces "
                        f"FROM (SELECT doc_id, {pretok('text')} AS p FROM documents)")
    q["byte_symbols"] = f"SELECT doc_id, {symbols('text')} AS symbols FROM documents"
    q["piece_counts"] = piece_counts_sql()
    q["pair_counts"] = (f"SELECT unicode(p[1]) - {FIRST} AS left_id, unicode(p[2]) - {FIRST} AS right_id, CAST(sum(cnt) AS BIGINT) AS freq FROM "
                        f"(SELECT cnt, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) AS p FROM "
                        f"(SELECT cnt, {word_chars('piece')} AS w FROM ({piece_counts_sql()}) WHERE strlen(piece) >= 2)) GROUP BY p")
    # cleaning / extraction
    q["page_validity"] = f"SELECT ord, {reason('title', 'wikitext')} AS reason FROM ({WIKI_PAGES})"
    tmpl = "wikitext"
    for pattern in [r"\{\{[^{}]*\}\}"] * 4 + [r"(?s)\{\|.*?\|\}"]:
        tmpl = f"regexp_replace({tmpl}, {s(pattern)}, '', 'g')"
    q["strip_templates"] = f"SELECT ord, {tmpl} AS stripped FROM ({WIKI_PAGES})"
    q["clean_wikitext"] = f"SELECT ord, {clean_wikitext('wikitext')} AS cleaned FROM ({WIKI_PAGES})"
    q["clean_markup_forms"] = markup_forms()
    q["extract_wiki_corpus"] = f"WITH {budget_ctes(wiki_rows_sql())} SELECT * FROM kept"
    q["clean_html_pages"] = f"SELECT page_id, {clean_html('html')} AS text FROM pages"
    q["extract_article_corpus"] = f"WITH {budget_ctes(article_rows_sql())} SELECT * FROM kept"
    q["extraction_manifest"] = (
        f"WITH {budget_ctes(article_rows_sql("lang = 'en'"))} SELECT articles_kept, articles_skipped, bytes_written, 'en' AS lang, "
        f"CAST(1.0 AS DOUBLE) AS size_limit_mb, 'en_corpus.txt' AS output_file, 'documents' AS source, "
        f"{s(budget.LICENSE_NOTE_ARTICLES)} AS license_note FROM counters")
    q["scan_xml_pages"] = f"SELECT ord, title, wikitext FROM ({WIKI_PAGES})"
    # training / model tables
    merges = ("SELECT CAST(rank AS INTEGER) AS rank, CAST(left_id AS INTEGER) AS left_id, "
              "CAST(right_id AS INTEGER) AS right_id, CAST(new_id AS INTEGER) AS new_id, CAST(freq AS BIGINT) AS freq FROM merges")
    q["train_bpe"], q["train_bpe_2000"] = with_model(merges), with_model(merges, TRAIN_MERGES)
    q["vocab_table"] = with_model("SELECT CAST(id AS INTEGER) AS id, token, kind FROM vocab")
    q["vocab_info"] = with_model(f"SELECT CAST(count(*) AS BIGINT) AS vocab_size, "
                                 f"{s(','.join(DEFAULT_SPECIAL_TOKENS))} AS special_tokens FROM vocab")
    q["training_config"] = with_model(
        f"SELECT CAST({BASE + QUERY_MERGES} AS BIGINT) AS vocab_size_requested, "
        f"CAST((SELECT count(*) FROM vocab) AS BIGINT) AS vocab_size_actual, CAST(2 AS BIGINT) AS min_frequency, "
        f"{s(json.dumps(DEFAULT_SPECIAL_TOKENS, separators=(',', ':')))} AS special_tokens, 'model' AS tokenizer_file, 'ByteLevel' AS pre_tokenizer, 'NFKC' AS normalizer, "
        f"'BPE' AS model, 'documents' AS corpus_file, CAST(sum(strlen(text)) AS BIGINT) AS corpus_size_bytes "
        f"FROM documents")
    # encoding
    enc_ctes = f"{_doc_pieces()},\n{_enc()}"
    q["encode_documents"] = with_model(_doc_enc_body(), extra=enc_ctes)
    q["token_offsets"] = with_model(
        'SELECT doc_id, pos, CAST(id AS BIGINT) AS id, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" '
        "FROM offs", extra=f"{enc_ctes},\n{_TOK_ROWS}")
    q["ids_to_tokens"] = with_model(
        "SELECT doc_id, tokens FROM (" + _doc_enc_body() + ")", extra=enc_ctes)
    q["detokenize"] = with_model(
        f"SELECT x.doc_id, {_decode("replace(x.tokens, ' ', '')")} AS text, "
        f"{_decode("replace(x.tokens, ' ', '')")} = d.text AS roundtrip FROM ({_doc_enc_body()}) x "
        f"JOIN documents d ON d.doc_id = x.doc_id", extra=enc_ctes)
    q["vocab_usage"] = with_model(
        "SELECT CAST(v.id AS BIGINT) AS id, v.token, v.kind, CAST(m.rank AS BIGINT) AS rank, "
        "CAST(m.left_id AS BIGINT) AS left_id, CAST(m.right_id AS BIGINT) AS right_id, "
        "CAST(m.freq AS BIGINT) AS merge_freq, CAST(COALESCE(u.uses, 0) AS BIGINT) AS uses "
        "FROM vocab v LEFT JOIN (SELECT * FROM merges QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY rank) = 1) m "
        "ON m.new_id = v.id LEFT JOIN "
        "(SELECT id, sum(cnt) AS uses FROM (SELECT unnest(e.ids) AS id, o.cnt FROM "
        "(SELECT piece, count(*) AS cnt FROM occ GROUP BY piece) o JOIN enc e USING (piece)) GROUP BY id) u "
        "ON u.id = v.id", extra=enc_ctes)
    q["token_stream"] = with_model(
        "SELECT o.doc_id, o.pos, CAST(o.id AS BIGINT) AS id, o.token, replace(o.token, 'Ġ', '·') AS display, "
        'CAST(o.start AS BIGINT) AS start, CAST(o."end" AS BIGINT) AS "end", '
        'CAST(greatest(1, o."end" - o.start) AS BIGINT) AS char_span, '
        'round(least(CAST(1.0 AS DOUBLE) + CAST(0.18 AS DOUBLE) * greatest(1, o."end" - o.start), CAST(4.0 AS DOUBLE)), 4) '
        "AS width_scale, CAST(o.id % 3 AS BIGINT) AS band, "
        f"{ratio('x.num_chars', 'greatest(1, x.num_tokens)', 2)} AS chars_per_token "
        f"FROM offs o JOIN ({_doc_enc_body()}) x ON x.doc_id = o.doc_id",
        extra=f"{enc_ctes},\n{_TOK_ROWS}")
    q["tokenize_rejects"] = (
        "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'null_text' WHEN 1 THEN 'empty_text' WHEN 2 THEN 'blank_text' ELSE 'ok' END AS reason, "
        "doc_id % 7 > 2 AS accepted FROM documents")
    composed = [" fine", " AB", " \u00e9", " x2", " 11\u20442", " \u30d1", " \u1e69", " \u00c5\u03a9", " \u03ac\u0436\u4e2d", " \uac01"]
    forms = " ".join(f"WHEN {i} THEN {s(x)}" for i, x in enumerate(composed))
    q["nfkc_normalize"] = f"SELECT doc_id, text || CASE doc_id % {len(composed)} {forms} END AS text_nfkc FROM documents"
    q["benchmark_first_docs"] = f"SELECT * FROM ({_bench_sql()}) QUALIFY row_number() OVER (PARTITION BY benchmark ORDER BY ord) <= 25"
    base_enc = _enc(BASELINE_MERGES, "enc4")
    q["compare_models"] = with_model(
        "SELECT a.doc_id, a.num_tokens AS ours_num_tokens, b.num_tokens AS baseline_num_tokens, "
        "a.num_tokens - b.num_tokens AS delta, "
        "CASE WHEN a.num_tokens = b.num_tokens THEN 'Identical token count' "
        "WHEN a.num_tokens < b.num_tokens THEN CAST(b.num_tokens - a.num_tokens AS VARCHAR) || ' fewer tokens than baseline' "
        "ELSE CAST(a.num_tokens - b.num_tokens AS VARCHAR) || ' more tokens than baseline' END AS delta_label, "
        "a.ids AS ours_ids, b.ids AS baseline_ids, a.tokens AS ours_tokens, b.tokens AS baseline_tokens "
        f"FROM ({_doc_enc_body()}) a JOIN ({_doc_enc_body('enc4')}) b ON a.doc_id = b.doc_id",
        extra=f"{enc_ctes},\n{base_enc}")
    # benchmarks / evaluation
    q["bench_rows"] = (f"SELECT 'prose' AS benchmark, CAST(item_id AS BIGINT) AS ord, text FROM benchmark "
                       f"WHERE text IS NOT NULL AND regexp_matches(text, {s(NON_WS)})")
    q["bench_lines"] = _bench_lines_sql()
    q["bench_union"] = _bench_sql()
    corpus_lines = (f"SELECT DISTINCT line FROM (SELECT {strip_ws('l')} AS line FROM "
                    f"(SELECT unnest(string_split(text, chr(10))) AS l FROM documents)) WHERE regexp_matches(line, {s(NON_WS)})")
    bench_l = (f"SELECT benchmark, line FROM (SELECT benchmark, {strip_ws('l')} AS line FROM "
               f"(SELECT benchmark, unnest(string_split(text, chr(10))) AS l FROM ({_bench_sql()}))) "
               f"WHERE regexp_matches(line, {s(NON_WS)})")
    q["benchmark_overlap"] = (
        f"WITH bl AS ({bench_l}), cl AS ({corpus_lines}), "
        f"tot AS (SELECT benchmark, count(*) AS total_lines FROM bl GROUP BY benchmark), "
        f"hit AS (SELECT benchmark, count(*) AS overlapping_lines FROM bl WHERE line IN (SELECT line FROM cl) GROUP BY benchmark) "
        f"SELECT tot.benchmark, CAST(total_lines AS BIGINT) AS total_lines, "
        f"CAST(COALESCE(overlapping_lines, 0) AS BIGINT) AS overlapping_lines, "
        f"{ratio('COALESCE(overlapping_lines, 0)', 'total_lines')} AS overlap_ratio "
        f"FROM tot LEFT JOIN hit ON hit.benchmark = tot.benchmark")
    q["eval_metrics"] = with_model("SELECT * FROM metrics", extra=_metrics_ctes())
    metric_obj = ", ".join(f"'{c}', {c}" for c in ["num_documents", "total_words", "total_tokens", "total_chars",
                                                    "total_bytes_utf8", "tokens_per_word",
                                                    "compression_ratio_bytes_per_token"])
    q["eval_report_nested"] = with_model(
        f"SELECT CAST(json_object('vocab_size', (SELECT count(*) FROM vocab), 'benchmarks', "
        f"json('{{' || string_agg(to_json(benchmark)::VARCHAR || ':' || json_object({metric_obj})::VARCHAR, ',' "
        f"ORDER BY benchmark) || '}}')) AS VARCHAR) AS report_json FROM metrics", extra=_metrics_ctes())
    q["benchmark_table"] = with_model(
        "SELECT benchmark, '| ' || benchmark || ' | ' || CAST(tokens_per_word AS VARCHAR) || ' | ' || "
        "CAST(compression_ratio_bytes_per_token AS VARCHAR) || ' |' AS markdown_row FROM metrics",
        extra=_metrics_ctes())
    q["ui_table"] = with_model(
        "SELECT benchmark, printf('%.3f', tokens_per_word) AS tokens_per_word, printf('%.3f', compression_ratio_bytes_per_token) AS bytes_per_token, "
        "printf('%.0f', total_chars * 7 / 1000.0) || 'k chars/s' AS encode_speed, "
        "printf('%.0f', total_chars * 90 / 1000.0) || 'k chars/s' AS decode_speed FROM metrics", extra=_metrics_ctes())
    q["report_roundtrip"] = with_model(
        "SELECT 'model' AS tokenizer_path, (SELECT count(*) FROM vocab) AS vocab_size, benchmark, total_tokens, tokens_per_word FROM metrics",
        extra=_metrics_ctes())
    q["train_special_tokens"] = with_model(
        "SELECT CAST(rank AS INTEGER) AS rank, CAST(left_id - 1 AS INTEGER) AS left_id, CAST(right_id - 1 AS INTEGER) AS right_id, "
        "CAST(new_id - 1 AS INTEGER) AS new_id, CAST(freq AS BIGINT) AS freq FROM merges", SPECIAL_MERGES)
    q["stream_token_totals"] = with_model(
        f"SELECT z.lang, z.num_documents, z.total_words, CAST(COALESCE(t.total_tokens, 0) AS BIGINT) AS total_tokens, "
        f"z.total_chars, z.total_bytes_utf8 FROM (SELECT lang, CAST(count(*) AS BIGINT) AS num_documents, "
        f"CAST(sum({word_count('text')}) AS BIGINT) AS total_words, CAST(sum(length(text)) AS BIGINT) AS total_chars, "
        f"CAST(sum(strlen(text)) AS BIGINT) AS total_bytes_utf8 FROM documents GROUP BY lang) z LEFT JOIN "
        f"(SELECT o.doc_id AS lang, sum(len(e.ids)) AS total_tokens FROM occ o JOIN enc e USING (piece) GROUP BY o.doc_id) t "
        f"ON t.lang = z.lang",
        extra=f"occ AS (SELECT lang AS doc_id, unnest({pretok('text')}) AS piece FROM documents),\n{_enc()}")
    q["live_token_totals"] = q["stream_token_totals"]
    q["live_token_rows"] = with_model(
        'SELECT doc_id, pos, CAST(id AS BIGINT) AS id, token, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM offs',
        extra=f"{enc_ctes},\n{_TOK_ROWS}")
    three = f"{_bench_sql()} UNION ALL {_bench_lines_sql()}"
    q["benchmark_disjointness"] = (
        f"WITH b AS ({three}), l AS (SELECT DISTINCT benchmark, line FROM (SELECT benchmark, {strip_ws('l')} AS line FROM "
        f"(SELECT benchmark, unnest(string_split(text, chr(10))) AS l FROM b)) WHERE regexp_matches(line, {s(NON_WS)})), "
        f"n AS (SELECT b.benchmark, (SELECT count(*) FROM l WHERE l.benchmark = b.benchmark) AS lines FROM (SELECT DISTINCT benchmark FROM b) AS b), "
        f"p AS (SELECT x.benchmark AS benchmark_a, y.benchmark AS benchmark_b, x.lines AS lines_a, y.lines AS lines_b, "
        f"(SELECT count(*) FROM (SELECT line FROM l WHERE benchmark = x.benchmark INTERSECT SELECT line FROM l WHERE benchmark = y.benchmark)) AS shared_lines "
        f"FROM n AS x JOIN n AS y ON x.benchmark < y.benchmark) "
        f"SELECT *, {ratio('shared_lines', 'lines_a + lines_b - shared_lines')} AS jaccard, shared_lines = 0 AS disjoint FROM p")
    q["scan_article_snapshot"] = f"SELECT ord, title, lang, text || chr(10) || 'revised' AS text FROM ({ARTICLES}) WHERE ord % 4 <> 0 AND lang = 'en'"
    q["vocab_info_config"] = with_model(
        f"SELECT c AS config, (SELECT count(*) FROM vocab) AS vocab_size, t AS special_tokens FROM "
        f"(VALUES ('there', {s(','.join(DEFAULT_SPECIAL_TOKENS))}), ('missing', '')) AS x(c, t)")
    q["tokenizer_roundtrip"] = with_model(
        "SELECT CAST(m.rank AS BIGINT) AS rank, l.token AS left_token, r.token AS right_token, n.token AS new_token, CAST(n.id AS BIGINT) AS new_id, true AS json_equal "
        "FROM merges AS m JOIN vocab AS l ON l.id = m.left_id JOIN vocab AS r ON r.id = m.right_id JOIN vocab AS n ON n.id = m.new_id")
    q["scan_foreign_dump"] = (
        "SELECT CASE WHEN broken THEN NULL ELSE doc_id END AS ord, CASE WHEN broken THEN NULL ELSE 'T & ' || CAST(doc_id AS VARCHAR) END AS title, "
        "CASE WHEN broken OR text = '' THEN NULL ELSE text END AS wikitext, broken FROM (SELECT *, doc_id % 7 = 3 AS broken FROM documents)")
    if public := public_vocabulary():
        q["compare_public"] = with_model(
            "SELECT a.doc_id, a.num_tokens AS ours_num_tokens, b.num_tokens AS baseline_num_tokens, a.num_tokens - b.num_tokens AS delta "
            f"FROM ({_doc_enc_body()}) a JOIN ({_doc_enc_body('pub')}) b ON a.doc_id = b.doc_id", extra=f"{_doc_pieces()},\n{_enc()},\n{_public_enc(public)}")
    return q


ORACLE_SQL = build()
