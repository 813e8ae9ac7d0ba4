"""Corpus extraction: filter, clean, format blocks and cut at a byte budget.

The reference walks articles in order and stops right after the article
that takes the written size to the limit or past it (that article is kept).
Equivalently, a valid article is kept iff the bytes of the valid articles
before it are below ``greatest(limit, 1)``; skipped articles count only when
they come before the last kept one (or all of them when the budget is never
reached).

Order: ``ord``, nulls last, then a hash of the article's title and raw text;
articles equal in both are interchangeable, and as many of them are kept as
fit.  Rows and counters come from one and the same cut.

``ord`` is cut into ranges, which are looked at from the first on: one, then
as many as the bytes found so far say, until the limit is crossed.  Pages that
need cleaning are cleaned range by range, each once, and written with their
byte sizes to the shared folder; sums, cut and result read what was written.
Only the range that crosses the limit needs running sums, the two-level ones of
``ordering``; those before it are kept whole.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtok.functions.text import byte_len, char_len
from loomtok.operators.clean import clean_pages, validity_reason
from loomtok.operators.ordering import bucket_count, bucket_splits, prefix_sum_before
from loomtok.session import ensure_checkpoint_dir

# Licence notes written into the manifests.
LICENSE_NOTE_XML = ("Wikipedia text is licensed CC BY-SA 4.0. Redistribution of this corpus or "
                    "derived models must comply with attribution and share-alike terms. "
                    "See https://creativecommons.org/licenses/by-sa/4.0/")
LICENSE_NOTE_ARTICLES = ("Wikipedia text is licensed CC BY-SA 4.0. Redistribution requires attribution "
                         "and share-alike compliance. See https://creativecommons.org/licenses/by-sa/4.0/")

MIB = 1024 * 1024
#: Ranges of ``ord`` at least.
LOOKS = 64


def block(title, body):
    """Document boundary format of the corpus file."""
    return F.concat(F.lit("\n\n=== "), title, F.lit(" ===\n\n"), body, F.lit("\n"))


@dataclass
class Extraction:
    corpus: DataFrame       # ord, title, block, n_bytes (kept articles only)
    manifest: DataFrame     # one row


def limit_bytes(size_limit_mb: float) -> int:
    return int(size_limit_mb * MIB)


def cut_at_budget(rows: DataFrame, limit: int, n_buckets: int | None = None, order: DataFrame | None = None,
                  written: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """rows: ord, valid (bool), n_bytes (0 when invalid), and payload; ``tie``
    if it is there orders rows of one ``ord``.  ``order``: the rows' ``ord``,
    where that is cheaper to read than ``rows``.  ``written`` is called once
    for the rows of each look, in order, and gives them back as they are to be
    read from then on.  Returns (kept rows, one-row counters)."""
    lim, spark = max(limit, 1), rows.sparkSession
    if "tie" not in rows.columns:
        rows = rows.withColumn("tie", F.lit(0).cast("bigint"))
    order = (rows if order is None else order).select("ord")
    ends = bucket_splits(order, "ord", max(LOOKS, bucket_count(rows, order.count())))

    def within(a: int, b: int) -> Column:
        """The ranges a to b - 1; the last one has all beyond the last end, nulls too."""
        above = F.col("ord") > F.lit(ends[a - 1]) if a else F.lit(True)
        return above & (F.col("ord") <= F.lit(ends[b - 1])) if b <= len(ends) else F.coalesce(above, F.lit(True))

    number = F.lit(0)
    if ends:
        below = F.array(*map(F.lit, ends))
        number = F.when(F.col("ord").isNull(), len(ends)).otherwise(F.size(F.filter(below, lambda e: e < F.col("ord"))))
    # since: the ranges before it have been looked at and stay whole; crossing: the one in which the limit is reached
    n_valid, n_invalid, n_bytes, looked, since, crossing = 0, 0, 0, [], 0, None
    while crossing is None and since <= len(ends):
        guess = -(-since * (lim - n_bytes) * 9 // (n_bytes * 8)) if n_bytes else since
        upto = min(since + max(guess, 1), len(ends) + 1)
        here = rows.where(within(since, upto))
        if written is not None:
            here = written(here)
            looked.append(here)
        sums = here.groupBy(number.alias("i")).agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"),
                                                   F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes")).collect()
        for r in sorted(sums):
            if n_bytes + r.bytes >= lim:
                crossing = r.i
                break
            n_valid, n_invalid, n_bytes = n_valid + r.valid, n_invalid + r.invalid, n_bytes + r.bytes
        since = upto
    if written is not None:
        rows = reduce(DataFrame.unionByName, looked)
    kept = rows.where("valid")
    if crossing is not None:
        valid, invalid, n_bytes, kept = _cut_within(here.where(within(crossing, crossing + 1)), rows, lim, n_bytes, n_buckets)
        n_valid, n_invalid = n_valid + valid, n_invalid + invalid
    counters = spark.createDataFrame([(int(n_valid), int(n_invalid), int(n_bytes))],
                                     "articles_kept bigint, articles_skipped bigint, bytes_written bigint")
    return kept, counters


def _cut_within(here: DataFrame, rows: DataFrame, lim: int, before: int, n_buckets: int | None) -> tuple[int, int, int, DataFrame]:
    """The limit is crossed by the rows ``here``, ``before`` bytes come
    earlier: valid and invalid rows of them seen, bytes in all, kept ``rows``."""
    index = here.select("ord", "tie", "valid", F.col("n_bytes").cast("bigint").alias("n_bytes"))
    dense = index.groupBy("ord", "tie").agg(
        F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_invalid"), F.coalesce(F.max("n_bytes"), F.lit(0)).alias("each"))
    dense = dense.withColumn("total", F.col("n_valid") * F.col("each")).persist()
    pre = prefix_sum_before(dense, "ord", "total", "pre", n_buckets, tie="tie").withColumn("pre", F.col("pre") + before)
    stats = pre.where(F.col("pre") < lim).agg(
        F.sum("n_valid").alias("valid"), F.sum("n_invalid").alias("invalid"),
        F.max(F.struct(F.col("ord").isNull().alias("last"), "ord", "tie", "n_valid", "each", "pre")).alias("end")).first()
    dense.unpersist()
    # the last article seen crosses; of several equal ones as many stay as fit
    e = stats.end
    more = -(-(lim - e.pre) // e.each)
    same = F.col("ord").eqNullSafe(F.lit(e.ord).cast(rows.schema["ord"].dataType))
    # the bound on ord alone reaches the scan
    kept = rows.where("valid") if e.ord is None else rows.where("valid").where(F.col("ord") <= F.lit(e.ord))
    if more == e.n_valid:
        kept = kept.where(~same | (F.col("tie") <= F.lit(e.tie)))
    else:
        last = kept.where(same & (F.col("tie") == F.lit(e.tie))).limit(more)
        kept = kept.where(~same | (F.col("tie") < F.lit(e.tie))).unionByName(last)
    return stats.valid - e.n_valid + more, stats.invalid, e.pre + more * e.each, kept


def article_rows(articles: DataFrame, min_chars: int) -> DataFrame:
    """Fast path: pre-cleaned (ord, title, text); only a length filter."""
    title = F.coalesce(F.col("title"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    valid = char_len(text) >= min_chars
    blk = block(title, text)
    return articles.select("ord", F.xxhash64(title, text).alias("tie"), title.alias("title"), valid.alias("valid"),
                           F.when(valid, blk).alias("block"),
                           F.when(valid, byte_len(blk)).otherwise(0).cast("bigint").alias("n_bytes"))


def wiki_rows(pages: DataFrame, min_chars: int) -> DataFrame:
    """XML path: cheap raw-text filters first, cleaning only for survivors,
    then the minimum length again on the cleaned text."""
    title = F.coalesce(F.col("title"), F.lit(""))
    reason = validity_reason(title, F.col("wikitext"), min_chars)
    staged = pages.select("ord", F.xxhash64(title, "wikitext").alias("tie"), title.alias("title"), reason.alias("reason"), "wikitext")
    cleaned = clean_pages(staged, F.when(F.col("reason") == "ok", F.col("wikitext")), "body")
    staged = cleaned.select("ord", "tie", "title", "reason", "body")
    valid = (F.col("reason") == "ok") & (char_len("body") >= min_chars)
    blk = block(F.col("title"), F.col("body"))
    return staged.select("ord", "tie", "title", F.coalesce(valid, F.lit(False)).alias("valid"), F.when(valid, blk).alias("block"),
                         F.when(valid, byte_len(blk)).otherwise(0).cast("bigint").alias("n_bytes"))


def _manifest(counters: DataFrame, lang: str, size_limit_mb: float, output_file: str,
              license_note: str, source: str | None) -> DataFrame:
    return counters.select(
        "articles_kept", "articles_skipped", "bytes_written",
        F.lit(lang).alias("lang"), F.lit(float(size_limit_mb)).alias("size_limit_mb"),
        F.lit(output_file).alias("output_file"), F.lit(source).cast("string").alias("source"),
        F.lit(license_note).alias("license_note"))


def extract_article_corpus(articles: DataFrame, size_limit_mb: float = 100, min_chars: int = 500,
                           lang: str = "en", output_file: str = "", source: str = "articles",
                           n_buckets: int | None = None) -> Extraction:
    kept, counters = cut_at_budget(article_rows(articles, min_chars), limit_bytes(size_limit_mb), n_buckets, articles)
    return Extraction(kept.select("ord", "title", "block", "n_bytes"),
                      _manifest(counters, lang, size_limit_mb, output_file, LICENSE_NOTE_ARTICLES, source))


def extract_wiki_corpus(pages: DataFrame, size_limit_mb: float = 100, min_chars: int = 500,
                        lang: str = "en", output_file: str = "",
                        n_buckets: int | None = None) -> Extraction:
    spark = pages.sparkSession
    folder = os.path.join(ensure_checkpoint_dir(spark), f"cleaned-{uuid.uuid4().hex}")

    def written(rows: DataFrame) -> DataFrame:
        path = os.path.join(folder, uuid.uuid4().hex)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    kept, counters = cut_at_budget(wiki_rows(pages, min_chars), limit_bytes(size_limit_mb), n_buckets, pages, written)
    return Extraction(kept.select("ord", "title", "block", "n_bytes"),
                      _manifest(counters, lang, size_limit_mb, output_file, LICENSE_NOTE_XML, None))
