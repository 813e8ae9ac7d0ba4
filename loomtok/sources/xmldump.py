"""Encyclopedia XML dumps (``<page>`` rows, bz2 or plain).

A dump is read as text that ends at each ``</page>``, so that a plain or bz2
file is split over tasks whatever its size (Spark's XML source reads a file
of many lines in one task); bz2 may be made of several streams.  Each
page is then parsed by itself with ``from_xml``, which ignores namespaces, so
any export version reads, and keeps the leading spaces and trailing newline
of ``<text>``.  Of several revisions of a page the first counts.  Absent
title -> '', absent/empty text -> null, absent id -> null.

A page that is no well-formed XML doesn't end the scan: ``scan_pages`` gives
it as a row with its source in ``broken`` and nothing else, ``read_pages``
leaves it out, ``broken_pages`` counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = ("title string, ns bigint, id bigint, "
               "revision array<struct<id:bigint, text:struct<_VALUE:string, _bytes:bigint>>>")
# Dump root element and its export namespace.
DUMP_ROOT = 'mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/"'


OPTIONS = {"ignoreSurroundingSpaces": "false", "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """ord, title, wikitext, broken."""
    text = spark.read.option("lineSep", "</page>").text(path)
    # what stands before the first page, and after the last, is none
    begin = F.instr("value", "<page>")
    source = text.where(begin > 0).select(F.concat(F.substr("value", begin), F.lit("</page>")).alias("source"))
    page = source.select(F.from_xml("source", PAGE_SCHEMA + ", _broken string", OPTIONS).alias("p"))
    whole = F.col("p._broken").isNull()
    return page.select(F.when(whole, F.col("p.id")).alias("ord"), F.when(whole, F.coalesce(F.col("p.title"), F.lit(""))).alias("title"),
                       F.when(whole, F.get("p.revision", F.lit(0)).getField("text").getField("_VALUE")).alias("wikitext"),
                       F.col("p._broken").alias("broken"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """ord, title, wikitext of the well-formed pages."""
    return scan_pages(spark, path).where(F.col("broken").isNull()).drop("broken")


def broken_pages(spark: SparkSession, path: str) -> int:
    return scan_pages(spark, path).where(F.col("broken").isNotNull()).count()


def write_pages(pages: DataFrame, path: str, compression: str = "bzip2") -> None:
    """Write (ord, title, wikitext) as a dump: page/title, ns, id,
    revision/id, revision/text with a ``bytes`` attribute."""
    text = F.struct(F.col("wikitext").alias("_VALUE"),
                    F.coalesce(F.octet_length("wikitext"), F.lit(0)).cast("bigint").alias("_bytes"))
    rows = pages.select(
        "title", F.lit(0).cast("bigint").alias("ns"), F.col("ord").alias("id"),
        F.array(F.struct(F.col("ord").alias("id"), text.alias("text"))).alias("revision"))
    (rows.write.mode("overwrite").format("xml").option("rootTag", DUMP_ROOT)
     .option("rowTag", "page").option("compression", compression).save(path))


def foreign_dump(docs: DataFrame) -> DataFrame:
    """``value``: lines of a dump as other programs write it, from (doc_id,
    text): escaped, with attributes, contributors and, for some, a redirect
    or a second revision; one in seven pages has a tag that never closes."""
    text = F.coalesce("text", F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    i = F.col("doc_id")
    revision = lambda body: F.concat(F.lit("    <revision>\n      <id>1</id>\n      <contributor><username>u</username><id>7</id></contributor>\n      "  # noqa: E731
                                           '<text xml:space="preserve" bytes="9">'), body, F.lit("</text>\n      <sha1>x</sha1>\n    </revision>\n"))
    page = F.concat(F.lit("  <page>\n    <title>T &amp; "), i.cast("string"), F.lit("</title>\n    <ns>0</ns>\n    <id>"), i.cast("string"), F.lit("</id>\n"),
                    F.when(i % 5 == 1, '    <redirect title="x &amp; y" />\n').otherwise(""), F.when(i % 7 == 3, "    <open>\n").otherwise(""),
                    revision(text), F.when(i % 4 == 2, revision(F.lit("an older one"))).otherwise(""), F.lit("  </page>"))
    return docs.select(page.alias("value"))
