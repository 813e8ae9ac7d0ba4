"""Table scans and the derived views the operators run on.

All views are plain projections of the given parquet tables, so Catalyst
prunes columns and pushes filters (e.g. ``lang``) into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy narrow work (regex cleaning, pre-tokenization,
    encoding) every core when the scan yields fewer splits than cores — e.g. a small file
    written as one row group, which Spark reads in ONE task.  Other inputs
    keep their scan partitioning and pay no shuffle, so the number of
    partitions never falls.  Filters and projections above still push into the
    scan below the repartition."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def table(spark: SparkSession, sf_dir: str, name: str, balance: bool = True) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if balance else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-cleaned article stream: (ord, title, lang, text)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("ord"),
                    F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("title"),
                    "lang", "text")


def articles_by_lang(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """The language edition is a filter on ``lang`` (a partition filter when
    the table is partitioned by it)."""
    return articles(spark, sf_dir).where(F.col("lang") == lang)


SNAPSHOT_SCHEMA = "ord long, title string, text string, snapshot string, lang string"


def write_snapshots(articles: DataFrame, path: str) -> None:
    """Articles (ord, title, text, snapshot, lang) as a table partitioned by
    dated snapshot and language edition; one with neither is kept apart."""
    articles.select("ord", "title", "text", "snapshot", "lang").write.partitionBy("snapshot", "lang").parquet(path)


def article_snapshot(spark: SparkSession, path: str, lang: str, snapshot: str) -> DataFrame:
    """One language edition of one dated snapshot: both are partition
    filters, so no other edition's files are opened."""
    table = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    return table.where((F.col("snapshot") == snapshot) & (F.col("lang") == lang)).select("ord", "title", "lang", "text")


def dated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in two snapshots: some are only in one, those of the
    later one end in a further line."""
    own, i = articles(spark, sf_dir), F.pmod(F.col("ord"), F.lit(4))
    early = own.where(i != 3).withColumn("snapshot", F.lit("20231101"))
    late = own.where(i != 0).withColumns({"snapshot": F.lit("20240401"), "text": F.concat("text", F.lit("\nrevised"))})
    return early.unionByName(late)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tokenize requests, some of them null, empty or blank."""
    i = F.pmod(F.col("doc_id"), F.lit(7))
    text = (F.when(i == 0, F.lit(None).cast("string")).when(i == 1, "").when(i == 2, " \t\n\u00a0\u3000")
            .when(i == 3, F.concat(F.lit(" "), F.col("text"))).otherwise(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


# Forms that NFKC changes, after a document's text: one for each remainder of doc_id.
VARIANTS = [" \ufb01ne", " \uff21\uff22", " e\u0301", " x\u00b2", " \u2460\u00bd", " \uff8a\uff9f", " \u1e9b\u0323", " \u212b\u2126", " \u03b1\u0301\u0436\u4e2d", " \u1100\u1161\u11a8"]


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.element_at(F.array(*map(F.lit, VARIANTS)), (F.pmod(F.col("doc_id"), F.lit(len(VARIANTS))) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", form).alias("text"))


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump-shaped pages with every filter branch and markup form: the
    ``wiki_pages`` fixture view (ord, title, wikitext)."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    nl = F.lit("\n")
    prefix = (F.when(i % 17 == 0, "Category:").when(i % 19 == 0, "File:")
              .when(i % 29 == 0, "category:").otherwise(""))
    title = F.concat(prefix, F.lit("doc"), i.cast("string"))
    marked = F.concat(
        F.lit("{{Infobox|a={{b|c}}|d={{e|{{f}}}}}}"), nl, F.lit("== Head =="), nl,
        F.lit("<!-- note -->[[Quito|a high city]] and [[Rome]] "), F.col("text"),
        F.lit('[1][22]<ref name="x"/><ref>cite</ref>  &lt;ok&gt; &amp;amp;'), F.lit("\n" * 4),
        F.lit("tail"), F.lit("\t"), F.lit(" end [[File:x.jpg|thumb|see [[Oslo]]]] [[Category:Z]] "
                                          "[https://a.b label] '''bold''' {| x"),
        nl, F.lit("| y |}"))
    wikitext = (F.when(i % 23 == 0, F.lit(None).cast("string"))
                .when(i % 11 == 0, F.concat(F.lit("  #REDIRECT [[doc"), (i + 1).cast("string"),
                                            F.lit("]]"), F.col("text")))
                .when(i % 13 == 0, F.concat(F.col("text"), F.lit("{{Disambig}}")))
                .otherwise(marked))
    return d.select(i.alias("ord"), title.alias("title"), wikitext.alias("wikitext"))


# Markup in front of a document's text, one form for each remainder of
# doc_id: depth, nesting, references, bare brackets, character references.
MARKUP_FORMS = [
    "{{a" * 12 + "|x" + "}}" * 12 + "deep ",
    "{{Infobox|x=\n{| class=y\n| cell {{z}}\n|}\n}}table in template ",
    "{{{1|q}}}parameter {{t|{{{2|}}}}}",
    "pre <references> mid <ref name=a>cite</ref><ref name='b' />post </references>",
    "a < b and c > d, x<y>z</y> 1<2\n\n",
    "&ndash;&mdash;&eacute;&#8211;&#x2013;&amp;lt; &nosuch; & ",
    "[[File:a.jpg|thumb|see [[Oslo|the city]] and {{x}}]][[Rome]]n [[Quito|a high city]] ",
    "[https://a.b the label] [http://c.d] == no head ==\n== Head ==\n'''bold''' ''it'' ",
    "open {{ never closed and }} closed, stray }} and [[ open ",
]


def marked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents behind the ``MARKUP_FORMS``: (ord, wikitext)."""
    d = table(spark, sf_dir, "documents")
    form = F.element_at(F.array(*map(F.lit, MARKUP_FORMS)), (F.pmod(F.col("doc_id"), F.lit(len(MARKUP_FORMS))) + 1).cast("int"))
    return d.select(F.col("doc_id").alias("ord"), F.concat(form, F.col("text")).alias("wikitext"))
