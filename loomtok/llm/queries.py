"""One query for each operator over its whole table, by production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtok.llm import (bpe_prefix, cover_repeats, dart_minhash, decontaminate, hdc_langid, kmeans_tree, line_spread, nbsvm,
                         negatives, ordered, page_text, rlz_repeats, scaled_sketch, turn_repair)
from loomtok.llm.shared import whole_texts


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    whole_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, n: int):
    return F.crc32(F.col(key).cast("string")) % n


def quality_model(spark: SparkSession, sf_dir: str) -> nbsvm.Model:
    return nbsvm.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                     may_learn=remainder("doc_id", 5) != 0)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = nbsvm.score(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    own = remainder("doc_id", 4)
    prototypes = hdc_langid.fit(docs, may_learn=own != 2)
    found = hdc_langid.predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", F.coalesce(own == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_prefix.encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe_prefix.decode(ids, path).select("doc_id", *bpe_prefix.digests(ids))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dart_minhash.groups(docs).select("doc_id", "class_id", "class_size", "first")


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = page_text.extract(pages, page_text.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cover_repeats.remove(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", cover_repeats.n_removed().alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = rlz_repeats.remove(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_spread.remove_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0, k=5, least=80)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, without their ends, repeated or given to the
    user, by a checksum of ``conv_id:turn``; nulls count as one space."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    own = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(named) % 20).alias("_h"))
    h = F.col("_h")
    own = own.where(h != 0).withColumns({
        "text": F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(h == 4, "user").otherwise(F.col("role"))})
    return own.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(h == 3, 2).otherwise(1)))).drop("_h", "_copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    found = turn_repair.summary(turn_repair.repair(damaged(turns)))
    found = found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")
    every = found.unionByName(turns.select("conv_id").distinct(), allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    held = every.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in found.columns if c != "conv_id"])
    return held.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumn("_key", F.concat(ordered.long_key(F.col("doc_id")), ordered.hash_key(F.col("text"))))
    dealt = scaled_sketch.add_sketch(ordered.with_next(keyed, "_key"))
    order = Window.partitionBy("_range").orderBy("_guest", "_key")
    both = dealt.withColumns({"_next": F.lead("text").over(order), "_near": F.lead("sketch").over(order)}).where(~F.col("_guest"))
    n, spare = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - spare), F.substr("_next", F.lit(1), spare))
    both = scaled_sketch.add_sketch(both.withColumn("_edited", edited), "_edited", "_changed")
    own, changed, near = map(F.col, ("sketch", "_changed", "_near"))
    return both.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
                       F.array_join(own, ",").alias("fingerprint"), F.array_join(changed, ",").alias("edited_fingerprint"),
                       scaled_sketch.likeness(own, changed).alias("near_edited"), scaled_sketch.likeness(own, near).alias("near_next"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_langid": op2_langid,
    "op3_bpe": op3_bpe,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_page_text": op5_page_text,
    "op6_decontaminate": op6_decontaminate,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_neighbours": op9_neighbours,
    "op10_line_spread": op10_line_spread,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_turn_repair": op12_turn_repair,
    "op13_fingerprints": op13_fingerprints,
}


# The stages of corpus_pipeline: (spark, docs, sf_dir) -> documents
#
# Each works on all rows of docs and gives its columns back, in their order,
# with further ones that have any names.  Null and empty texts are rows like
# others (each stage says what becomes of them), repeated rows and null keys
# are too; an empty table gives an empty one.

#: Columns that stages work on.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def renamed(docs: DataFrame) -> dict[str, str]:
    """Names for further columns that are in no operator's way."""
    return {c: f"_further{i}" for i, c in enumerate(docs.columns) if c not in OWN}


def back(result: DataFrame, docs: DataFrame) -> DataFrame:
    names = renamed(docs)
    return result.select([names.get(c, c) for c in docs.columns]).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects go.  Null and empty texts have the
    score of the model's constant; without labels of both classes all stay."""
    scored = nbsvm.score(docs.withColumnsRenamed(renamed(docs)), quality_model(spark, sf_dir), out_col="_score")
    return back(scored.where(F.col("_score") >= 0.3), docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts; every document stays, with an
    empty text if it had no other line.  Null texts stay null."""
    cut = line_spread.remove_lines(docs.withColumnsRenamed(renamed(docs)))
    return back(cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut, docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays; repeated rows are copies.  Null texts
    and texts without words are no duplicates and all stay."""
    return back(dart_minhash.keep_first(docs.withColumnsRenamed(renamed(docs))), docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a test item go; null and empty texts
    hold none; without test items all stay."""
    scanned = decontaminate.scan(docs.withColumnsRenamed(renamed(docs)), read(spark, sf_dir, "benchmark"))
    return back(decontaminate.remove(scanned), docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ids, n_tokens and whether the ids decode to the
    text; a null text is encoded as an empty one.  Columns of these names are
    replaced."""
    import public_tokenizers

    whole_texts(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe_prefix.decode(bpe_prefix.encode(docs, path, public_tokenizers.PATTERN), path, out_col="_decoded")
    return both.withColumns({"n_tokens": F.size("ids").cast("long"),
                             "exact": F.col("_decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")}).drop("_decoded")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", lines_stage),
    ("near_dedup", near_duplicates_stage),
    ("decontamination", decontaminate_stage),
    ("bpe", bpe_stage),
]
