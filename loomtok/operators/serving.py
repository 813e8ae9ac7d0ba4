"""The serving calls (tokenize / detokenize / compare / vocab-size /
report) as DataFrame -> DataFrame operators over many texts at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.functions.text import byte_len, has_non_ws
from loomtok.operators.evaluate import ratio
from loomtok.operators.encode import add_encoding, id_counts
from loomtok.operators.model import BpeModel


def tokenize_rejects(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Null and empty requests are rejected (status 400 in the API), blank
    ones too (the UI doesn't send them); rejected rows stay in the output
    with their reason."""
    t = F.col(text_col)
    reason = F.when(t.isNull(), "null_text").when(F.length(t) == 0, "empty_text").when(~has_non_ws(t), "blank_text")
    return df.select(key, F.coalesce(reason, F.lit("ok")).alias("reason"),
                     reason.isNull().alias("accepted"))


def compare_models(df: DataFrame, ours: BpeModel, baseline: BpeModel, text_col: str = "text",
                   key: str | list[str] = "doc_id") -> DataFrame:
    """Same texts under two models, both in one narrow pass: ids and tokens
    of either side, token-count delta and its label."""
    keys = [key] if isinstance(key, str) else list(key)
    j = df.select(*keys, F.col(text_col).alias("_text"))
    for side, model in (("ours", ours), ("baseline", baseline)):
        j = add_encoding(j, model, "_text", {"ids": f"_{side}_ids", "tokens": f"{side}_tokens", "num_tokens": f"{side}_num_tokens"})
        j = j.withColumn(f"{side}_ids", F.array_join(f"_{side}_ids", " ")).drop(f"_{side}_ids")
    delta = F.col("ours_num_tokens") - F.col("baseline_num_tokens")
    label = (F.when(delta == 0, F.lit("Identical token count"))
             .when(delta < 0, F.concat(F.abs(delta).cast("string"), F.lit(" fewer tokens than baseline")))
             .otherwise(F.concat(delta.cast("string"), F.lit(" more tokens than baseline"))))
    return j.select(*keys, "ours_num_tokens", "baseline_num_tokens", delta.alias("delta"),
                    label.alias("delta_label"), "ours_ids", "baseline_ids", "ours_tokens", "baseline_tokens")


def token_stream(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per token chip: id, display text (Ġ shown as ·), character
    span, chip width min(1 + 0.18·span, 4), colour band id % 3."""
    per_token = ratio(F.col("num_chars"), F.greatest(F.lit(1), F.col("num_tokens")), 2)
    # what is one value for a document is worked out before its tokens are rows
    x = encoded.select(key, per_token.alias("_per_token"), F.arrays_zip("ids", "tokens", "offsets").alias("_t"))
    x = x.select(key, "_per_token", F.posexplode("_t").alias("pos", "t"))
    span = F.greatest(F.lit(1), F.col("t.offsets.end") - F.col("t.offsets.start"))
    widths = F.array(*[F.lit(min(round(1 + 0.18 * n, 4), 4.0)) for n in range(1, 18)])  # from 17 on it is 4
    return x.select(
        key, "pos", F.col("t.ids").alias("id"), F.col("t.tokens").alias("token"),
        F.replace(F.col("t.tokens"), F.lit("Ġ"), F.lit("·")).alias("display"),
        F.col("t.offsets.start").alias("start"), F.col("t.offsets.end").alias("end"),
        span.alias("char_span"),
        F.get(widths, F.least(span, F.lit(17)) - 1).alias("width_scale"),
        (F.col("t.ids") % 3).alias("band"),
        F.col("_per_token").alias("chars_per_token"))


def vocab_usage(corpus: DataFrame, model: BpeModel, text_col: str = "text") -> DataFrame:
    """Every vocabulary entry with its merge (if any; the first where a later
    one makes the same string) and how often it is emitted over a corpus."""
    spark = corpus.sparkSession
    merges = model.merges_df(spark).groupBy(F.col("new_id").alias("id")).agg(
        F.min(F.struct("rank", "left_id", "right_id", "freq")).alias("m")).select("id", "m.*")
    out = model.vocab_df(spark).join(F.broadcast(merges), "id", "left").join(id_counts(corpus, model, text_col), "id", "left")
    return out.select("id", "token", "kind", "rank", "left_id", "right_id",
                      F.col("freq").alias("merge_freq"),
                      F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses"))


def vocab_info(spark, model: BpeModel, config_path: str | None = None) -> DataFrame:
    """Vocabulary size, and the special tokens recorded in the training
    config at ``config_path`` ([] when it is missing) or the model's own."""
    if config_path is not None:
        from loomtok.sources.artifacts import read_special_tokens
        specials = read_special_tokens(spark, config_path)
    else:
        specials = model.special_tokens
    return spark.createDataFrame([(model.vocab_size, ",".join(specials))],
                                 "vocab_size bigint, special_tokens string")


def training_config(corpus: DataFrame, model: BpeModel, text_col: str = "text",
                    corpus_file: str = "", seconds: float | None = None, tokenizer_file: str | None = None) -> DataFrame:
    """Hyper-parameters and sizes; corpus size is Σ UTF-8 bytes.  Special
    tokens are an array, so they may hold any character."""
    cfg = corpus.agg(F.sum(byte_len(text_col)).cast("bigint").alias("corpus_size_bytes"))
    out = cfg.select(
        F.lit(model.vocab_size_requested).cast("bigint").alias("vocab_size_requested"),
        F.lit(model.vocab_size).cast("bigint").alias("vocab_size_actual"),
        F.lit(model.min_frequency).cast("bigint").alias("min_frequency"),
        F.array(*map(F.lit, model.special_tokens)).cast("array<string>").alias("special_tokens"),
        F.lit("ByteLevel").alias("pre_tokenizer"), F.lit("NFKC").alias("normalizer"),
        F.lit("BPE").alias("model"), F.lit(corpus_file).alias("corpus_file"),
        "corpus_size_bytes")
    if tokenizer_file is not None:
        out = out.withColumn("tokenizer_file", F.lit(tokenizer_file))
    if seconds is not None:
        out = out.withColumn("training_seconds", F.lit(float(seconds)))
    return out
