"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given tables (or views Spark derives from them) in
full.  Array results are rendered as space-joined strings so they compare
across engines; every computed column is aliased like its SQL oracle.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtok.functions.bytelevel import pretokenize, to_symbols
from loomtok.functions.text import (byte_len, char_len, lines_keep_newline, nfkc,
                                    normalize_whitespace, word_count)
from loomtok.operators import budget, clean, encode, evaluate, serving
from loomtok.operators.model import BpeModel
from loomtok.operators.pieces import pair_counts, piece_counts, words_from_pieces
from loomtok.operators.train import corpus_lines, train_on_texts
from loomtok.plans.models import BASELINE_MERGES, SPECIAL_MERGES, TRAIN_MERGES, documents_model, public_vocabulary
from loomtok.session import ensure_checkpoint_dir
from loomtok.sinks.writers import write_json_rows, write_text
from loomtok.sources import benchmarks, tables, xmldump
from loomtok.sources.artifacts import read_report
from loomtok.streaming.tokens import live_token_rows, live_token_totals
from loomtok.streaming.totals import stream_token_totals

BUDGET_MB = 1.0
MIN_CHARS = 500
PIECE_SEP = "\x01"

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark, d):
    return tables.table(spark, d, "documents")


# -- text functions ---------------------------------------------------------
def q_text_sizes(spark, d):
    return _docs(spark, d).select("doc_id", char_len("text").cast("bigint").alias("n_chars"),
                                  byte_len("text").cast("bigint").alias("n_bytes"))


def q_word_counts(spark, d):
    return _docs(spark, d).select("doc_id", word_count("text").cast("bigint").alias("n_words"))


def q_corpus_lines(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(lines_keep_newline("text")).alias("line_no", "line")) \
        .select("doc_id", F.col("line_no").cast("bigint"), "line")


def q_scan_articles_by_lang(spark, d):
    return tables.articles_by_lang(spark, d, "en")


def q_corpus_blocks(spark, d):
    rows = budget.article_rows(tables.articles(spark, d), MIN_CHARS)
    return rows.where("valid").select("ord", "title", "block", "n_bytes")


def q_normalize_whitespace(spark, d):
    return _docs(spark, d).select("doc_id", normalize_whitespace("text").alias("text_norm"))


def q_nfkc_normalize(spark, d):
    return tables.variants(spark, d).select("doc_id", nfkc("text").alias("text_nfkc"))


# -- pre-tokenization and counting -------------------------------------------
def q_pretokenize(spark, d):
    p = pretokenize(nfkc("text"))
    return _docs(spark, d).select("doc_id", F.size(p).cast("bigint").alias("n_pieces"),
                                  F.array_join(p, PIECE_SEP).alias("pieces"))


def q_byte_symbols(spark, d):
    return _docs(spark, d).select("doc_id", to_symbols("text").alias("symbols"))


def _training_piece_counts(spark, d):
    return piece_counts(corpus_lines(_docs(spark, d)), "line")


def q_piece_counts(spark, d):
    return _training_piece_counts(spark, d)


def q_pair_counts(spark, d):
    return pair_counts(words_from_pieces(_training_piece_counts(spark, d), 4))


# -- cleaning and extraction ---------------------------------------------------
def q_page_validity(spark, d):
    return clean.page_validity(tables.wiki_pages(spark, d), MIN_CHARS).select("ord", "reason")


def q_strip_templates(spark, d):
    return tables.wiki_pages(spark, d).select("ord", clean.strip_templates("wikitext").alias("stripped"))


def q_clean_wikitext(spark, d):
    pages = tables.wiki_pages(spark, d)
    return clean.clean_pages(pages.select("ord", "wikitext"), F.col("wikitext"), "cleaned").drop("wikitext")


def q_clean_markup_forms(spark, d):
    pages = tables.marked_articles(spark, d)
    return clean.clean_pages(pages, F.col("wikitext"), "cleaned").drop("wikitext")


def q_extract_wiki_corpus(spark, d):
    return budget.extract_wiki_corpus(tables.wiki_pages(spark, d), BUDGET_MB, MIN_CHARS).corpus


def q_clean_html_pages(spark, d):
    return tables.table(spark, d, "pages").select("page_id", clean.clean_html("html").alias("text"))


def q_extract_article_corpus(spark, d):
    return budget.extract_article_corpus(tables.articles(spark, d), BUDGET_MB, MIN_CHARS).corpus


def q_extraction_manifest(spark, d):
    ex = budget.extract_article_corpus(tables.articles_by_lang(spark, d, "en"), BUDGET_MB, MIN_CHARS,
                                       lang="en", output_file="en_corpus.txt", source="documents")
    return ex.manifest


def q_scan_xml_pages(spark, d):
    """Write the dump-shaped pages as a bz2 XML dump under the shared
    checkpoint folder, then scan it back."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"xml-dump-{uuid.uuid4().hex}")
    xmldump.write_pages(tables.wiki_pages(spark, d), path)
    return xmldump.read_pages(spark, path)


# -- training and the model tables ---------------------------------------------
def q_train_bpe(spark, d):
    return documents_model(spark, d).merges_df(spark)


def q_train_bpe_2000(spark, d):
    return documents_model(spark, d, TRAIN_MERGES).merges_df(spark)


def q_vocab_table(spark, d):
    return documents_model(spark, d).vocab_df(spark)


def q_vocab_info(spark, d):
    return serving.vocab_info(spark, documents_model(spark, d))


def q_training_config(spark, d):
    m = documents_model(spark, d)
    cfg = serving.training_config(_docs(spark, d), m, corpus_file="documents", tokenizer_file="model")
    return cfg.withColumn("special_tokens", F.to_json("special_tokens"))


# -- encoding / decoding -----------------------------------------------------
def _encoded(spark, d):
    m = documents_model(spark, d)
    return m, encode.encode_documents(_docs(spark, d), m)


def q_encode_documents(spark, d):
    _, e = _encoded(spark, d)
    return e.select("doc_id", F.array_join("ids", " ").alias("ids"), F.array_join("tokens", " ").alias("tokens"),
                    F.col("num_tokens").cast("bigint"), F.col("num_chars").cast("bigint"))


def q_token_offsets(spark, d):
    _, e = _encoded(spark, d)
    x = e.select("doc_id", F.posexplode(F.arrays_zip("ids", "offsets")).alias("pos", "t"))
    return x.select("doc_id", F.col("pos").cast("bigint"), F.col("t.ids").cast("bigint").alias("id"),
                    F.col("t.offsets.start").cast("bigint").alias("start"),
                    F.col("t.offsets.end").cast("bigint").alias("end"))


def q_ids_to_tokens(spark, d):
    m, e = _encoded(spark, d)
    x = encode.add_tokens(e.select("doc_id", "ids"), m)
    return x.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def q_detokenize(spark, d):
    m = documents_model(spark, d)
    docs = _docs(spark, d).select("doc_id", F.col("text").alias("original"))
    dec = encode.add_text(encode.add_encoding(docs, m, "original", {"ids": "ids"}), m)
    return dec.select("doc_id", "text", (F.col("text") == F.col("original")).alias("roundtrip"))


def q_vocab_usage(spark, d):
    m = documents_model(spark, d)
    return serving.vocab_usage(_docs(spark, d), m).select(
        F.col("id").cast("bigint"), "token", "kind", F.col("rank").cast("bigint"),
        F.col("left_id").cast("bigint"), F.col("right_id").cast("bigint"), "merge_freq", "uses")


def q_token_stream(spark, d):
    _, e = _encoded(spark, d)
    s = serving.token_stream(e)
    return s.select("doc_id", F.col("pos").cast("bigint"), F.col("id").cast("bigint"), "token", "display",
                    F.col("start").cast("bigint"), F.col("end").cast("bigint"),
                    F.col("char_span").cast("bigint"), "width_scale", F.col("band").cast("bigint"),
                    "chars_per_token")


def q_tokenize_rejects(spark, d):
    return serving.tokenize_rejects(tables.requests(spark, d))


def q_compare_models(spark, d):
    m = documents_model(spark, d)
    base = m.truncated(BASELINE_MERGES)
    r = serving.compare_models(_docs(spark, d), m, base)
    return r.select("doc_id", F.col("ours_num_tokens").cast("bigint"),
                    F.col("baseline_num_tokens").cast("bigint"), F.col("delta").cast("bigint"),
                    "delta_label", "ours_ids", "baseline_ids",
                    F.array_join("ours_tokens", " ").alias("ours_tokens"),
                    F.array_join("baseline_tokens", " ").alias("baseline_tokens"))


# -- benchmarks and evaluation --------------------------------------------------
def q_bench_rows(spark, d):
    return benchmarks.load_prose(spark, d)


def q_bench_lines(spark, d):
    return benchmarks.load_prose_lines(spark, d)


def q_bench_union(spark, d):
    return benchmarks.bench_union(spark, d, ["prose", "dialog"])


def q_benchmark_overlap(spark, d):
    return evaluate.benchmark_overlap(benchmarks.bench_union(spark, d, ["prose", "dialog"]), _docs(spark, d))


def _metrics(spark, d):
    m = documents_model(spark, d)
    return m, evaluate.eval_metrics(benchmarks.bench_union(spark, d, ["prose", "dialog"]), m)


def q_eval_metrics(spark, d):
    return _metrics(spark, d)[1]


def q_eval_report_nested(spark, d):
    m, r = _metrics(spark, d)
    return evaluate.report_json(r, m.vocab_size)


def q_benchmark_table(spark, d):
    return evaluate.summary_table(_metrics(spark, d)[1])


def q_benchmark_first_docs(spark, d):
    """The first 25 documents in order of each benchmark (``max_docs``)."""
    return benchmarks.bench_union(spark, d, ["prose", "dialog"], max_docs=25)


def _timed(spark, d):
    """The metrics with speeds that follow from the totals, so that they are
    the same in every run."""
    m = _metrics(spark, d)[1]
    return m.withColumns({"encode_chars_per_sec": (F.col("total_chars") * 7).cast("double"), "decode_chars_per_sec": (F.col("total_chars") * 90).cast("double")})


def q_ui_table(spark, d):
    return evaluate.ui_table(_timed(spark, d))


def q_report_roundtrip(spark, d):
    """The report written as a JSON file and read again, a row for each metric."""
    m, r = _metrics(spark, d)
    path = os.path.join(ensure_checkpoint_dir(spark), f"report-{uuid.uuid4().hex}")
    write_text(evaluate.report_json(r, m.vocab_size, "model"), path)
    back = read_report(spark, path)
    each = [F.struct(F.lit(b).alias("benchmark"), F.col(f"benchmarks.{b}.total_tokens").alias("total_tokens"),
                     F.col(f"benchmarks.{b}.tokens_per_word").alias("tokens_per_word")) for b in ("dialog", "prose")]
    return back.select("tokenizer_path", "vocab_size", F.explode(F.array(*each)).alias("m")).select("tokenizer_path", "vocab_size", "m.*")


def q_train_special_tokens(spark, d):
    """Merges learned with a list of special tokens of one's own."""
    m = train_on_texts(_docs(spark, d), 3 + 256 + SPECIAL_MERGES, special_tokens=["<a,b>", "<s>", "[x]"])
    return m.merges_df(spark)


def q_live_token_rows(spark, d):
    """The documents' files as they arrive: a row for each token."""
    rows = live_token_rows(spark, d, documents_model(spark, d), glob="documents.parquet")
    return rows.select("doc_id", *[F.col(c).cast("bigint") for c in ("pos", "id")], "token", *[F.col(c).cast("bigint") for c in ("start", "end")])


def q_live_token_totals(spark, d):
    return live_token_totals(spark, d, documents_model(spark, d), glob="documents.parquet")


def q_benchmark_disjointness(spark, d):
    return evaluate.benchmark_disjointness(benchmarks.bench_union(spark, d, ["prose", "dialog", "prose_lines"]))


def q_scan_article_snapshot(spark, d):
    """Two dated snapshots written as a partitioned table; one edition of one of them read."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"snapshots-{uuid.uuid4().hex}")
    tables.write_snapshots(tables.dated_articles(spark, d), path)
    return tables.article_snapshot(spark, path, "en", "20240401")


def q_scan_foreign_dump(spark, d):
    """A bz2 dump in the form of other programs, broken pages in it."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"foreign-{uuid.uuid4().hex}")
    xmldump.foreign_dump(_docs(spark, d)).write.option("compression", "bzip2").text(path)
    pages = xmldump.scan_pages(spark, path)
    return pages.select("ord", "title", "wikitext", F.col("broken").isNotNull().alias("broken"))


def q_tokenizer_roundtrip(spark, d):
    """The model written as tables and as JSON, and read again."""
    m = documents_model(spark, d)
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    m.save(spark, path)
    write_text(spark.createDataFrame([(m.to_json(),)], "value string"), f"{path}/json")
    back, other = BpeModel.load(spark, path), BpeModel.from_json(spark.read.text(f"{path}/json").first().value)
    same = back.tokens == other.tokens and [x[:3] for x in back.merges] == [x[:3] for x in other.merges]
    rows = [(r, back.tokens[a], back.tokens[b], back.tokens[n], n, same) for r, (a, b, n, _) in enumerate(back.merges)]
    return spark.createDataFrame(rows, "rank long, left_token string, right_token string, new_token string, new_id long, json_equal boolean")


def q_vocab_info_config(spark, d):
    """Special tokens as a training config tells them, and without one."""
    m = documents_model(spark, d)
    path = os.path.join(ensure_checkpoint_dir(spark), f"config-{uuid.uuid4().hex}")
    write_json_rows(serving.training_config(_docs(spark, d), m, tokenizer_file="model"), path)
    there, missing = (serving.vocab_info(spark, m, p).withColumn("config", F.lit(n)) for p, n in ((path, "there"), (f"{path}-none", "missing")))
    return there.unionByName(missing).select("config", "vocab_size", "special_tokens")


def q_compare_public(spark, d):
    """The trained model against a public vocabulary of 50,256 entries."""
    with open(public_vocabulary(), encoding="utf-8") as f:
        public = BpeModel.from_json(f.read())
    r = serving.compare_models(_docs(spark, d), documents_model(spark, d), public)
    return r.select("doc_id", *[F.col(c).cast("bigint") for c in ("ours_num_tokens", "baseline_num_tokens", "delta")])


def q_stream_token_totals(spark, d):
    return stream_token_totals(spark, d, documents_model(spark, d), glob="documents.parquet")


QUERIES: dict[str, Query] = {
    "text_sizes": q_text_sizes,
    "word_counts": q_word_counts,
    "corpus_lines": q_corpus_lines,
    "scan_articles_by_lang": q_scan_articles_by_lang,
    "corpus_blocks": q_corpus_blocks,
    "normalize_whitespace": q_normalize_whitespace,
    "nfkc_normalize": q_nfkc_normalize,
    "pretokenize": q_pretokenize,
    "byte_symbols": q_byte_symbols,
    "piece_counts": q_piece_counts,
    "pair_counts": q_pair_counts,
    "page_validity": q_page_validity,
    "strip_templates": q_strip_templates,
    "clean_wikitext": q_clean_wikitext,
    "clean_markup_forms": q_clean_markup_forms,
    "extract_wiki_corpus": q_extract_wiki_corpus,
    "clean_html_pages": q_clean_html_pages,
    "extract_article_corpus": q_extract_article_corpus,
    "extraction_manifest": q_extraction_manifest,
    "scan_xml_pages": q_scan_xml_pages,
    "train_bpe": q_train_bpe,
    "train_bpe_2000": q_train_bpe_2000,
    "vocab_table": q_vocab_table,
    "vocab_info": q_vocab_info,
    "training_config": q_training_config,
    "encode_documents": q_encode_documents,
    "token_offsets": q_token_offsets,
    "ids_to_tokens": q_ids_to_tokens,
    "detokenize": q_detokenize,
    "vocab_usage": q_vocab_usage,
    "token_stream": q_token_stream,
    "tokenize_rejects": q_tokenize_rejects,
    "compare_models": q_compare_models,
    "bench_rows": q_bench_rows,
    "bench_lines": q_bench_lines,
    "bench_union": q_bench_union,
    "benchmark_overlap": q_benchmark_overlap,
    "eval_metrics": q_eval_metrics,
    "eval_report_nested": q_eval_report_nested,
    "benchmark_table": q_benchmark_table,
    "benchmark_first_docs": q_benchmark_first_docs,
    "ui_table": q_ui_table,
    "report_roundtrip": q_report_roundtrip,
    "train_special_tokens": q_train_special_tokens,
    "stream_token_totals": q_stream_token_totals,
    "live_token_rows": q_live_token_rows,
    "live_token_totals": q_live_token_totals,
    "benchmark_disjointness": q_benchmark_disjointness,
    "scan_article_snapshot": q_scan_article_snapshot,
    "scan_foreign_dump": q_scan_foreign_dump,
    "tokenizer_roundtrip": q_tokenizer_roundtrip,
    "vocab_info_config": q_vocab_info_config,
    **({"compare_public": q_compare_public} if public_vocabulary() else {}),
}
