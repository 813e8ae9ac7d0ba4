"""Tokenizer evaluation over named benchmark sets.

Totals per benchmark are one aggregation over the encoded rows.  Throughput is
timed inside the tasks and is reported next to, never inside, the
deterministic metrics.
"""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.functions.bytelevel import ALPHABET, ALPHABET_BYTE_ORDER
from loomtok.functions.text import byte_len, char_len, has_non_ws, strip_ws, word_count
from loomtok.operators.encode import Encoder, add_encoding
from loomtok.operators.model import BpeModel

# Metric names of the report.
METRIC_COLUMNS = ["benchmark", "num_documents", "total_words", "total_tokens", "total_chars",
                  "total_bytes_utf8", "tokens_per_word", "compression_ratio_bytes_per_token"]
TIMED = ["num_documents", "total_words", "total_tokens", "total_chars", "total_bytes_utf8", "encode_seconds", "decode_seconds"]


def ratio(a, b, digits: int = 4):
    """round(a / b, digits), half-up on the exact rational (integer
    arithmetic, so every engine agrees on ties); null when b is 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    sc = 10 ** digits
    whole = "decimal(38,0)"   # totals of 10**17 times 2 * 10**4 are past bigint
    num = a.cast(whole) * F.lit(2 * sc).cast("decimal(6,0)") + b.cast(whole)
    q = F.call_function("div", num.cast(whole), F.nullif(b.cast(whole) * F.lit(2).cast("decimal(1,0)"), F.lit(0).cast(whole)).cast(whole))
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(q.cast("double") / F.lit(float(sc)))


def group_totals(df: DataFrame, model: BpeModel, group_col: str, text_col: str = "text") -> DataFrame:
    """Per group: documents, words, tokens, chars and UTF-8 bytes, in one
    pass and one aggregation."""
    rows = add_encoding(df.select(group_col, text_col), model, text_col, {"num_tokens": "_n"})
    return rows.groupBy(group_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("num_documents"),
        F.sum(word_count(text_col)).cast("bigint").alias("total_words"),
        F.sum("_n").cast("bigint").alias("total_tokens"),
        F.sum(char_len(text_col)).cast("bigint").alias("total_chars"),
        F.sum(byte_len(text_col)).cast("bigint").alias("total_bytes_utf8"))


def eval_metrics(bench: DataFrame, model: BpeModel) -> DataFrame:
    j = group_totals(bench, model, "benchmark")
    return j.select(*METRIC_COLUMNS[:-2],
                    ratio("total_tokens", "total_words").alias("tokens_per_word"),
                    ratio("total_bytes_utf8", "total_tokens").alias("compression_ratio_bytes_per_token"))


def timed_report(bench: DataFrame, model: BpeModel) -> DataFrame:
    """Metrics plus encode/decode seconds and chars/s per benchmark, in one
    pass over all benchmarks: tasks time their own work and sum it up, so
    seconds are those of one core and chars/s a core's speed.

    Encode time covers encoding, word split and byte counting; decode time
    covers decoding only (as in the reference)."""
    shared = bench.sparkSession.sparkContext.broadcast(model.plain())
    raw_of, n_special = dict(zip(ALPHABET, ALPHABET_BYTE_ORDER)), model.n_special

    def run(batches):
        encoder = Encoder(shared.value)
        raw = [t.encode("utf-8") if i < n_special else bytes(raw_of[c] for c in t) for i, t in enumerate(encoder.tokens)]
        sums: dict[str, list] = {}
        for batch in batches:
            for name, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                text = text or ""
                t0 = time.perf_counter()
                ids = encoder.ids(text).tolist()
                words, size = len(text.split()), len(text.encode("utf-8"))
                t1 = time.perf_counter()
                b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace")
                t2 = time.perf_counter()
                own = sums.setdefault(name, [0, 0, 0, 0, 0, 0.0, 0.0])
                for i, x in enumerate((1, words, len(ids), len(text), size, t1 - t0, t2 - t1)):
                    own[i] += x
        yield pa.RecordBatch.from_pydict(
            {"benchmark": pa.array(list(sums), pa.string())} |
            {c: pa.array([x[i] for x in sums.values()], pa.int64() if i < 5 else pa.float64()) for i, c in enumerate(TIMED)})

    kinds = ", ".join(f"{c} {'long' if i < 5 else 'double'}" for i, c in enumerate(TIMED))
    parts = bench.select("benchmark", "text").mapInArrow(run, f"benchmark string, {kinds}")
    sums = parts.groupBy("benchmark").agg(*[F.sum(c).alias(c) for c in TIMED])
    speed = lambda c: F.when(F.col(c) > 0, F.round(F.col("total_chars") / F.col(c), 1))
    return sums.select(*METRIC_COLUMNS[:-2], ratio("total_tokens", "total_words").alias("tokens_per_word"),
                       ratio("total_bytes_utf8", "total_tokens").alias("compression_ratio_bytes_per_token"),
                       F.round("encode_seconds", 4).alias("encode_seconds"), F.round("decode_seconds", 4).alias("decode_seconds"),
                       speed("encode_seconds").alias("encode_chars_per_sec"), speed("decode_seconds").alias("decode_chars_per_sec"))


def report_json(report: DataFrame, vocab_size: int, tokenizer_path: str | None = None) -> DataFrame:
    """Nested report {[tokenizer_path,] vocab_size, benchmarks: {name:
    {metrics}}} as one JSON string (benchmarks in name order, nulls kept)."""
    metric_cols = [c for c in report.columns if c != "benchmark"]
    entries = F.array_sort(F.collect_list(F.struct(F.col("benchmark").alias("key"),
                                                   F.struct(*metric_cols).alias("value"))))
    path = [F.lit(tokenizer_path).alias("tokenizer_path")] if tokenizer_path is not None else []
    nested = F.struct(*path, F.lit(vocab_size).cast("bigint").alias("vocab_size"),
                      F.map_from_entries(entries).alias("benchmarks"))
    return report.agg(F.to_json(nested, {"ignoreNullFields": "false"}).alias("report_json"))


def summary_table(report: DataFrame) -> DataFrame:
    """Markdown summary rows: | name | tokens/word | bytes/token | [speeds] |."""
    cells = [F.col("benchmark"), F.col("tokens_per_word").cast("string"),
             F.col("compression_ratio_bytes_per_token").cast("string")]
    if "encode_chars_per_sec" in report.columns:
        cells += [F.format_number("encode_chars_per_sec", 0), F.format_number("decode_chars_per_sec", 0)]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return report.select("benchmark", row.alias("markdown_row"))


def ui_table(report: DataFrame) -> DataFrame:
    """The web table's cell formats: ratios with 3 decimals, speeds as
    thousands of chars/s."""
    cells = [F.col("benchmark"),
             F.format_string("%.3f", "tokens_per_word").alias("tokens_per_word"),
             F.format_string("%.3f", "compression_ratio_bytes_per_token").alias("bytes_per_token")]
    if "encode_chars_per_sec" in report.columns:
        for c, name in (("encode_chars_per_sec", "encode_speed"), ("decode_chars_per_sec", "decode_speed")):
            cells.append(F.concat(F.format_string("%.0f", F.col(c) / 1000), F.lit("k chars/s")).alias(name))
    return report.select(*cells)


def _lines(df: DataFrame, text_col: str, keys: list[str]) -> DataFrame:
    """keys, line: the stripped lines that aren't blank."""
    x = df.select(*keys, F.explode(F.split(F.col(text_col), "\n")).alias("line"))
    return x.select(*keys, strip_ws("line").alias("line")).where(has_non_ws("line"))


def benchmark_disjointness(bench: DataFrame) -> DataFrame:
    """For each two benchmarks of ``bench``: their distinct non-blank lines,
    how many they share, and whether they share none.

    One aggregation by line says in which benchmarks it is (names, not rows,
    are collected, and each task reduces its own first); a second one counts
    the pairs of names.  Pairs without a shared line, and benchmarks without
    lines, are in the result too."""
    pair = lambda names: F.flatten(F.transform(names, lambda a: F.transform(
        F.filter(names, lambda b: b >= a), lambda b: F.struct(a.alias("benchmark_a"), b.alias("benchmark_b")))))
    held = _lines(bench, "text", ["benchmark"]).groupBy("line").agg(F.sort_array(F.collect_set("benchmark")).alias("names"))
    shared = held.select(F.explode(pair("names")).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    every = bench.agg(F.sort_array(F.collect_set("benchmark")).alias("names")).select(F.explode(pair("names")).alias("p"))
    # a few rows: the pairs of names
    counts = every.join(F.broadcast(shared), "p", "left").select("p.*", F.coalesce("n", F.lit(0)).alias("n"))
    own = counts.where("benchmark_a = benchmark_b").select(F.col("benchmark_a").alias("name"), F.col("n").alias("lines"))
    out = counts.where("benchmark_a < benchmark_b")
    for side in "ab":
        out = out.join(F.broadcast(own.select(F.col("name").alias(f"benchmark_{side}"), F.col("lines").alias(f"lines_{side}"))), f"benchmark_{side}")
    return out.select("benchmark_a", "benchmark_b", "lines_a", "lines_b", F.col("n").alias("shared_lines"),
                      ratio("n", F.col("lines_a") + F.col("lines_b") - F.col("n")).alias("jaccard"), (F.col("n") == 0).alias("disjoint"))


def benchmark_overlap(bench: DataFrame, corpus: DataFrame, corpus_text_col: str = "text",
                      max_broadcast_lines: int = 1_000_000,
                      max_broadcast_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Contamination check: share of each benchmark's non-blank lines that
    also occur as a line of the corpus.  A left-semi join on the stripped
    line; the corpus side is reduced to distinct lines first."""
    lines = _lines
    b = lines(bench, "text", ["benchmark"])
    bl = b.select("line").distinct()
    size = bl.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line")).alias("s")).first()
    if size.n <= max_broadcast_lines and (size.s or 0) + 64 * size.n <= max_broadcast_bytes:
        # benchmark lines proven small: filter the corpus against them with a
        # broadcast semi-join (narrow — the corpus is never shuffled), then
        # dedupe only the matches
        c = lines(corpus, corpus_text_col, []).join(F.broadcast(bl), "line", "left_semi").distinct()
    else:
        c = lines(corpus, corpus_text_col, []).distinct()
    hit = b.join(c, "line", "left_semi").groupBy("benchmark").agg(F.count(F.lit(1)).alias("overlapping_lines"))
    tot = b.groupBy("benchmark").agg(F.count(F.lit(1)).alias("total_lines"))
    j = tot.join(hit, "benchmark", "left").withColumn(
        "overlapping_lines", F.coalesce("overlapping_lines", F.lit(0)).cast("bigint"))
    return j.select("benchmark", F.col("total_lines").cast("bigint"), "overlapping_lines",
                    ratio("overlapping_lines", "total_lines").alias("overlap_ratio"))
