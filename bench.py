"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints ONE JSON line.

Queries: corpus extraction under a byte budget (fast path and the XML-path
cleaning), the piece-count pass, exact BPE training, full per-document
encoding (ids + tokens + offsets) with the trained and with a public
vocabulary of 50,256 entries, ids alone, decoding, benchmark evaluation and
the streaming totals.  Throughputs are derived for comparison with the
reference's published encode/decode chars/s and training MB/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loomtok import get_spark  # noqa: E402
from loomtok.operators.budget import extract_article_corpus, extract_wiki_corpus  # noqa: E402
from loomtok.operators.encode import add_encoding, decode_documents, encode_documents  # noqa: E402
from loomtok.operators.evaluate import eval_metrics  # noqa: E402
from loomtok.operators.model import BpeModel  # noqa: E402
from loomtok.operators.pieces import piece_counts  # noqa: E402
from loomtok.operators.train import TrainStats, corpus_lines, train_on_texts  # noqa: E402
from loomtok.plans.models import vocab_for  # noqa: E402
from loomtok.sources.benchmarks import bench_union  # noqa: E402
from loomtok.sources.tables import articles, table, wiki_pages  # noqa: E402
from loomtok.streaming.totals import stream_token_totals  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MERGES = int(os.environ.get("BENCH_MERGES", "2000"))
BUDGET_MB = float(os.environ.get("BENCH_BUDGET_MB", "16"))


def sf_of(path: str) -> float | str:
    base = os.path.basename(path.rstrip("/"))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def large_model() -> BpeModel:
    """A public vocabulary of 50,256 entries; without its file, the trained one."""
    try:
        import public_tokenizers
    except ImportError:
        from loomtok.plans.models import documents_model
        return documents_model(SparkSession.active(), SF_DIR)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return BpeModel.from_json(f.read())


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_spark(f"local[{CPUS}]", app="loomtok-bench", shuffle_partitions=int(CPUS), driver_memory="16g")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    docs = table(spark, SF_DIR, "documents")
    # untimed warm-up: JVM class loading / JIT, Python workers, codegen
    warm = docs.limit(200)
    noop(extract_article_corpus(articles(spark, SF_DIR).limit(200), 0.1, 500).corpus)
    warm_model = train_on_texts(warm.select("text"), vocab_for(4))
    noop(decode_documents(encode_documents(warm, warm_model), warm_model))
    n_chars = docs.agg(F.sum(F.length("text"))).first()[0]
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0]

    def extract():
        ex = extract_article_corpus(articles(spark, SF_DIR), BUDGET_MB, 500)
        noop(ex.corpus)
        return ex.manifest.first()
    timed("extract_article_corpus", extract)

    def extract_wiki():
        ex = extract_wiki_corpus(wiki_pages(spark, SF_DIR), BUDGET_MB, 500)
        noop(ex.corpus)
        return ex.manifest.first()
    timed("extract_wiki_corpus", extract_wiki)

    timed("piece_counts", lambda: noop(piece_counts(corpus_lines(docs.select("text")), "line")))

    stats = TrainStats()
    model = timed("train_bpe", lambda: train_on_texts(docs.select("text"), vocab_for(MERGES), stats=stats))

    # every timer holds all of its query's work; nothing is prepared before it
    timed("encode_documents", lambda: noop(encode_documents(docs, model)))
    large = large_model()
    timed("encode_documents_50k", lambda: noop(encode_documents(docs, large)))
    timed("encode_ids_50k", lambda: noop(add_encoding(docs.select("doc_id", "text"), large, "text", {"ids": "ids"})))
    enc = add_encoding(docs.select("doc_id", "text"), large, "text", {"ids": "ids"}).drop("text").persist()
    enc.count()
    timed("decode_documents_50k", lambda: noop(decode_documents(enc, large)))
    enc.unpersist()

    timed("eval_metrics", lambda: eval_metrics(bench_union(spark, SF_DIR, ["prose", "dialog"]), model).collect())
    timed("stream_token_totals",
          lambda: stream_token_totals(spark, SF_DIR, model, glob="documents.parquet").collect())

    total = round(sum(times.values()), 3)
    out = {
        "metric": "total_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf_of(SF_DIR),
        "derived": {
            "encode_chars_per_sec": round(n_chars / times["encode_documents"], 1),
            "encode_50k_chars_per_sec": round(n_chars / times["encode_documents_50k"], 1),
            "encode_50k_ids_chars_per_sec": round(n_chars / times["encode_ids_50k"], 1),
            "decode_50k_chars_per_sec": round(n_chars / times["decode_documents_50k"], 1),
            "vocab_size": model.vocab_size,
            "vocab_size_50k": large.vocab_size,
            "train_seconds_per_merge": round(times["train_bpe"] / max(1, len(model.merges)), 4),
            "train_mb_per_sec": round(n_bytes / 1e6 / times["train_bpe"], 3),
            "train_merges": len(model.merges),
            "train_rounds": stats.rounds,
            "corpus_chars": n_chars,
        },
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
