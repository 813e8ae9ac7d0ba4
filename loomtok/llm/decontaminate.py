"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are runs of ASCII letters and digits and of any other characters, with
A-Z lowered.  A test item's windows are its runs of ``window`` words; an
item of fewer words is one window.  The windows' hashes go to every executor
in blocks of ``BLOCK_BYTES`` of test text, each block checked before it is
sent, and each document is scanned against every block.  A hash hit is
verified on the words themselves.

``scan`` returns the documents with ``n_words``, ``hits`` (spans of hit
words, from first to past the last, in word positions, and the bytes they
stand in) and ``items`` (ids of items with a window in the text, sorted as
strings).  ``remove`` drops the hit documents or cuts the hit spans.

Nulls: a null text has no words and is never hit; a null item id counts as
an item named by the empty string; a null item text has no window.  Empty
tables give empty results (no test items: nothing is hit).  Repeated rows
are scanned each by itself; two items with one text are both reported, and
rows of one item_id count once.  Columns of the documents that have the new
columns' names are replaced; others stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.flat import Runs, Words, byte_class, byte_rows, room, row_slices, with_columns

#: Bytes of test texts in one broadcast; more test text is scanned in several blocks.
BLOCK_BYTES = 16 << 20
WINDOW = 10

WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256)
LOWER[0x41:0x5B] += 32

SPAN = T.StructType([T.StructField(n, T.IntegerType(), False) for n in ("start", "end", "from_byte", "to_byte")])
HITS = T.ArrayType(SPAN, False)
ITEMS = T.ArrayType(T.StringType(), False)


class Grams:
    """The windows of a block of items: by length the sorted hashes, and by
    length and hash the windows' words and items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        words, runs = Words(WORD_BYTES, LOWER), Runs()
        self.found: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item, text in items:
            data = LOWER.astype(np.uint8)[np.frombuffer(text.encode("utf-8"), np.uint8)]
            starts, ends, _ = words.split(data, np.array([0, len(data)]))
            if not len(starts):
                continue
            n = min(window, len(starts))
            for i, h in enumerate(runs.of(runs.sums(words.hashes(data, starts, ends)), n).tolist()):
                text_of = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i:i + n], ends[i:i + n]))
                self.found.setdefault(n, {}).setdefault(h, {}).setdefault(text_of, set()).add(item)
        self.sorted = {n: np.sort(np.array(list(d), np.uint64)) for n, d in self.found.items()}
        # one bit for each value of a hash's first 20 bits: most windows end here
        self.seen = {}
        for n, h in self.sorted.items():
            self.seen[n] = np.zeros(1 << 20, np.bool_)
            self.seen[n][h >> np.uint64(44)] = True

    def hits(self, n: int, h: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.seen[n][h >> np.uint64(44)])
        spot = np.searchsorted(self.sorted[n], h[at])
        spot[spot == len(self.sorted[n])] = 0
        return at[self.sorted[n][spot] == h[at]]


def _blocks(bench: DataFrame, item_col: str, text_col: str):
    """Items of at most BLOCK_BYTES together (or a single one), a block at a
    time, in ranges of a number dealt out by the sizes."""
    items = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * n_bytes // BLOCK_BYTES)) if n_bytes > BLOCK_BYTES else 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield items.where(block == k) if n > 1 else items


def scan(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text_col: str = "text",
         item_col: str = "item_id", bench_text_col: str = "text") -> DataFrame:
    docs = docs.drop("n_words", "hits", "items").withColumns(
        {"n_words": F.lit(0).cast("long"), "hits": F.lit(None).cast(HITS), "items": F.lit(None).cast(ITEMS)})
    for block in _blocks(bench, item_col, bench_text_col):
        docs = _scan_block(docs, [(r.item, r.text) for r in block.toLocalIterator()], window, text_col)
    return docs.withColumns({"hits": F.coalesce("hits", F.array().cast(HITS)),
                             "items": F.array_sort(F.array_distinct(F.coalesce("items", F.array().cast(ITEMS))))})


def ready(shared: dict) -> Grams:
    """The ``Grams`` of a broadcast, made once in each worker process."""
    if "grams" not in shared:
        shared["grams"] = Grams(shared["items"], shared["window"])
    return shared["grams"]


def _scan_block(docs: DataFrame, items: list[tuple[str, str]], window: int, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast({"items": items, "window": window})
    names = docs.columns

    def run(batches):
        grams = ready(shared.value)
        words, runs = Words(WORD_BYTES, LOWER), Runs()
        lower = LOWER.astype(np.uint8)
        for batch in batches:
            data, offs = byte_rows(batch.column(names.index(text_col)))
            before = {c: batch.column(names.index(c)) for c in ("hits", "items")}
            for lo, hi in row_slices(offs):
                part, at = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                starts, ends, first = words.split(part, at)
                left = room(first, len(starts))
                sums = runs.sums(words.hashes(part, starts, ends))
                mark = np.zeros(len(starts) + 1, np.int32)
                items: dict[int, set[str]] = {}
                for n, known in grams.found.items():
                    h = runs.of(sums, n)
                    for i in grams.hits(n, h):
                        if left[i] < n:
                            continue
                        text = b" ".join(lower[part[a:b]].tobytes() for a, b in zip(starts[i:i + n], ends[i:i + n]))
                        if found := known[int(h[i])].get(text):
                            mark[i] += 1
                            mark[i + n] -= 1
                            items.setdefault(int(np.searchsorted(first, i, "right")) - 1, set()).update(found)
                covered = np.cumsum(mark) > 0  # over all rows: a window's end marks the next row's first word
                spans, named = [None] * (hi - lo), [None] * (hi - lo)
                for r, found in items.items():
                    old = before["hits"][lo + r].as_py() or []
                    a, b = first[r], first[r + 1]
                    hit = covered[a:b].copy()
                    for s in old:
                        hit[s["start"]:s["end"]] = True
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
                    spans[r] = [{"start": int(s), "end": int(e), "from_byte": int(starts[a + s] - at[r]),
                                 "to_byte": int(ends[a + e - 1] - at[r])} for s, e in zip(edge[::2], edge[1::2])]
                    named[r] = sorted(found.union(before["items"][lo + r].as_py() or ()))
                for r in range(hi - lo):
                    if r not in items:
                        spans[r], named[r] = before["hits"][lo + r].as_py(), before["items"][lo + r].as_py()
                rest = batch.slice(lo, hi - lo).select([c for c in names if c not in ("n_words", "hits", "items")])
                yield with_columns(rest, n_words=pa.array(np.diff(first), pa.int64()),
                                   hits=pa.array(spans, schema_hits), items=pa.array(named, pa.list_(pa.string())))

    schema_hits = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "from_byte", "to_byte")]))
    return docs.mapInArrow(run, docs.schema)


def n_hit(hits: str = "hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def remove(scanned: DataFrame, spans: bool = False, text_col: str = "text") -> DataFrame:
    """Without the hit documents, or (``spans``) with the hit words' bytes
    cut out of each text; the scan's own columns go."""
    clean = scanned.where(F.size("hits") == 0)
    if spans:
        raw = F.encode(text_col, "utf-8")
        ends = F.transform("hits", lambda s: s["to_byte"])
        begins = F.transform("hits", lambda s: s["from_byte"])
        pieces = F.transform(F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("a"),
                                          F.concat(begins, F.array(F.octet_length(text_col))).alias("b")),
                             lambda p: F.decode(F.substring(raw, p["a"] + 1, p["b"] - p["a"]), "utf-8"))
        clean = scanned.withColumn(text_col, F.when(F.size("hits") == 0, F.col(text_col)).otherwise(F.concat_ws("", pieces)))
    return clean.drop("n_words", "hits", "items")
