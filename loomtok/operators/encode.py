"""Encoding, decoding and token offsets.

One narrow pass: each Arrow batch of rows is split at special tokens,
NFKC-normalized, cut into pieces and encoded where it lies.  Nothing is
shuffled, joined or cached and no key is needed, so null, repeated and
composite keys are all the same to it.  A task keeps the encodings of the
pieces it has met, ``KEPT_PIECES`` at most, as bytes, so that a text is put
together by array operations; the model is broadcast once.

There is one rule for every vocabulary size: the adjacent pair of lowest
rank merges first, the leftmost of equal ones, as the trainer learned them.
A piece costs O(n log n) in its bytes (a heap of candidate pairs over a
linked list), so an unbroken run of any length is no special case.

Decoding and the lookup of tokens are column expressions: the vocabulary is
one constant array, ids are its places, and no Python runs.

A null text is encoded as an empty one.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.functions.bytelevel import ALPHABET, ALPHABET_BYTE_ORDER, piece_finder
from loomtok.functions.text import nfkc_alignment
from loomtok.operators.model import BpeModel

#: Pieces whose encoding a task keeps at most; half of them may be of before.
KEPT_PIECES = 400_000
#: Rows of one output batch: token structs take far more room than text.
OUT_ROWS = 256

OFFSETS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
COLUMNS = {"ids": T.ArrayType(T.IntegerType()), "tokens": T.ArrayType(T.StringType()), "offsets": OFFSETS,
           "num_tokens": T.IntegerType(), "num_chars": T.IntegerType()}


class Encoder:
    """A model ready for use in a task, made from ``BpeModel.plain()``."""

    def __init__(self, model: BpeModel | dict):
        plain = model if isinstance(model, dict) else model.plain()
        self.specials = plain["special_tokens"]
        self.tokens = plain["tokens"]
        self.sizes = list(map(len, self.tokens))  # one symbol a byte
        self.special_ids = {s: i for i, s in enumerate(self.specials)}
        base = {b: len(self.specials) + i for i, b in enumerate(ALPHABET_BYTE_ORDER)}
        self.byte_ids = [base[b] for b in range(256)]
        self.ranks = {(left, right): (rank, new) for rank, (left, right, new) in enumerate(plain["merges"].tolist())}
        alts = "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        self.cut = re.compile(f"({alts})").split if alts else lambda text: [text]
        self.find = piece_finder()
        self.special_entries = {s: (np.array([i], np.int32).tobytes(), np.array([0, len(s)], np.int32).tobytes()) for s, i in self.special_ids.items()}
        self.kept: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def merged(self, raw: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals."""
        ids = [self.byte_ids[b] for b in raw]
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in ranks]
        heapq.heapify(heap)
        while heap:
            (_, new), i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one side has merged since
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := (new, ids[after[i]])) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if before[i] >= 0 and (p := (ids[before[i]], new)) in ranks:
                heapq.heappush(heap, (ranks[p], before[i], p))
        return [x for x in ids if x >= 0]

    def piece(self, piece: str) -> tuple[bytes, bytes]:
        """ids, and each token's (first, end) characters within the piece, as
        int32; a token that begins inside a character has that character as
        its first."""
        raw = piece.encode("utf-8")
        ids, spans, at, chars, plain = self.merged(raw), [], 0, 0, len(raw) == len(piece)
        for i in ids:
            end = at + self.sizes[i]
            if plain:
                spans += (at, end)
            else:
                lead = sum(b & 0xC0 != 0x80 for b in raw[at:end])
                spans += (chars - (raw[at] & 0xC0 == 0x80), chars + lead)
                chars += lead
            at = end
        return array("i", ids).tobytes(), array("i", spans).tobytes()

    def known(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        """``piece`` of each.  When half of what may be kept has come
        together, only what is met again stays of what was there before."""
        kept = self.kept
        try:
            return list(map(kept.__getitem__, pieces))
        except KeyError:
            own = set(pieces)
            new = own.difference(kept)
            if len(kept) + len(new) > KEPT_PIECES // 2:
                self.older, self.kept = kept, (kept := {})
                new = own
            older = self.older
            for piece in new:
                kept[piece] = older.get(piece) or self.piece(piece)
            return list(map(kept.__getitem__, pieces))

    def entries(self, text: str) -> tuple[list[tuple[bytes, bytes]], list[int]]:
        """The pieces of NFKC text in order, special tokens among them, and
        their lengths."""
        entries, lengths = [], []
        for part in self.cut(text):
            if part in self.special_ids:
                entries.append(self.special_entries[part])
                lengths.append(len(part))
            elif part:
                pieces = self.find(part if part.isascii() else unicodedata.normalize("NFKC", part))
                entries += self.known(pieces)
                lengths += map(len, pieces)
        return entries, lengths

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([ids for ids, _ in self.entries(text)[0]]), np.int32)

    def full(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids and character spans (a row for each token) in the text as it
        was given."""
        entries, lengths = self.entries(text)
        ids = np.frombuffer(b"".join([ids for ids, _ in entries]), np.int32)
        spans = np.frombuffer(b"".join([spans for _, spans in entries]), np.int32).reshape(-1, 2)
        sizes = np.array(lengths, np.int32)
        tokens = np.array([len(ids) for ids, _ in entries], np.int32) // 4
        spans = spans + np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, tokens)[:, None]
        if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
            starts, ends = nfkc_alignment(text, self.specials)
            spans = np.stack([np.array(starts, np.int32)[spans[:, 0]], np.array(ends, np.int32)[spans[:, 1] - 1]], 1)
        return ids, spans


def _lists(rows: list[np.ndarray], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32()), values)


def add_encoding(df: DataFrame, model: BpeModel, text_col: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df`` with columns of the encoding: ``names`` says which
    (keys of ``COLUMNS``) and what they are called (default: all, as there)."""
    names = names or {c: c for c in COLUMNS}
    df = df.drop(*names.values())
    shared, at = df.sparkSession.sparkContext.broadcast(model.plain()), df.columns.index(text_col)

    def run(batches):
        encoder = Encoder(shared.value)
        tokens = pa.array(encoder.tokens, pa.string())
        for batch in batches:
            for a in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(a, OUT_ROWS)
                texts = [t or "" for t in part.column(at).to_pylist()]
                if "offsets" in names:
                    ids, spans = map(list, zip(*map(encoder.full, texts)))
                else:
                    ids, spans = [encoder.ids(t) for t in texts], []
                flat = pa.array(np.concatenate(ids))
                out = {"num_tokens": lambda: pa.array([len(x) for x in ids], pa.int32()),
                       "num_chars": lambda: pa.array([len(t) for t in texts], pa.int32()),
                       "ids": lambda: _lists(ids, flat),
                       "tokens": lambda: _lists(ids, tokens.take(flat))}
                if "offsets" in names:
                    both = np.concatenate(spans)
                    out["offsets"] = lambda: _lists(spans, pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["start", "end"]))
                yield pa.RecordBatch.from_arrays([*part.columns, *(out[c]() for c in names)], names=[*part.schema.names, *names.values()])

    fields = [T.StructField(name, COLUMNS[c]) for c, name in names.items()]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def encode_documents(df: DataFrame, model: BpeModel, text_col: str = "text", key: str | list[str] = "doc_id",
                     with_offsets: bool = True) -> DataFrame:
    """Per row of ``df``: key columns, ids, tokens, offsets (half-open
    character spans into the original text), num_tokens, num_chars."""
    keys = [key] if isinstance(key, str) else list(key)
    names = {c: c for c in COLUMNS if with_offsets or c != "offsets"}
    return add_encoding(df.select(*keys, F.col(text_col).alias("_text")), model, "_text", names).drop("_text")


def token_totals(df: DataFrame, model: BpeModel, text_col: str = "text", group_cols: list[str] | None = None) -> DataFrame:
    """Σ tokens per group: counted row by row, summed in each task first."""
    group_cols = group_cols or []
    counted = add_encoding(df.select(*group_cols, F.col(text_col).alias("_text")), model, "_text", {"num_tokens": "_n"})
    return counted.groupBy(*group_cols).agg(F.sum("_n").cast("bigint").alias("total_tokens"))


def id_counts(df: DataFrame, model: BpeModel, text_col: str = "text") -> DataFrame:
    """(id, uses) over all texts, counted within each task first."""
    shared = df.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches):
        encoder = Encoder(shared.value)
        uses = np.zeros(len(encoder.tokens), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    uses += np.bincount(encoder.ids(text), minlength=len(uses))
        some = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(uses[some])], ["id", "uses"])

    return df.select(text_col).mapInArrow(run, "id int, uses long").groupBy("id").agg(F.sum("uses").cast("bigint").alias("uses"))


# --------------------------------------------------------------------------
# decoding
# --------------------------------------------------------------------------
def _constant(values: list[str]) -> Column:
    """An array that Spark reads once, when it plans."""
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def tokens_of(ids: Column | str, model: BpeModel) -> Column:
    """array<string>: the tokens of an array of ids.  Unknown and null ids
    are dropped; a null array is null."""
    found = F.transform(ids, lambda i: F.get(_constant(model.tokens), i))
    return F.filter(found, lambda t: t.isNotNull())


def text_of(ids: Column | str, model: BpeModel, skip_special: bool = True) -> Column:
    """The text of an array of ids: special tokens are dropped unless
    ``skip_special`` is False, unknown and null ids always; bytes are read as
    UTF-8 with U+FFFD for what isn't."""
    raw_of = dict(zip(ALPHABET, ALPHABET_BYTE_ORDER))
    raw = [(b"" if skip_special else t.encode("utf-8")) if i < model.n_special else bytes(raw_of[c] for c in t) for i, t in enumerate(model.tokens)]
    digits = F.transform(ids, lambda i: F.get(_constant([b.hex() for b in raw]), i))
    return F.make_valid_utf8(F.unhex(F.array_join(digits, "")).cast("string"))


def add_tokens(df: DataFrame, model: BpeModel, ids_col: str = "ids", name: str = "tokens") -> DataFrame:
    """The rows of ``df`` with the tokens of their ids."""
    return df.select(*[c for c in df.columns if c != name], tokens_of(ids_col, model).alias(name))


def add_text(df: DataFrame, model: BpeModel, ids_col: str = "ids", name: str = "text", skip_special: bool = True) -> DataFrame:
    """The rows of ``df`` with the text of their ids."""
    return df.select(*[c for c in df.columns if c != name], text_of(ids_col, model, skip_special).alias(name))


def decode_documents(df: DataFrame, model: BpeModel, ids_col: str = "ids", key: str | list[str] = "doc_id",
                     skip_special: bool = True) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return add_text(df.select(*keys, F.col(ids_col).alias("_ids")), model, "_ids", "text", skip_special).drop("_ids")
