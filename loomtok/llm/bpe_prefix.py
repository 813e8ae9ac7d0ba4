"""Byte-level BPE by prefix dynamic programming, and decoding.

For each prefix of a piece the encoder keeps one number: the last token of
that prefix's encoding.  A prefix's encoding is unique, so the token list is
read off by walking back from the end.  A token may end a prefix when it
can follow the last token of what is before it, which depends on those two
tokens alone (``Ranks.can_follow``).  Rows already filled never change, so
bytes can be appended exactly, and after an edit only the prefixes from the
edit on are filled again.

``encode``: the frame's rows with ``ids array<int>`` added.  A null text has
no ids (an empty array), and so has an empty one.  ``decode``: the rows with
``decoded binary`` added; ids out of the vocabulary and nulls are an error,
null arrays give empty bytes.  Rows keep their partition, nothing is
shuffled and no key is needed, so repeated rows and clashing ids don't
matter.  The new column must not be there already: a column with its name is
replaced.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from array import array as pack
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.flat import byte_rows, row_slices, same_rows, with_columns

#: Words whose ids a worker keeps.
KEPT_WORDS = 300_000
#: Steps of the automaton and pairs of neighbours that a worker remembers.
KEPT_STEPS = 500_000
#: Longer words (whole texts among them) are encoded each time they come.
KEPT_LENGTH = 64


def load_ranks(path: str) -> list[bytes]:
    """Tokens of a tiktoken rank file by rank, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [t for _, t in pairs]


class Ranks:
    """Tokens, how each one is put together, which pairs can be neighbours,
    and an automaton that tells the tokens that end at a byte."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) >= 1 << 20:
            raise ValueError("at most 2**20 - 1 tokens")
        self.tokens, self.rank = tokens, {t: i for i, t in enumerate(tokens)}
        self.size = [len(t) for t in tokens]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = []
        self.known: dict[int, bool] = {}
        #: ids (32 bits each) of words met lately and before, filled by ``encode`` in each worker
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        for i, t in enumerate(tokens):
            self.parts.append(None)
            for cut in range(len(t) - 1, 0, -1):
                a, b = self.rank.get(t[:cut], i), self.rank.get(t[cut:], i)
                if a < i and b < i and self._neighbours(a, b):
                    self.merged[a, b] = i
                    self.parts[i] = (a, b)
                    break
        self._automaton()

    def kept_for(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words met before.  When half of what may be kept has
        gathered it becomes the older half, and of that those stay that are
        met again."""
        if len(self.kept) > KEPT_WORDS // 2:
            self.kept, self.older = {}, self.kept
        if self.older:
            kept, older = self.kept, self.older
            kept.update((w, older[w]) for w in words if w in older and w not in kept)
        return self.kept

    def _automaton(self) -> None:
        """Nodes are the prefixes of tokens; ``longest[node]`` is the longest
        token that ends the node's bytes, ``shorter[t]`` the next one.
        ``goto`` has the steps to longer prefixes, ``moves`` others met so far."""
        self.goto, spot, levels = {}, {}, {}
        for i, t in enumerate(self.tokens):
            at = 0
            for depth, c in enumerate(t):
                to = self.goto.get(at << 8 | c)
                if to is None:
                    to = self.goto[at << 8 | c] = len(self.goto) + 1
                    levels.setdefault(depth, []).append((at, c, to))
                at = to
            spot[at] = i
        n = len(self.goto) + 1
        self.back, self.longest, self.shorter = [0] * n, [-1] * n, [-1] * len(self.tokens)
        for depth in sorted(levels):
            for at, c, to in levels[depth]:
                self.back[to] = self.step(self.back[at], c) if depth else 0
                below = self.longest[self.back[to]]
                self.longest[to] = spot.get(to, below)
                if to in spot:
                    self.shorter[spot[to]] = below
        self.moves: dict[int, int] = {}

    def move(self, at: int, c: int) -> int:
        """``step``, remembered."""
        if len(self.moves) >= KEPT_STEPS:
            self.moves.clear()
        to = self.moves[at << 8 | c] = self.step(at, c)
        return to

    def step(self, at: int, c: int) -> int:
        while True:
            to = self.goto.get(at << 8 | c)
            if to is not None:
                return to
            if not at:
                return 0
            at = self.back[at]

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether no merge joins the end of token a with the start of token
        b before a and b are whole.  Both tokens are taken apart, the younger
        merge first; a merge across the border wins if its rank is lower than
        that of the merge just undone."""
        merged, parts, bound = self.merged, self.parts, len(self.tokens)
        while True:
            if merged.get((a, b), bound) < bound:
                return False
            pa_, pb = parts[a], parts[b]
            if pa_ is None and pb is None:
                return True
            if pb is None or (pa_ is not None and a > b):
                bound, a = a, pa_[1]
            else:
                # of two merges with one rank the left one goes first
                bound, b = b + 1, pb[0]

    def can_follow(self, a: int, b: int) -> bool:
        k = a << 20 | b
        v = self.known.get(k)
        if v is None:
            v = self.known[k] = self._neighbours(a, b)
            if len(self.known) > KEPT_STEPS:
                self.known.clear()
        return v


class PrefixTable:
    """``last[i]``: the last token of the encoding of ``piece[:i + 1]``."""

    def __init__(self, ranks: Ranks, piece: bytes = b""):
        self.ranks, self.piece, self.last, self.nodes = ranks, b"", [], []
        self.append(piece)

    def append(self, more: bytes) -> PrefixTable:
        ranks, last, nodes = self.ranks, self.last, self.nodes
        size, longest, shorter, goto, moves, known = ranks.size, ranks.longest, ranks.shorter, ranks.goto, ranks.moves, ranks.known
        at, end = nodes[-1] if nodes else 0, len(last)
        for c in more:
            step = at << 8 | c
            at = goto.get(step) or moves.get(step)
            if at is None:
                at = ranks.move(nodes[-1] if nodes else 0, c)
            t, end = longest[at], end + 1
            while (start := end - size[t]) > 0:
                before = last[start - 1]
                v = known.get(before << 20 | t)
                if v or (v is None and ranks.can_follow(before, t)):
                    break
                t = shorter[t]
            last.append(t)
            nodes.append(at)
        self.piece += more
        return self

    def replace(self, start: int, stop: int, new: bytes) -> PrefixTable:
        """Puts ``new`` in the place of bytes start..stop; prefixes that end
        before ``start`` stay."""
        rest = new + self.piece[stop:]
        self.piece = self.piece[:start]
        del self.last[start:], self.nodes[start:]
        return self.append(rest)

    def become(self, piece: bytes) -> PrefixTable:
        """The table of another piece; the prefixes both share stay."""
        same = 0
        for a, b in zip(piece, self.piece):
            if a != b:
                break
            same += 1
        return self.replace(same, len(self.piece), piece[same:])

    def ids(self) -> list[int]:
        out, end, size, last = [], len(self.last), self.ranks.size, self.last
        while end:
            t = last[end - 1]
            out.append(t)
            end -= size[t]
        out.reverse()
        return out


def ready(shared: dict) -> Ranks:
    """The ``Ranks`` of a broadcast, made once in each worker process."""
    if "ranks" not in shared:
        shared["ranks"] = Ranks(shared["tokens"])
    return shared["ranks"]


def encode_sorted(ranks: Ranks, pieces: list[bytes]) -> dict[bytes, bytes]:
    """Packed ids of pieces in byte order: one prefix table goes from piece to
    piece, each appends to what it shares with the one before."""
    table = PrefixTable(ranks)
    last, nodes, size, longest, shorter = table.last, table.nodes, ranks.size, ranks.longest, ranks.shorter
    goto, moves, known, rank = ranks.goto, ranks.moves, ranks.known, ranks.rank
    out: dict[bytes, bytes] = {}
    before = b""
    for raw in pieces:
        whole = rank.get(raw)
        if whole is not None:
            out[raw] = pack("i", (whole,)).tobytes()
            continue
        end = 0
        for a, b in zip(raw, before):
            if a != b:
                break
            end += 1
        del last[end:], nodes[end:]
        at = nodes[-1] if end else 0
        for c in raw[end:]:
            step = at << 8 | c
            at = goto.get(step) or moves.get(step)
            if at is None:
                at = ranks.move(step >> 8, c)
            t = longest[at]
            end += 1
            while (start := end - size[t]) > 0:
                v = known.get(last[start - 1] << 20 | t)
                if v or (v is None and ranks.can_follow(last[start - 1], t)):
                    break
                t = shorter[t]
            last.append(t)
            nodes.append(at)
        before, ids = raw, []
        while end:
            t = last[end - 1]
            ids.append(t)
            end -= size[t]
        ids.reverse()
        out[raw] = pack("i", ids).tobytes()
    return out


def words_of(text: str) -> list[str]:
    """The text cut before each space that stands alone between two other
    characters than white space: no piece of the pattern reaches over such a
    cut, so each word is split into pieces by itself.  A text with other
    white space beside a space stays whole."""
    words = text.split(" ")
    if not all(words) or any(w[0].isspace() or w[-1].isspace() for w in words if not w.isalpha()):
        return [text] if text else []
    return words[:1] + [" " + w for w in words[1:]]


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows of ``df`` with the ids of each whole text.  ``pattern`` must
    split like that of the public byte-level vocabularies, where white space
    comes before a piece and never ends one (see ``words_of``)."""
    df = df.drop(ids_col)
    shared = df.sparkSession.sparkContext.broadcast({"tokens": load_ranks(ranks_path)})

    def run(batches):
        import regex

        ranks, find = ready(shared.value), regex.compile(pattern).findall
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            _, offs = byte_rows(column)
            for lo, hi in row_slices(offs, 1 << 21):
                rows = [words_of(text) if text else [] for text in column.slice(lo, hi - lo).to_pylist()]
                kept = ranks.kept_for(words := set().union(*rows))
                new = {w: [p.encode("utf-8") for p in find(w)] for w in words.difference(kept)}
                ids_of = encode_sorted(ranks, sorted(set(chain.from_iterable(new.values()))))
                for word, pieces in new.items():
                    kept[word] = b"".join(map(ids_of.__getitem__, pieces)) if len(pieces) != 1 else ids_of[pieces[0]]
                ids = [b"".join(map(kept.__getitem__, words)) for words in rows]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]) // 4
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield with_columns(batch.slice(lo, hi - lo), **{ids_col: lists})
                for word in new:
                    if len(word) > KEPT_LENGTH:
                        del kept[word]
                del rows, new, ids_of, ids, lists

    return df.mapInArrow(run, same_rows(df.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows of ``df`` with the bytes that the ids stand for."""
    df = df.drop(out_col)
    tokens = df.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches):
        data = np.frombuffer(b"".join(tokens.value), np.uint8)
        size = np.array([len(t) for t in tokens.value], np.int64)
        at = np.cumsum(size) - size
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            offs = np.concatenate([[0], np.cumsum(np.array(column.value_lengths().fill_null(0), np.int64))])
            flat = np.asarray(column.flatten())
            for lo, hi in row_slices(offs, 1 << 18):
                ids = flat[offs[lo]:offs[hi]]
                if len(ids) and (ids.min() < 0 or ids.max() >= len(size)):
                    raise ValueError("an id is not in the vocabulary")
                ends = np.concatenate([[0], np.cumsum(size[ids])])
                where = np.repeat(at[ids] - ends[:-1], size[ids]) + np.arange(ends[-1])
                cuts = ends[offs[lo:hi + 1] - offs[lo]].astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data[where].tobytes())])
                yield with_columns(batch.slice(lo, hi - lo), **{out_col: raw})

    return df.mapInArrow(run, same_rows(df.schema, T.StructField(out_col, T.BinaryType())))


def digests(df: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> list:
    """Columns n_tokens, ids_sha256 and decoded_sha256 of an encoded frame."""
    return [F.size(ids_col).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(ids_col, " "), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded_col), 256).alias("decoded_sha256")]
