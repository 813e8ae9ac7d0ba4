"""The trained vocabulary: special tokens, 256 byte symbols, then merges.

A model is a *parameter* bounded by ``vocab_size`` (tens of thousands of
rows at most), so it lives on the driver as plain lists and is shipped to
executors as a small table, a scalar-subquery array or a broadcast.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from loomtok.functions.bytelevel import ALPHABET, DEFAULT_SPECIAL_TOKENS

VOCAB_SCHEMA = "id int, token string, kind string"
MERGES_SCHEMA = "rank int, left_id int, right_id int, new_id int, freq bigint"


@dataclass
class BpeModel:
    special_tokens: list[str] = field(default_factory=lambda: list(DEFAULT_SPECIAL_TOKENS))
    tokens: list[str] = field(default_factory=list)
    merges: list[tuple[int, int, int, int]] = field(default_factory=list)  # (left, right, new, freq)
    vocab_size_requested: int | None = None
    min_frequency: int = 2

    def __post_init__(self):
        if not self.tokens:
            self.tokens = list(self.special_tokens) + list(ALPHABET)
        self._index = {t: i for i, t in enumerate(self.tokens)}

    # -- driver-side views -------------------------------------------------
    @property
    def n_special(self) -> int:
        return len(self.special_tokens)

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def token_id(self, token: str) -> int | None:
        return self._index.get(token)

    def add_token(self, token: str) -> tuple[int, bool]:
        """Id for a merged string; an existing string keeps its id."""
        tid = self._index.get(token)
        if tid is not None:
            return tid, True
        tid = len(self.tokens)
        self.tokens.append(token)
        self._index[token] = tid
        return tid, False

    def kind(self, i: int) -> str:
        if i < self.n_special:
            return "special"
        if i < self.n_special + len(ALPHABET):
            return "byte"
        return "merge"

    def truncated(self, n_merges: int) -> "BpeModel":
        """The model after its first ``n_merges`` merges (a smaller baseline)."""
        keep = self.merges[:n_merges]
        n_tok = self.n_special + len(ALPHABET) + len({m[2] for m in keep
                                                      if m[2] >= self.n_special + len(ALPHABET)})
        return BpeModel(list(self.special_tokens), list(self.tokens[:n_tok]), list(keep),
                        self.vocab_size_requested, self.min_frequency)

    def plain(self) -> dict:
        """The model as lists and an array, which workers without this
        package can read too."""
        merges = np.array([m[:3] for m in self.merges], np.int64).reshape(-1, 3)
        return {"special_tokens": list(self.special_tokens), "tokens": list(self.tokens), "merges": merges}

    # -- tables ------------------------------------------------------------
    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, self.kind(i)) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, l, rr, n, f) for r, (l, rr, n, f) in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merges_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
        spark.createDataFrame(
            [(self.special_tokens, self.vocab_size_requested, self.min_frequency)],
            "special_tokens array<string>, vocab_size_requested int, min_frequency int",
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    def to_json(self) -> str:
        """Vocabulary and merges as one JSON object: {"special_tokens",
        "vocab": {token: id}, "merges": [[left, right], ...]}."""
        return json.dumps({"special_tokens": self.special_tokens, "vocab": {t: i for i, t in enumerate(self.tokens)},
                           "merges": [[self.tokens[a], self.tokens[b]] for a, b, _, _ in self.merges]}, ensure_ascii=False)

    @classmethod
    def from_merges(cls, pairs, special_tokens: list[str] | None = None) -> "BpeModel":
        """The model that applies these (left, right) token pairs in order."""
        model = cls(list(special_tokens or []))
        for left, right in pairs:
            new, _ = model.add_token(left + right)
            model.merges.append((model.token_id(left), model.token_id(right), new, 0))
        return model

    @classmethod
    def from_json(cls, text: str) -> "BpeModel":
        """Reads ``to_json`` and the public byte-level tokenizer files (merges
        under "model", pairs as lists or as strings with a space)."""
        found = json.loads(text)
        merges = found.get("merges") or found["model"]["merges"]
        return cls.from_merges([m.split(" ") if isinstance(m, str) else m for m in merges], found.get("special_tokens"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BpeModel":
        """Read the two model tables (bounded by vocab_size) back."""
        meta = spark.read.parquet(f"{path}/meta").first()
        vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        return cls(list(meta.special_tokens), [r.token for r in vocab],
                   [(m.left_id, m.right_id, m.new_id, m.freq) for m in merges],
                   meta.vocab_size_requested, meta.min_frequency)
