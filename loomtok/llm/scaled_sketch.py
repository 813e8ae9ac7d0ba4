"""Document fingerprints: sketches scaled by a threshold, with DataFrame functions only.

A text's shingles are its runs of ``SHINGLE`` words (a shorter text that has
words is one run); words are runs of other characters than space and
\\t..\\r, with A-Z lowered.  A shingle's hash is the first 64 bits of its MD5,
as 16 hex digits.  The sketch keeps every hash below 2**64 / ``scale``, so it
grows with the text and two sketches are samples by one and the same rule:
``likeness`` estimates the Jaccard similarity of two texts, ``containment``
which share of one text is in the other, however unequal their lengths.  A
text none of whose hashes is below the threshold keeps its least one.

The sketch of several texts together is the union of theirs (``merged``, as
rows, so that no group of texts has to fit in one); the sketch for a larger
scale is the part of it below that threshold (``coarser``).

Defined results: a null text is an empty one; a text without words has an
empty sketch; two empty sketches are alike (1.0), an empty one is contained
in any and like no other; texts with the same shingles have the same sketch,
whatever their order, spacing and repeats.  A text is never cut, long ones
included.  Columns of the new names are replaced; an empty table gives an
empty one; rows keep their keys, null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
#: One in so many hashes is kept.
SCALE = 4
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, use) -> Column:
    """``use(value)``, the value being computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), LETTERS, LETTERS.lower())
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def threshold(scale: int) -> str:
    return f"{(1 << 64) // scale:016x}" if scale > 1 else "g"


def _hashes(w: Column) -> Column:
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))),
                       lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, SHINGLE), " ")), 1, 16))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(each)


def coarser(sketch: Column, scale: int) -> Column:
    """The sketch that a larger ``scale`` gives."""
    kept = F.filter(sketch, lambda h: h < threshold(scale))
    return let(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(F.slice(sketch, 1, 1)))


def sketch(text: Column, scale: int = SCALE) -> Column:
    """array<string>, ascending: the kept hashes, each once."""
    def of(h: Column) -> Column:
        kept = F.filter(h, lambda x: x < threshold(scale))
        return let(kept, lambda k: F.when(F.size(k) > 0, F.sort_array(F.array_distinct(k))).otherwise(F.slice(F.sort_array(h), 1, 1)))
    return let(words(text), lambda w: let(_hashes(w), of))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts, 0 to 1."""
    def of(both: Column) -> Column:
        union = F.size(a) + F.size(b) - both
        return F.when(union == 0, F.lit(1.0)).otherwise(both / union)
    return let(F.size(F.array_intersect(a, b)), of)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds, 0 to 1."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def add_sketch(docs: DataFrame, text_col: str = "text", out_col: str = "sketch", scale: int = SCALE) -> DataFrame:
    """The rows with their sketches, in one narrow pass."""
    return docs.drop(out_col).withColumn(out_col, sketch(F.col(text_col), scale))


def merged(sketched: DataFrame, *group: str, sketch_col: str = "sketch", scale: int = SCALE) -> DataFrame:
    """group..., hash: the sketch of each group's texts together, a row for
    each hash, reduced within each task first.  Null groups are one group.
    A least hash above the threshold stays only where its group has no hash
    below it, and of several such the least."""
    names = [f"_g{i}" for i in range(len(group))]
    rows = sketched.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.explode(sketch_col).alias("_h"))
    low = rows.where(F.col("_h") < threshold(scale)).distinct()
    # of the others one for each group; the hash order puts it behind any low one
    least = rows.groupBy(*names).agg(F.min("_h").alias("_h")).where(F.col("_h") >= threshold(scale))
    return low.unionByName(least).select(*[F.col(n).alias(g) for n, g in zip(names, group)], F.col("_h").alias("hash"))


def contained(sketched: DataFrame, of: DataFrame, key: str, sketch_col: str = "sketch", out_col: str = "contained") -> DataFrame:
    """key, ``out_col``: the share of each row's kept hashes that are among
    the hashes of ``of`` (from ``merged``, of any size: a join by hash)."""
    # rows without hashes keep one null, which no hash equals
    each = sketched.select(F.col(key).alias("_k"), F.xxhash64(sketch_col).alias("_s"), F.size(sketch_col).alias("_n"),
                           F.explode_outer(sketch_col).alias("hash"))
    hit = each.join(of.select("hash", F.lit(1).alias("_hit")).distinct(), "hash", "left")
    share = F.when(F.max("_n") == 0, F.lit(1.0)).otherwise(F.count_distinct(F.when(F.col("_hit") == 1, F.col("hash"))) / F.max("_n"))
    found = hit.groupBy("_k", "_s").agg(share.alias("_share"))
    return found.select(F.col("_k").alias(key), F.col("_share").alias(out_col))
