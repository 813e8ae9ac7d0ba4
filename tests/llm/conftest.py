import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(rng: random.Random, n: int, letters: str = "abcdefghijklmnop") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, periodic text, ties,
    other scripts, empty texts and nulls; a long text; a repeated row."""
    rng = random.Random(3)
    base = [" ".join(words(rng, n)) for n in (3, 4, 5, 6, 40, 80, 150, 400, 400, 700)]
    passage = " ".join(words(rng, 75))
    near = base[7].split()
    near[50] = "changed"
    far = base[7].split()
    for i in range(0, 400, 12):
        far[i] = "other"
    texts = base + [base[6], base[6], base[7], " ".join(near), " ".join(far)]
    texts += [base[4] + " " + passage + " " + base[5], base[8] + "\n" + passage, passage]
    texts += ["ab " * 300, "xyz" * 400, "x" * 900, "x" * 399, "x" * 400, "", "   ", "\n\n", None, None, "1234 !!", "ééé über straße " * 30, "日本語 テキスト " * 60]
    texts.append(" ".join(words(rng, 6000)) + " " + base[9] + " " + " ".join(words(rng, 500)))
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 12}" if i % 11 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[9], (None, base[5], "en", "s1", 0), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
