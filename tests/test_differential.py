"""Differential test against the public ``tokenizers`` package (test-only;
skipped when it is not installed): same corpus file, same settings ->
same vocabulary, same merges, same ids and offsets."""
import json
import os
import tempfile

import pytest

tokenizers = pytest.importorskip("tokenizers")

from conftest import SF001  # noqa: E402
from loomtok.operators.encode import encode_documents  # noqa: E402
from loomtok.operators.train import train_on_texts  # noqa: E402

SPECIALS = ["<unk>", "<s>", "</s>", "<pad>"]


def _library_model(texts, vocab_size):
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.normalizer = normalizers.NFKC()
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(vocab_size=vocab_size, min_frequency=2, special_tokens=SPECIALS,
                                  initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    path = os.path.join(tempfile.mkdtemp(prefix="loomtok-diff-"), "corpus.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(texts) + "\n")
    tok.train([path], trainer)
    return tok


def _merge_strings(m):
    raw = m["model"]["merges"]
    return [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in raw]


def test_training_and_encoding_equal_library(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(60).collect()
    texts = [r.text for r in rows]
    vocab_size = 260 + 80
    lib = _library_model(texts, vocab_size)
    # the library reads the file line by line: the same lines as one text
    ours = train_on_texts(spark.createDataFrame([("\n".join(texts) + "\n",)], "text string"), vocab_size)
    assert ours.tokens == [t for t, _ in sorted(lib.get_vocab().items(), key=lambda kv: kv[1])]
    lib_merges = _merge_strings(json.loads(lib.to_str()))
    assert [(ours.tokens[l], ours.tokens[r]) for l, r, _, _ in ours.merges] == lib_merges

    sample = texts[:20] + ["the <unk> was </s> end", "é😀 x", "ﬁne Ａ", "ﬁ<s>ﬁ x²", "cafe\u0301 ok"]
    df = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    got = {r.doc_id: r for r in encode_documents(df, ours).collect()}
    for i, t in enumerate(sample):
        e = lib.encode(t)
        assert got[i].ids == e.ids, i
        assert [(o.start, o.end) for o in got[i].offsets] == list(e.offsets), i


def test_large_model_udf_path_equals_library(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(120).collect()
    texts = [r.text for r in rows]
    vocab_size = 260 + 300
    lib = _library_model(texts, vocab_size)
    ours = train_on_texts(spark.createDataFrame([("\n".join(texts) + "\n",)], "text string"), vocab_size)
    assert [(ours.tokens[l], ours.tokens[r]) for l, r, _, _ in ours.merges] == \
        _merge_strings(json.loads(lib.to_str()))
    sample = texts[100:120]
    df = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode_documents(df, ours, with_offsets=False).collect()}
    assert got == {i: lib.encode(t).ids for i, t in enumerate(sample)}
