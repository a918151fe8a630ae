"""Ids against the public library that the vocabulary file is made for."""

import os

import pytest

from loamstone.llm import queries
from loamstone.llm.tokenizer import WordEncoder, encode_corpus, token_counts

TEXTS = [
    None, "", " ", "  a", "a  b\n\n c\t d  ", "<|endoftext|>", "a" * 3000 + "b", "it's we'll  don't x 　y\x1cz \x85 q",
    "café 日本語 🤷🏽‍♂️ ﷽", "\r\n x\r\n", "3.14 1,234 -5", "it's", "it's", "ab" * 5000,
]


@pytest.mark.skipif(not os.path.exists(queries.BYTE_BPE), reason="no tokenizer files here")
def test_same_ids(spark, data):
    from tokenizers import Tokenizer

    public = Tokenizer.from_file(queries.BYTE_BPE)
    public.encode_special_tokens = True
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "n int, text string, ids string")
    got = {r.n: r.ids for r in encode_corpus(df, "text", queries.BYTE_BPE).collect()}
    want = [public.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [got[i] for i in range(len(texts))] == want
    counts = {r.n: r.tokens for r in token_counts(df, "text", queries.BYTE_BPE).collect()}
    assert [counts[i] for i in range(len(texts))] == [len(w) for w in want]
    assert encode_corpus(df.limit(0), "text", queries.BYTE_BPE).count() == 0


@pytest.mark.skipif(not os.path.exists(queries.BYTE_BPE), reason="no tokenizer files here")
def test_long_words():
    """Words beyond the limit of the recursive query: the same ids, in time that does not grow with their square."""
    import random
    import time

    import pyarrow as pa
    from tokenizers import Tokenizer

    public, coder, rng = Tokenizer.from_file(queries.BYTE_BPE), WordEncoder(queries.BYTE_BPE), random.Random(1)
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(rng.choice(of) for _ in range(n))
    texts = [*map(letters, (191, 192, 193, 194, 700)), "a" * 777, "ab" * 900, "aab" * 500, letters(2000, "ACGT"), "物価上昇率は昨年" * 60, "thequickbrownfox" * 50, "1" * 1000, "-" * 999]
    assert coder.encode(pa.array(texts)).to_pylist() == [public.encode(t, add_special_tokens=False).ids for t in texts]
    began = time.time()
    word = letters(300_000)
    assert coder.counts(pa.array([word]))[0] == len(public.encode(word, add_special_tokens=False).ids) and time.time() - began < 30
