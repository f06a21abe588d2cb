import random

import pytest

from lexloom.llm.tokenize import LONG, Encoder, default_path, encode_documents

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    t = tokenizers.Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    e = Encoder(default_path())

    def ours(texts):
        o, ids = e.encode(texts)
        return [ids[a:b].tolist() for a, b in zip(o, o[1:])]

    return ours, lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_texts(both):
    ours, theirs = both
    texts = ["", " ", "\n\n \t x", "Hello world's it're 123", "<|endoftext|> a", "日本語テキスト" * 40, "é́" * 30, "  x﻿", "a" * 300, "ab" * 3000, "Zz" * (LONG // 2), "👩‍👩‍👧 🏳️‍🌈", "x" * 20000, "§§11-102 – “q”"]
    assert ours(texts) == theirs(texts)
    assert ours([None, "", "a"])[:2] == [[], []] and ours([]) == []


def test_random(both):
    ours, theirs = both
    rnd = random.Random(5)
    pool = "abcdefghij  \n'0123.,-ABéöπжक日👍‍­"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 200))) for _ in range(400)]
    assert ours(texts) == theirs(texts)


def test_rows(spark, both):
    df = spark.createDataFrame([(1, "Hi there", "x"), (1, "Hi there", "x"), (2, None, "x"), (3, "", "x"), (None, "a", "x"), (4, "  ", "x")], "doc_id bigint, text string, ids string")
    rows = encode_documents(df, "doc_id", "text", chunk_chars=5).collect()
    ours, _ = both
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == sorted([(1, ours(["Hi there"])[0])] * 2 + [(2, []), (3, []), (-1, ours(["a"])[0]), (4, ours(["  "])[0])])
    assert encode_documents(df.where("false"), "doc_id", "text").count() == 0
    assert encode_documents(df, "doc_id", "text").dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
