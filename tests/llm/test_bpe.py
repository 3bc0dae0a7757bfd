"""Encoding and decoding against the tokenizers library; joins against plain merging."""

import hashlib
import random

import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from diffloom.llm import bpe
from diffloom.llm import queries as Q

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(PATH)
BPE = bpe.Bpe(open(PATH, encoding="utf-8").read())


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


ODD = ["", " ", "Hello World's it'LL we've I'M 'd''s", "don't12345 a1b2²½ x_y--__!!", "naïve CAFÉ Straße ŐŰ İ",
       "é café Å ﬁ ǅ ΑΣ ὈΔΟΣ", "日本語 テキスト 한국어 한", "a\x1cb\x1fc\x85d\xa0e f​g",
       "x<|endoftext|>y <|startoftext|><|endoftext|> <|endof", "🙂🙂 👩‍👩‍👧 \U0001F1E9\U0001F1EA", "\x00\x01﻿�",
       "a" * 1000, "ab" * 3000 + "c", "lololo" * 500, "-" * 777 + "=" * 300, "ß" * 500, "日本" * 400, "the" * 4000]


@pytest.mark.parametrize("text", ODD)
def test_like_the_library(text):
    ids = BPE.encode(text).tolist()
    assert ids == library(text)
    assert BPE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    ids = BPE.encode(text).tolist()
    assert ids == library(text)
    assert BPE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aehinorst", min_size=1, max_size=400), st.data())
def test_a_join_is_the_whole(word, data):
    symbols = BPE.symbols(word)
    at = data.draw(st.integers(0, len(symbols)))
    whole = BPE.merge(symbols)
    assert BPE._merge_long(symbols) == whole
    assert BPE.join(BPE.merge(symbols[:at]), BPE.merge(symbols[at:])) == whole
    assert BPE.tree(word.encode()) == whole


def pieced(text, size):
    parts = bpe.cut(text, size)
    assert "".join(p for p, _, _ in parts) == text
    return list(BPE.join_all([BPE.encode_piece(*p) for p in parts]))


@pytest.mark.parametrize("size", [9, 40, 333])
def test_pieces(size):
    rng = random.Random(size)
    for text in [*ODD, "".join(rng.choice(["then", "an", " ", "x", "É", "it's", "9", "é", "!?", "语"]) for _ in range(3000)),
                 "".join(rng.choice("aeinost") for _ in range(5000)), "́" * 300, "!?" * 900 + "é" * 90]:
        assert pieced(text, size) == library(text), (text[:40], size)


def test_frame(spark):
    texts = [None, *ODD, "ab c" * 9000, "ab" * 9000, "ab" * 9000, "word " * 9000]
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)],
                               "doc_id long, text string, digest string, ids array<int>")
    file = bpe.load(spark, PATH)
    got = bpe.encode(df, file, long_chars=2000, piece_chars=300).withColumn("back", bpe.decode(F.col("ids"), file))
    assert got.columns == ["doc_id", "text", "digest", "ids", "back"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert rows[i].ids == library(t or ""), repr(t)[:50]
        assert rows[i].back == LIBRARY.decode(library(t or ""), skip_special_tokens=False)
    again = bpe.encode(df, file, long_chars=2000, piece_chars=300, decoded="digest")
    assert again.columns == ["doc_id", "text", "ids", "digest"]
    assert {r.doc_id: (r.ids, r.digest) for r in again.collect()} == {i: (r.ids, r.back) for i, r in rows.items()}
    @F.pandas_udf("long")
    def size(coded: pd.DataFrame) -> pd.Series:
        return coded["ids"].map(len) * 1000 + coded["text"].map(len)

    sizes = bpe.encode(df, file, long_chars=2000, piece_chars=300, then=("text", size))
    assert {r.doc_id: r.text for r in sizes.collect()} == {i: len(r.ids) * 1000 + len(r.back) for i, r in rows.items()}
    assert bpe.encode(df.limit(0), file).count() == 0


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = Q.op1_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
