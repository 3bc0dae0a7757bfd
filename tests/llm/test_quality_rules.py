"""Repetition coverage against a plain-Python version; null, empty, long, repeated and clashing rows."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from diffloom.llm import queries as Q
from diffloom.llm.quality_rules import Limits, keep_passing, measure, rules

SF = "/root/testdata/sf0.001"


def plain(text):
    text = text or ""
    words = [(m.start(), m.end()) for m in re.finditer("[^\x20\x09-\x0D]+", text)]
    grams = collections.defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(text[a:b] for a, b in words[i:i + 5])].append(i)
    repeat = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search("[^\x20\x09-\x0D]", line))
        seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(repeat) > 20 * n
    return (n, sum(b - a for a, b in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeat), failed)


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

ODD = [None, "", " \n\t", "a", "wörd " * 30, "ab\x0bcd\x0cef\x1cgh ij", "x\ny\nx\n \n \nx", "é# *|< >&%$ x" * 3,
       "a b c d e f g h i j a b c d e", "a b c d e a b c d e", "q" * 200_000, "1 2 3 4 5 6 7 8 9 10 11 12\n" * 2,
       " ".join(map(str, range(60_000))), "same line here\n" * 40, "\U0001F600 x\U0001F600"]


def test_odd_texts_and_clashing_columns(spark):
    rows = [(i, t, i % 2 == 0, -1) for i, t in enumerate(ODD + ODD[:6])]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, n_words long").repartition(3)
    got = {r.doc_id: r.r for r in df.select("doc_id", rules(F.col("text")).alias("r")).collect()}
    for i, t, *_ in rows:
        assert tuple(got[i][f] for f in FIELDS) == plain(t), repr(t)[:60]
    kept = keep_passing(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert keep_passing(df).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query_matches_plain(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = Q.op6_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[f] for f in FIELDS) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.op6_quality_rules(spark, sf).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.5 * len(junk)


def test_coverage_decides():
    runs = " ".join(w for w in "house tree river cloud stone bread light night".split() for _ in range(5)).encode()
    headed = b"To be and not.\nHere follows one more line of plain words without end\nTo be and not."
    with_rules = measure([runs, headed], Limits())
    assert not with_rules.base_failed.any() and with_rules.kept.tolist() == [False, True]
    assert measure([runs], Limits(gram_chars=())).kept.tolist() == [True]


def test_coverage_changes_verdicts_and_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    rows = docs.select("quality", rules(F.col("text")).kept.alias("kept"), rules(F.col("text"), Limits(gram_chars=())).kept.alias("without"))
    changed = [r.quality for r in rows.filter("kept <> without").collect()]
    assert changed and 1 not in changed
