"""Every stage of the pipeline against a plain version of its operator; odd tables."""

import tempfile

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from diffloom.llm import pii
from test_mixing import plain as plain_mix
from test_pii import plain as plain_spans
from test_quality_rules import plain as plain_rules
from test_simhash import expected

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def staged(spark, docs, sf_dir):
    """The result of each stage, each written and read again."""
    out = []
    for name, stage in P.STAGES:
        path = tempfile.mkdtemp(prefix="stage-") + "/out"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_registered():
    assert "pipeline" in E.queries() and [n for n in E.queries() if n.startswith("op")] == list(
        dict.fromkeys(n for n in E.queries() if n.startswith("op")))
    assert {n.split("_")[0] for n in E.queries() if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert 4 <= len(P.STAGES) <= 5


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [docs, *staged(spark, docs, SF)]


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == P.COLUMNS


def test_quality(stages):
    before, after = dict(rows(stages[0], "doc_id", "text")), {i for i, in rows(stages[1], "doc_id")}
    failed = {i for i, t in before.items() if plain_rules(t)[5]}
    assert not failed & after and len(after) > 0.7 * len(before)
    assert set(rows(stages[1], *P.COLUMNS)) <= set(rows(stages[0], *P.COLUMNS))


def test_near_dedup(stages):
    want = {c for _, _, c in expected(rows(stages[1], "doc_id", "text"))}
    assert sorted(rows(stages[2], *P.COLUMNS)) == sorted(r for r in rows(stages[1], *P.COLUMNS) if r[0] in want)


def test_pii(stages):
    before, after = dict(rows(stages[2], "doc_id", "text")), {i: (t, n) for i, t, n in rows(stages[3], "doc_id", "text", "n_chars")}
    assert before.keys() == after.keys()
    for i, (text, n) in after.items():
        assert plain_spans(text) == [] and n == len(text)
        if not pii._ANY.search(before[i]):
            assert text == before[i]


def test_mixing(stages):
    import hashlib
    found = []
    for i, t, lang, source in rows(stages[3], "doc_id", "text", "lang", "source"):
        domain = "abcd"["0123456789abcdef".index(hashlib.md5(source.encode()).hexdigest()[0]) // 4]
        found.append((i, (domain, lang, source), len(t.split())))
    M = P.mixing
    want, _ = plain_mix(found, [M.WEIGHTS[x] for x in M.LEVELS], M.SEED, M.MAX_EPOCHS, M.PERCENT)
    assert sorted(str(i) for i, in rows(stages[4], "doc_id")) == sorted(str(i) for i, _ in want)
    assert set(rows(stages[4], *P.COLUMNS)) <= set(rows(stages[3], *P.COLUMNS))


def test_encode(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in rows(stages[4], "doc_id", "text"))
    assert sorted((i, tuple(ids)) for i, ids in rows(stages[5], "doc_id", "ids")) == want


def test_run_is_the_stages(spark, stages):
    got = P.run(spark, SF)
    assert sorted(map(str, rows(got, *got.columns))) == sorted(map(str, rows(stages[5], *got.columns)))


def test_odd_tables(spark):
    text = " ".join(f"word{k} other{k * 7}" for k in range(40))
    odd = [(None, text, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", None), (3, text + " mail a@b.cd", "en", "s", 9),
           (3, text + " mail a@b.cd", "en", "s", 9), (4, "long " + " ".join(map(str, range(30_000))), "xx", None, 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in odd], SCHEMA + ", epoch int, ids string")
    got = staged(spark, df, SF)
    assert {i for i, in rows(got[0], "doc_id")} == {None, 3, 4}
    assert [c for c in got[3].columns] == P.COLUMNS and got[4].columns[0] == "doc_id"
    assert all(g.count() == 0 for g in staged(spark, df.limit(0), SF))
    assert got[2].filter(F.col("text").contains("[EMAIL]")).count() <= 1
