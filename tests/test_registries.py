"""Registered dialects, styles and encodings take part in the operators (M1, M2, M3)."""

from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.operators import files, logs, prompts


def test_registered_style(spark, monkeypatch):
    monkeypatch.setattr(prompts, "STYLES", dict(prompts.STYLES))
    prompts.register_style("short", lambda r: F.concat_ws("|", r["problem_statement"], r["readmes"], r["code"]))
    df = spark.createDataFrame([("P", "C"), (None, "C")], "p string, c string")
    assert [r[0] for r in df.select(prompts.render_prompt("short", F.col("p"), F.col("c"))).collect()] == ["P||C", "||C"]


def test_registered_encoding(spark, monkeypatch):
    monkeypatch.setattr(files, "ENCODINGS", dict(files.ENCODINGS))
    files.register_encoding("paths", lambda df: df.select("corpus_id", "path", F.upper("path").alias("text")))
    df = spark.createDataFrame([("c", "a.py", "x = 1"), ("c", "b.py", None)], "corpus_id string, path string, content string")
    assert {tuple(r) for r in files.ENCODINGS["paths"](df).collect()} == {("c", "a.py", "A.PY"), ("c", "b.py", "B.PY")}


def test_registered_dialect(spark, monkeypatch):
    monkeypatch.setattr(logs, "LINE_DIALECTS", dict(logs.LINE_DIALECTS))
    word = lambda line, k: F.element_at(F.split(line, " "), k)
    logs.register_dialect("colon", lambda line: F.when(line.rlike("^(PASSED|FAILED) "), F.array(
        F.struct(F.lit(0).alias("sub"), word(line, 2).alias("test"), word(line, 1).alias("status")))).otherwise(F.array().cast(logs.STATUS_ARRAY_SCHEMA)))
    log = "\n".join([K.INSTALL_PASS, K.APPLY_PATCH_PASS, K.START_TEST_OUTPUT, "PASSED a", "other", "FAILED b", "PASSED b", K.END_TEST_OUTPUT])
    df = spark.createDataFrame([(1, log, "colon"), (2, log, "nowhere")], "id int, log string, dialect string")
    assert "colon" in logs.known_dialects()
    got = {r.id: (r.reject_reason, r.tests) for r in logs.parse_logs(df, ["id"], dialect_col="dialect", repo_col=None).collect()}
    assert got == {1: (None, {"a": "PASSED", "b": "PASSED"}), 2: ("unknown dialect", None)}
