"""Counts of tasks follow the input, and work inside a task is done once."""

from pyspark.sql import functions as F

from diffloom.operators import retrieval as R
from diffloom.operators.files import edits_only_text
from diffloom.operators.joins import dealt
from diffloom.plans import rest_queries as X


def test_scores_are_dealt_by_the_documents_bytes(spark, tmpdir_path, monkeypatch):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("alpha beta w"), "id").alias("text"))
    docs.write.parquet(f"{tmpdir_path}/docs")
    docs = spark.read.parquet(f"{tmpdir_path}/docs")
    queries = spark.createDataFrame([(1, "alpha w7")], "item_id long, text string")
    top = lambda: R.bm25_search(R.bm25_index(docs, "lang", "doc_id", "text", queries, "text"), queries, "item_id", "text", k=3)
    want = sorted(map(tuple, top().collect()))
    monkeypatch.setattr(R, "SCORED_BYTES", 64)
    plan = top()._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    counts = [int(x.split(")")[0].split()[-1]) for x in plan.split("hashpartitioning(corpus_id")[1:] if "REPARTITION_BY_NUM" in x.splitlines()[0]]
    assert counts and min(counts) > 20
    assert sorted(map(tuple, top().collect())) == want


def test_a_source_without_an_estimate(spark):
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(1,), (2,)]), "a long")
    assert sorted(r.a for r in dealt(rows, rows, 1024, "a").collect()) == [1, 2]


def test_parts_are_dealt_to_more_tasks_than_files(spark, tmpdir_path, monkeypatch):
    part = spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit(3).alias("p_size"))
    part.coalesce(1).write.parquet(f"{tmpdir_path}/part.parquet")
    monkeypatch.setattr(X, "PART_BYTES", 64)
    out = X.docstring_texts(spark, tmpdir_path)
    assert out.rdd.getNumPartitions() > 4 and out.count() == 50


def test_lines_are_numbered_once(spark):
    one = spark.createDataFrame([("a\nb\nc", [(2, 1), (1, 0)])], "content string, hunks array<struct<old_start:int,old_len:int>>")
    text = one.select(edits_only_text(F.col("content"), F.col("hunks"), context=1).alias("t"))
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("greatest(") == 2  # a window's ends are not computed again for its lines
    assert text.first().t == "...\n2 b\n3 c\n1 a\n..."


def test_drops_of_pulls_are_compressed(spark, tmpdir_path, monkeypatch):
    import glob

    from diffloom.plans import stream_queries as S

    line = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string"
    spark.createDataFrame([(k, 1, 1, 3.0, "N", "O") for k in range(1, 9)], line).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    spark.createDataFrame([(k, "O") for k in range(1, 9)], "o_orderkey long, o_orderstatus string").write.parquet(f"{tmpdir_path}/orders.parquet")
    monkeypatch.setattr(S, "DROP_ROWS", 1)
    monkeypatch.setattr(S, "scratch_path", lambda spark, name: f"{tmpdir_path}/work")
    got = S.collected_pulls(spark, tmpdir_path).collect()
    assert sorted(r.pull_number for r in got) == [k for k in range(1, 9) if k % 4]
    files = glob.glob(f"{tmpdir_path}/work/pulls/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert max(spark.read.json(f).count() for f in files) == 1


def test_a_run_is_written_by_few_tasks(spark, tmpdir_path):
    import glob

    from diffloom import constants as K
    from diffloom.streaming.incremental import grade_log_stream, regrade

    text = "\n".join([K.INSTALL_PASS, K.APPLY_PATCH_PASS, K.START_TEST_OUTPUT, "PASSED t.py::t", K.END_TEST_OUTPUT])
    logs = spark.range(60).select(F.concat(F.lit("run-"), F.col("id") % 3).alias("run_id"), F.lit("m").alias("model"),
                                  F.concat(F.lit("inst-"), F.col("id")).alias("instance_id"),
                                  F.lit("pytest-dev/pytest").alias("repo"), F.lit(text).alias("log"))
    gold = logs.select("instance_id", F.lit(K.FAIL_TO_PASS).alias("category"), F.lit("t.py::t").alias("test"))
    logs.write.parquet(f"{tmpdir_path}/logs")
    files = lambda: [len(glob.glob(f"{tmpdir_path}/graded/run_id=run-{k}/*.parquet")) for k in range(3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many tasks as on large input
    try:
        arriving = spark.readStream.schema(logs.schema).parquet(f"{tmpdir_path}/logs")
        grade_log_stream(arriving, gold, f"{tmpdir_path}/graded", f"{tmpdir_path}/checkpoint").awaitTermination()
        assert files() == [1, 1, 1]
        regrade(logs.repartition(8, "instance_id"), gold, f"{tmpdir_path}/graded")
        assert files() == [1, 1, 1]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{tmpdir_path}/graded").count() == 60
