"""Registered queries: diff parsing, patch gates and the code/test split (C5-C8, C11, E15,
B8, B10-B12, B17, B25).

Stand-in: one diff per order. Each line item is a hunk in file ``l_suppkey % 4`` (even files
are test files); removed lines read ``--- old`` so that they look like file headers, added
lines ``+new``; a file's kind (added / removed / modified) follows its first line item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.operators.patches import gate_columns, hunk_rows, patch_stats as stats_table, stats_aggs, split_patch, target_file
from diffloom.functions.filters import is_test_path_substring, valid_patch_format
from diffloom.functions.text import bind
from diffloom.plans.common import t


def _len_part(n: Column) -> Column:
    return F.when(n == 1, F.lit("")).otherwise(F.concat(F.lit(","), n.cast("string")))


def order_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                                             "l_returnflag", "l_linestatus")
    q = F.floor("l_quantity").cast("int")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    n_ctx = 1 + q % 2
    n_rem = F.when(rf == "R", 1 + q % 3).when(rf == "N", F.lit(1)).otherwise(F.lit(0))
    n_add = F.when(rf == "A", 1 + q % 3).when(rf == "N", 1 + q % 2).otherwise(F.lit(0))
    start = (F.col("l_linenumber") * 10).cast("string")
    old_len, new_len = n_ctx + n_rem, n_ctx + n_add
    hunk = F.concat(
        F.lit("@@ -"), start, _len_part(old_len), F.lit(" +"), start, _len_part(new_len),
        F.lit(" @@ def f"), F.col("l_linenumber").cast("string"), F.lit("():\n"),
        F.lit(" ctx\n"), F.repeat(F.lit("--- old\n"), n_rem), F.repeat(F.lit("+new\n"), n_add),
        F.repeat(F.lit(" ctx\n"), n_ctx - 1),
        F.when((rf == "A") & (ls == "F"), F.lit("\\ No newline at end of file\n")).otherwise(F.lit("")))
    items = li.select("l_orderkey", F.struct(
        (F.col("l_suppkey") % 4).cast("int").alias("file_id"), F.col("l_linenumber").alias("ln"),
        rf.alias("rf"), ls.alias("ls"), hunk.alias("hunk")).alias("it"))
    per = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("it")).alias("its"))

    def file_text(fid):
        path = F.when(fid % 2 == 0, F.concat(F.lit("tests/test_mod_"), fid.cast("string"), F.lit(".py"))) \
            .otherwise(F.concat(F.lit("pkg/mod_"), fid.cast("string"), F.lit(".py")))
        its = F.filter("its", lambda x: x["file_id"] == fid)
        return bind(F.struct(path.alias("path"), its.alias("its")), lambda f: bind(F.try_element_at(f["its"], F.lit(1)), lambda first: text(f, first)))

    def text(f, first):
        path = f["path"]
        added = (first["rf"] == "A") & (first["ls"] == "O")
        removed = (first["rf"] == "R") & (first["ls"] == "F")
        return F.concat(
            F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n"),
            F.when(added, F.lit("new file mode 100644\n")).when(removed, F.lit("deleted file mode 100644\n")).otherwise(F.lit("")),
            F.lit("index 1a2b3c4..5d6e7f8 100644\n"),
            F.lit("--- "), F.when(added, F.lit("/dev/null")).otherwise(F.concat(F.lit("a/"), path)), F.lit("\n"),
            F.lit("+++ "), F.when(removed, F.lit("/dev/null")).otherwise(F.concat(F.lit("b/"), path)), F.lit("\n"),
            F.array_join(F.transform(f["its"], lambda x: x["hunk"]), ""))

    fids = F.array_sort(F.array_distinct(F.transform("its", lambda x: x["file_id"])))
    return per.select(F.col("l_orderkey").alias("order_key"),
                      F.array_join(F.transform(fids, file_text), "").alias("patch"))


def _long(c: Column) -> Column:
    return c.cast("long")


def patch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-diff counts from the exploded hunk rows; the format check
    (B23) is a row-level column carried through the explode (one pass over each diff)."""
    p = order_patches(spark, sf_dir)
    st = stats_table(p, "patch", ["order_key"], carry={"valid_format": valid_patch_format(F.col("patch"))})
    return st.select("order_key", "n_files", "n_added_files", "n_removed_files", "n_modified_files", "n_hunks",
                     "added", "removed", "parseable", "valid_format")


def patch_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8, B10, B11, B12 and the patch gate of B14."""
    st = stats_table(order_patches(spark, sf_dir), "patch", ["order_key"])
    return st.select("order_key", *[v.alias(k) for k, v in gate_columns().items()])


def split_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code/test split. The split texts come from ``split_patch`` (headers
    only) and give the target file (C11) as a row-level column carried through the explode;
    the statistics of both parts come from one aggregate over the hunk rows with the test
    flag."""
    p = order_patches(spark, sf_dir)
    target = bind(split_patch(F.col("patch")), lambda sp: target_file(sp["patch"], sp["test_patch"]))  # split once, not for each part
    h = hunk_rows(p, "patch", ["order_key"], carry={"target_file": target}) \
        .withColumn("is_test", is_test_path_substring(F.col("path")))
    st = h.groupBy("order_key", "target_file").agg(
        *stats_aggs("code_", ~F.col("is_test")), *stats_aggs("test_", F.col("is_test")),
        F.count_if(F.coalesce(F.col("hunk_pos") == 0, F.lit(True)) & F.col("source").startswith("a/")).alias("n_modified_paths"))
    return st.select(
        "order_key", F.col("code_n_files").alias("code_files"), F.col("code_added"), F.col("code_removed"),
        F.col("test_n_files").alias("test_files"), F.col("test_added"), F.col("test_removed"),
        "n_modified_paths", "target_file")
