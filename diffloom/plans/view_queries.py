"""Registered queries that put predicates, patch views, joins and prompt forms side by side, on text
built from the tables so that each has cases where it holds and where it does not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.functions import filters as B
from diffloom.functions.text import blank_line_normalise, first_line, issue_url_parts, make_instance_id, strip_ansi
from diffloom.operators import patches as C
from diffloom.operators.prompts import STYLES, chat_rows, render_prompt
from diffloom.operators.reports import keep_valid_ids, locate_outputs, lookup_spec, unresolved_pairs, with_outputs_only
from diffloom.operators.retrieval import attach_hits, patch_sources, prompt_files
from diffloom.operators.tokens import eval_tokens, register_tokenizer
from diffloom.plans.common import t
from diffloom.plans.patch_queries import order_patches
from diffloom.plans.retrieval_queries import md5_ids

PATHS = ["src/latest.py", "tests/a.py", "pkg/test_b.py", "data/x.csv", "doc/readme.md", "a/testing.d/c.txt"]


def text_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every predicate on every line item's statement and path."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    n = F.col("l_partkey").cast("string")
    texts = [F.concat(F.lit("see https://example.com/p"), n), F.concat(F.lit("look at Shot"), n, F.lit(".PNG now")),
             F.concat(F.lit("this fixes  #"), n), F.lit("at https://gitlab.com/a/b/issues now"),
             F.concat(F.lit("since "), F.sha1(n)), F.lit("with pytest.raises(E, match='x')"), F.lit("with pytest.raises(E):"),
             F.lit("self.assertRaises(E)"), F.lit("ImportError: gone"), F.lit("import os\nall well"),
             F.repeat(F.lit("word "), 60), F.concat(F.lit("refs #"), n), F.lit("  "), F.lit("")]
    k = (F.col("l_partkey") % (len(texts) + 1)).cast("int")
    text = F.lit(None).cast("string")
    for j, c in enumerate(texts):
        text = F.when(k == j, c).otherwise(text)
    rows = li.select("l_orderkey", "l_linenumber", text.alias("x"),
                     F.element_at(F.array(*[F.lit(p) for p in PATHS]), (F.col("l_suppkey") % len(PATHS)).cast("int") + 1).alias("path"),
                     F.when(F.col("l_returnflag") == "R", F.lit("2024-01-01")).alias("merged"),
                     F.when(F.col("l_returnflag") != "A", F.array(F.lit("1"))).otherwise(F.array().cast("array<string>")).alias("issues"))
    x = F.col("x")
    flags = {
        "valid_pull": B.is_valid_pull("merged", "issues"), "valid_instance": B.is_valid_instance("path", "x"), "test_patch": B.has_test_patch("x"),
        "commit_hash": B.contains_commit_hash(x), "link": B.contains_hyperlinks(x), "link_repo": B.contains_hyperlinks(x, F.lit("o/r")),
        "media": B.contains_media(x), "keyword": B.contains_keyword_reference(x), "gitlab": B.contains_gitlab_issue(x),
        "message_check": B.has_error_message_check(x), "short": B.max_words(x, 5), "gate": B.statement_gate(x, 3),
        "import_error": B.has_import_or_attribute_error(x), "test_words": B.is_test_path_words("path"),
        "test_substring": B.is_test_path_substring("path"), "few_chars": B.max_chars(x, 40),
        "length_between": B.token_length_between(F.split(x, " "), 2, 4), "asset": B.is_non_test_asset("path"),
        "prediction": B.has_nonempty_prediction("x")}
    return rows.select("l_orderkey", "l_linenumber", *[F.coalesce(c, F.lit(False)).alias(f) for f, c in flags.items()])


def patch_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of each order's diff; texts by MD5."""
    p = order_patches(spark, sf_dir)
    patch = F.col("patch")
    wrapped = F.when(F.col("order_key") % 4 == 0, F.concat(F.lit("Here:\n<patch>\n"), patch, F.lit("</patch> bye"))) \
        .when(F.col("order_key") % 4 == 1, F.concat(F.lit("```diff\n"), patch, F.lit("```\nend"))) \
        .when(F.col("order_key") % 4 == 2, F.concat(patch, F.lit("</s>rest")))
    split = C.split_patch(patch)
    p = p.select("order_key", "patch", split.alias("s"), C.extract_diff(wrapped).alias("c12"))
    f2p = F.array(F.lit("tests/test_mod_0.py::test_x"), F.lit("pkg/none.py::t"))
    cut = F.when(F.col("order_key") % 2 == 0, F.regexp_replace("patch", r"(?m)^@@ ", "## ")).otherwise(patch)
    text = lambda c: F.md5(F.coalesce(c, F.lit("<none>")))
    return p.select(
        "order_key", text(F.col("s.patch")).alias("code_md5"), text(F.col("s.test_patch")).alias("test_md5"),
        text(C.keep_test_sections(patch)).alias("tests_md5"), text(F.col("c12")).alias("diff_md5"),
        text(C.minimal_patch(patch, compat=False)).alias("minimal_md5"), text(C.minimal_patch(patch)).alias("minimal_strict_md5"),
        F.array_join(C.oracle_files(patch), ",").alias("sources"), F.array_join(patch_sources(patch), ",").alias("a_files"),
        F.array_join(C.test_directives(F.col("s.test_patch"), F.lit("o/r")), ",").alias("directives"),
        F.array_join(C.test_directives(F.col("s.test_patch"), F.lit("django/django")), ",").alias("modules"),
        B.patch_defines_gold_test(f2p, F.col("s.test_patch")).alias("defines_gold"), B.valid_patch_format(cut).alias("valid_cut"),
        make_instance_id(F.lit("own/rep"), F.col("order_key")).alias("instance_id"))


def join_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by what became of them, one table."""
    orders = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instance_id"), "o_orderstatus", "o_orderpriority", "o_custkey")
    with_log = orders.where("o_orderstatus <> 'P'").select("instance_id")
    with_patch = orders.where("instance_id % 3 <> 0").select("instance_id")
    valid = orders.where("o_custkey % 5 <> 1").select("instance_id")
    kept, rejected = keep_valid_ids(orders, valid)
    specs = orders.where("o_orderpriority <> '5-LOW'").select("o_orderstatus", "o_orderpriority").distinct().withColumn("env", F.lit("e"))
    found, unknown = lookup_spec(orders, specs, keys=("o_orderstatus", "o_orderpriority"))
    pairs = orders.select("instance_id", F.col("o_orderstatus").alias("version"))
    open_pairs = unresolved_pairs(pairs.union(pairs), pairs.where("instance_id % 4 <> 0"))
    outputs = locate_outputs(orders, with_log).where("has_output")
    parts = {"with_outputs": with_outputs_only(orders, with_log, with_patch), "kept": kept, "rejected": rejected, "spec": found,
             "no_spec": unknown, "unresolved": open_pairs, "located": outputs}
    out = None
    for kind, df in parts.items():
        part = df.select(F.lit(kind).alias("kind"), "instance_id")
        out = part if out is None else out.union(part)
    return out


def order_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three hits (parts by line) of each order, none for orders without a line."""
    li = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("instance_id"), "l_linenumber", "l_partkey")
    hits = li.groupBy("instance_id").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("hits"))
    orders = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("instance_id"))
    got = attach_hits(orders, hits, 3)
    return got.select("instance_id", F.array_join(F.transform("hits", lambda h: h["l_partkey"].cast("string")), ",").alias("hits"))


def prompt_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 (all styles), J9, J12, C15, C22, C24, E7: forms of each conversation turn's text."""
    register_tokenizer("md5", md5_ids)
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    code = F.concat(F.lit("[start of a.py]\n"), F.col("text"), F.lit("\n[end of a.py]\n[start of b.py]"))
    styled = {s: render_prompt(s, F.col("text"), code) for s in sorted(STYLES)}
    ids = lambda f: F.md5(F.array_join(F.col(f).cast("array<string>"), ","))
    url = F.concat(F.lit("https://github.com/own/rep/"), F.when(F.col("turn") % 2 == 0, F.lit("issues/")).otherwise(F.lit("pull/")), F.col("conv_id").cast("string"))
    rows = c.select("conv_id", "turn", "text", eval_tokens(F.col("text"), first_line("text"), "md5").alias("e"),
                    chat_rows(F.concat(F.lit("be brief\n"), F.col("text"))).alias("chat"), issue_url_parts(url).alias("u"), code.alias("code"))
    return rows.select(
        "conv_id", "turn", *[F.md5(v).alias(s.replace("-", "_") + "_md5") for s, v in styled.items()],
        ids("e.input_ids").alias("input_md5"), ids("e.labels").alias("labels_md5"), F.col("chat.system").alias("system"),
        F.md5("chat.user").alias("user_md5"), F.col("u.number").cast("long").alias("issue"),
        F.md5(strip_ansi(F.concat(F.lit("\x1b[31m\x1b]\x1b^\x1b-"), F.col("text"), F.lit("\x1b[0m")))).alias("plain_md5"),
        F.md5(blank_line_normalise(F.concat(F.col("text"), F.lit("\n  \t\nz")))).alias("lines_md5"),
        F.array_join(prompt_files(F.col("code")), ",").alias("files"))
