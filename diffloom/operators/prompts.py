"""Prompt and text-dataset building.

Everything is per instance and bounded by the instance's own files (at most k hits, or the
oracle files of its patch): file lists are sorted arrays inside one row, folded with
``aggregate``/``array_join``. Contents are joined last, after ids have been chosen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from diffloom.functions.text import after_first_line, col_of, first_line, py_strip


def numbered(text) -> Column:
    """J1 line numbers: ``<i> <line>``, 1-based."""
    return F.array_join(F.transform(F.split(col_of(text), "\n"),
                                    lambda x, i: F.concat((i + 1).cast("string"), F.lit(" "), x)), "\n")


def code_text(files, add_line_numbers: bool = False) -> Column:
    """``files`` is array<struct<path, content>>; files sorted by path, each wrapped in
    ``[start of p]`` / ``[end of p]``; outer newlines stripped."""
    srt = F.array_sort(col_of(files))
    def one(f):
        body = numbered(f["content"]) if add_line_numbers else f["content"]
        return F.concat(F.lit("[start of "), f["path"], F.lit("]\n"), body, F.lit("\n[end of "), f["path"], F.lit("]"))
    return F.regexp_replace(F.array_join(F.transform(srt, one), "\n"), r"^\n+|\n+$", "")


def pack_context(items, base_tokens, limit) -> Column:
    """``items`` = array<struct<rank, doc_id, tokens>>; in rank order a file is taken iff
    ``used + tokens < limit`` (strict); a file that does not fit is skipped and later ones may
    still fit. Returns struct(used, kept: array<doc_id>)."""
    srt = F.array_sort(col_of(items))
    zero = F.struct(col_of(base_tokens).cast("long").alias("used"),
                    F.array().cast("array<bigint>").alias("kept"))
    def step(acc, x):
        fits = acc["used"] + x["tokens"] < col_of(limit)
        return F.when(fits, F.struct((acc["used"] + x["tokens"]).alias("used"),
                                     F.concat(acc["kept"], F.array(x["doc_id"].cast("long"))).alias("kept"))
                      ).otherwise(acc)
    return F.aggregate(srt, zero, step)


# fixed wording of our prompt layouts (our own texts, passed as parameters)
INTRO = "Below are an issue report and the source files it concerns."
PATCH_INSTRUCTION = "Produce a patch file that resolves the issue, in unified diff format."


def _style2(r) -> Column:
    return F.concat_ws("\n", F.lit(INTRO), F.lit("<issue>"), r["problem_statement"], F.lit("</issue>"),
                       F.lit("<code>"), r["readmes"], r["code"], F.lit("</code>"), F.lit(PATCH_INSTRUCTION))


def _style3(r) -> Column:
    return F.concat_ws("\n", F.lit(INTRO), F.lit("<issue>"), r["problem_statement"], F.lit("</issue>"),
                       F.lit("<code>"), r["readmes"], r["code"], F.lit("</code>"),
                       F.lit("A patch has this form:"), F.lit("<patch>"), F.lit("</patch>"),
                       F.lit(PATCH_INSTRUCTION))


def _full_file(r) -> Column:
    return F.concat_ws("\n", F.lit(INTRO), F.lit("<issue>"), r["problem_statement"], F.lit("</issue>"),
                       F.lit("<code>"), r["code"], F.lit("</code>"),
                       F.lit("Rewrite the complete files that need changes."))


EXCERPTS = "Of each file only the lines near the edits are shown, each behind its number; ... stands for what is left out."


def _edits_only(r) -> Column:
    return F.concat_ws("\n", F.lit(INTRO), F.lit(EXCERPTS), F.lit("<issue>"), r["problem_statement"], F.lit("</issue>"),
                       F.lit("<code>"), r["readmes"], r["code"], F.lit("</code>"), F.lit(PATCH_INSTRUCTION))


STYLES: dict[str, Callable[[Column], Column]] = {
    "style-2": _style2, "style-3": _style3, "full_file_gen": _full_file, "style-2-edits-only": _edits_only,
}


def register_style(name: str, fn: Callable[[Column], Column]) -> None:
    """M2."""
    STYLES[name] = fn


def render_prompt(style: str, problem_statement, code, readmes=None) -> Column:
    """One of the registered layouts over (statement, readme text, code text)."""
    r = F.struct(F.coalesce(col_of(problem_statement), F.lit("")).alias("problem_statement"),
                 F.coalesce(col_of(code), F.lit("")).alias("code"),
                 (F.coalesce(col_of(readmes), F.lit("")) if readmes is not None else F.lit("")).alias("readmes"))
    if style not in STYLES:
        raise ValueError(f"unknown prompt style {style!r}")
    return STYLES[style](r)


def readme_files(files: DataFrame, corpus_col: str = "corpus_id", path_col: str = "path",
                 shortest: bool = False) -> DataFrame:
    """Root files whose name starts with 'readme' (any case); the live form keeps the
    shortest name per corpus."""
    r = files.where(~F.col(path_col).contains("/") & F.lower(F.col(path_col)).startswith("readme"))
    if shortest:
        r = r.groupBy(corpus_col).agg(F.min_by(F.struct(*r.columns), F.struct(F.length(path_col), F.col(path_col))).alias("r")).select("r.*")
    return r


TEXT_COLUMNS = ["instance_id", "text", "repo", "base_commit", "problem_statement", "hints_text", "created_at",
                "patch", "test_patch", "version", "FAIL_TO_PASS", "PASS_TO_PASS", "environment_setup_commit"]


def text_dataset(df: DataFrame, prompt_col: str = "prompt", split: str | None = None,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """``text`` = stripped prompt + two newlines; ``patch`` wrapped in tags; the 13 columns,
    missing ones as ''. Rows without a prompt are dropped (count them with ``observe``)."""
    out = df.where(F.col(prompt_col).isNotNull())
    cols = []
    for c in TEXT_COLUMNS:
        if c == "text":
            cols.append(F.concat(py_strip(F.col(prompt_col)), F.lit("\n\n")).alias("text"))
        elif c == "patch":
            cols.append((F.concat(F.lit("<patch>\n"), F.coalesce("patch", F.lit("")), F.lit("\n</patch>"))
                         if "patch" in df.columns else F.lit("<patch>\n\n</patch>")).alias("patch"))
        elif c in df.columns:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
        else:
            cols.append(F.lit("").alias(c))
    if split is not None:
        cols.append(F.lit(split).alias("split"))
    return out.select(*cols, *carry)  # carried columns need no join back


def chat_rows(text) -> Column:
    """First line = system message, the rest = user message."""
    return F.struct(first_line(text).alias("system"), after_first_line(text).alias("user"))


def select_files(instances: DataFrame, source: str, oracle: DataFrame | None = None, hits: DataFrame | None = None,
                 snapshot: DataFrame | None = None, id_col: str = "instance_id") -> DataFrame:
    """Which files feed an instance's prompt, as (instance_id, path) ids only (contents are
    joined last): ``oracle`` = files of the gold patch, ``bm25`` = retrieved hits, ``all`` =
    the whole snapshot of the instance's corpus, ``none`` = nothing."""
    if source == "oracle":
        return oracle.select(id_col, "path")
    if source == "bm25":
        return hits.select(id_col, "path")
    if source == "all":
        return instances.select(id_col, "corpus_id").join(snapshot.select("corpus_id", "path"), "corpus_id").select(id_col, "path")
    if source == "none":
        return instances.select(id_col).withColumn("path", F.lit(None).cast("string")).where(F.lit(False))
    raise ValueError(f"unknown file source {source!r}")
