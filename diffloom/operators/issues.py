"""Issue linking and statement building.

``resolved_issues`` is row-local: the pull text is one cell, the ``<word> #<n>`` pairs are
extracted with ``regexp_extract_all`` and resolved with higher-order functions (first
appearance order via ``array_distinct``, last number per spelling via ``filter`` +
``element_at(-1)``), so no shuffle is needed. Commit messages, when given as a table, are
joined on ``(repo, pull_number)`` and concatenated in ``pos`` order first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.functions.text import col_of, strip_html_comments

REF_RE = r"(?U)(\w+)\s+#(\d+)"


def resolved_issues(text) -> Column:
    """C1 on the joined text (title, body, commit messages separated by newlines).

    HTML comments are removed; pairs are keyed by the word *as written*: per spelling only the
    last number stays, in order of the spelling's first appearance; spellings whose lower case
    is a closing keyword are kept. Returns array<string> of issue numbers.
    """
    t = strip_html_comments(col_of(text))
    words = F.regexp_extract_all(t, F.lit(REF_RE), 1)
    nums = F.regexp_extract_all(t, F.lit(REF_RE), 2)
    pairs = F.arrays_zip(words.alias("w"), nums.alias("n"))
    kws = F.array(*[F.lit(k) for k in K.CLOSING_KEYWORDS])
    spellings = F.filter(F.array_distinct(words), lambda w: F.array_contains(kws, F.lower(w)))
    return F.transform(spellings, lambda w: F.try_element_at(F.filter(pairs, lambda p: p["w"] == w), F.lit(-1))["n"])


def pull_text(title, body, commit_messages=None) -> Column:
    """Title, body and commit messages joined by newlines (NULL parts become '')."""
    parts = [F.coalesce(col_of(title), F.lit("")), F.coalesce(col_of(body), F.lit(""))]
    if commit_messages is not None:
        parts.append(F.array_join(F.coalesce(col_of(commit_messages), F.array()), "\n"))
    else:
        parts.append(F.lit(""))
    return F.concat_ws("\n", *parts)


def commit_messages(commits: DataFrame, keys=("repo", "pull_number")) -> DataFrame:
    """Commit table -> one ordered message array per pull (bounded by the pull's commits)."""
    keys = list(keys)
    return (commits.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("pos", "message"))).alias("m"))
            .select(*keys, F.transform("m", lambda x: x["message"]).alias("commit_messages")))


def problem_statement(pulls: DataFrame, issues: DataFrame, pull_keys=("repo", "pull_number"),
                      issues_col: str = "resolved_issues") -> DataFrame:
    """For each resolved issue in order, ``title\\nbody\\n``; unknown issues are skipped;
    NULL title/body become ''. Returns ``pull_keys + problem_statement``."""
    pk = list(pull_keys)
    ex = pulls.select(*pk, F.posexplode_outer(issues_col).alias("pos", "issue_number"))
    known = issues.select("repo", "issue_number", "title", "body", F.lit(True).alias("known"))
    j = ex.join(known, ["repo", "issue_number"], "left")
    piece = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")), F.lit("\n"))
    found = F.when(F.col("known"), F.struct("pos", piece.alias("p")))
    return (j.groupBy(*pk).agg(F.sort_array(F.collect_list(found)).alias("ps"))
            .select(*pk, F.array_join(F.transform("ps", lambda x: x["p"]), "").alias("problem_statement")))


def hints_before_first_commit(comments: DataFrame, first_commit: DataFrame,
                              keys=("repo", "pull_number", "issue_number"),
                              time_col: str = "updated_at", commit_time_col: str = "first_commit_at") -> DataFrame:
    """Comments earlier than the pull's first commit, stopping at the first comment that is
    not earlier (a prefix, not a filter). Pulls without commits get no hints.

    ``comments``: keys + pos + time + body; ``first_commit``: pull keys + first commit time.
    The window is partitioned by one issue's comments (a bounded thread), never by repo.
    """
    keys = list(keys)
    pull_keys = [k for k in keys if k in first_commit.columns]
    c = comments.join(first_commit.select(*pull_keys, commit_time_col), pull_keys)
    w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    early = F.coalesce(F.col(time_col) < F.col(commit_time_col), F.lit(False)).cast("int")
    return c.withColumn("__ok", F.min(early).over(w)).where(F.col("__ok") == 1).drop("__ok")


def clean_tracker_title(c) -> Column:
    """C4: white space runs -> one blank, stripped (titles and comment texts)."""
    return F.trim(F.regexp_replace(col_of(c), r"(?U)\s+", " "))


def clean_tracker_body(c) -> Column:
    """C4 body: newline runs -> one newline, four blanks -> tab, 2+ blanks -> one, stripped."""
    t = F.regexp_replace(col_of(c), r"\n+", "\n")
    t = F.regexp_replace(t, r"    ", "\t")
    t = F.regexp_replace(t, r"[ ]{2,}", " ")
    return F.regexp_replace(t, r"^(?U)\s+|(?U)\s+$", "")


# fixed values: the two ticket time formats, tried in this order
TRACKER_TIME_FORMATS = ["MM/dd/yy HH:mm:ss", "MMM d, yyyy, h:mm:ss a"]


def tracker_time(c, formats=TRACKER_TIME_FORMATS) -> Column:
    """C4 times (a "See timeline at " prefix is cut): the first format that parses; NULL rows
    go to the caller's error output instead of failing the job."""
    t = F.regexp_replace(col_of(c), r"^See timeline at ", "")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def tracker_hints(comments: DataFrame, first_commit: DataFrame, pull_keys=("repo", "pull_number"),
                  time_col: str = "timestamp", commit_time_col: str = "first_commit_at") -> DataFrame:
    """C4: all ticket comments earlier than the first commit (a plain filter, no early stop);
    result rows are (text, time) pairs. Unparsable times are kept with ``time_error``."""
    pk = list(pull_keys)
    c = comments.withColumn("ts", tracker_time(F.col(time_col)))
    c = c.join(first_commit.select(*pk, commit_time_col), pk)
    return c.select(*pk, clean_tracker_title(F.col("comment")).alias("text"), "ts",
                    F.col("ts").isNull().alias("time_error")).where(
        F.col("time_error") | (F.col("ts") < F.col(commit_time_col)))


def take_until_cutoff(pulls: DataFrame, cutoff, time_col: str = "created_at", group_cols=("repo",),
                      order_cols=("created_at",), max_rows: int | None = None, compat: bool = True) -> DataFrame:
    """newest first; rows up to and including the first one older than ``cutoff``.

    The boundary per group is an aggregate (the newest row older than the cutoff, by
    ``order_cols``), joined back: rows at or above it are kept — no window over a whole group.
    ``max_rows`` keeps the newest ``max_rows + 1`` rows in compat mode (the original tests after
    writing) with ``row_number() <= n``, which Spark runs as a WindowGroupLimit.
    """
    gc = list(group_cols)
    oc = list(order_cols)
    key = F.struct(*[F.col(c) for c in oc])
    df = pulls
    if cutoff is not None:
        older = df.where(F.col(time_col) < F.lit(cutoff))
        bound = older.groupBy(*gc).agg(F.max(key).alias("__bound"))
        df = df.join(bound, gc, "left").where(F.col("__bound").isNull() | (key >= F.col("__bound"))).drop("__bound")
    if max_rows is not None:
        n = max_rows + 1 if compat else max_rows
        w = Window.partitionBy(*gc).orderBy(*[F.col(c).desc() for c in oc])
        df = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return df


def with_issue_reference(df: DataFrame, text_col: str, repo_col: str, known_issues: DataFrame,
                         out_col: str = "has_issue_reference", id_col: str = "instance_id") -> DataFrame:
    """B7 complete: (a) a closing-keyword reference, (b) a GitLab issue link, or (c) any ``#n``
    that exists in ``known_issues`` (repo, issue_number) — a semi join instead of asking a web
    service. ``id_col`` names the row; rows of one id share their references."""
    from diffloom.functions.filters import contains_gitlab_issue, contains_keyword_reference
    refs = (df.select(F.col(id_col).alias("__row"), F.col(repo_col).alias("repo"),
                      F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"#(\d+)"), 1)).alias("issue_number"))
            .join(known_issues.select("repo", F.col("issue_number").cast("string")), ["repo", "issue_number"], "left_semi")
            .select("__row").distinct().withColumn("__hit", F.lit(True)))
    out = df.join(refs, df[id_col].eqNullSafe(refs["__row"]), "left")
    flag = contains_keyword_reference(F.col(text_col)) | contains_gitlab_issue(F.col(text_col)) | F.col("__hit").isNotNull()
    return out.withColumn(out_col, F.coalesce(flag, F.lit(False))).drop("__hit", "__row")


def live_statement(title, body, comments=None) -> Column:
    """``title\\nbody``, optionally followed by the comment bodies (the original loses the
    bodies when comments are present; ours appends them). ``comments`` = array<string>."""
    base = F.concat(F.coalesce(col_of(title), F.lit("")), F.lit("\n"), F.coalesce(col_of(body), F.lit("")))
    if comments is None:
        return base
    return F.concat(base, F.lit("\n"), F.array_join(F.transform(col_of(comments), lambda c: F.concat(F.lit("Comment: "), c)), "\n"))
