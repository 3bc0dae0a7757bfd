"""Scalar text helpers, all native Spark expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "bind", "py_strip", "py_rstrip", "py_lstrip", "words", "word_count", "strip_ansi",
    "strip_html_comments", "make_instance_id", "issue_url_parts", "blank_line_normalise",
    "first_line", "after_first_line", "lit_regex", "as_string_array", "regex_union",
]

# Python's str.strip() with no argument removes all Unicode white space; Java's \s without
# (?U) covers the ASCII set, which is what code and logs hold. (?U) widens it.
_WS = r"(?U)\s"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value, use) -> Column:
    """``use(value)``, with ``value`` computed once for all its uses: inside a lambda Spark computes an expression again
    wherever it stands."""
    return F.element_at(F.transform(F.array(col_of(value)), use), 1)


def py_strip(c) -> Column:
    """``str.strip()``: white space at both ends (``trim`` only cuts blanks)."""
    return F.regexp_replace(col_of(c), rf"^{_WS}+|{_WS}+$", "")


def py_rstrip(c) -> Column:
    return F.regexp_replace(col_of(c), rf"{_WS}+$", "")


def py_lstrip(c) -> Column:
    return F.regexp_replace(col_of(c), rf"^{_WS}+", "")


def words(c) -> Column:
    """``str.split()`` with no separator: maximal runs of non-white space."""
    return F.regexp_extract_all(col_of(c), F.lit(r"(?U)\S+"), 0)


def word_count(c) -> Column:
    return F.size(words(c))


def strip_ansi(c) -> Column:
    """Remove ANSI escape sequences."""
    # fixed value: two-character forms from @ to Z and from \ to _, and control sequences
    return F.regexp_replace(col_of(c), r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])", "")


def strip_html_comments(c) -> Column:
    return F.regexp_replace(col_of(c), r"(?s)<!--.*?-->", "")


def make_instance_id(repo, number) -> Column:
    """``owner/name`` + number -> ``owner__name-number``."""
    return F.regexp_replace(F.concat_ws("-", col_of(repo), col_of(number).cast("string")), "/", "__")


def issue_url_parts(url) -> Column:
    """``https://github.com/<owner>/<repo>/issues/<n>`` -> struct(owner, repo, number).

    Fields are NULL when the URL does not have that form (the reject output of the caller).
    """
    pat = r"^https?://(?:www\.)?github\.com/([^/]+)/([^/]+)/issues/(\d+)"
    u = col_of(url)
    ok = u.rlike(pat)
    return F.when(ok, F.struct(
        F.regexp_extract(u, pat, 1).alias("owner"),
        F.regexp_extract(u, pat, 2).alias("repo"),
        F.regexp_extract(u, pat, 3).cast("int").alias("number"),
    ))


def blank_line_normalise(c) -> Column:
    """Lines holding only blanks become empty; a final newline is ensured."""
    t = F.regexp_replace(col_of(c), r"(?m)^[ \t]+$", "")
    return F.when(t.endswith("\n"), t).otherwise(F.concat(t, F.lit("\n")))


def first_line(c) -> Column:
    return F.substring_index(col_of(c), "\n", 1)


def after_first_line(c) -> Column:
    """Text after the first newline ('' when there is none)."""
    parts = F.split(col_of(c), "\n", 2)
    return F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))


def lit_regex(s: str) -> str:
    """Quote a literal for a Java regex."""
    return r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E"


def regex_union(literals) -> str:
    return "|".join(lit_regex(s) for s in literals)


def as_string_array(c) -> Column:
    """JSON text or array -> array<string>; missing -> [] (A4).

    Use on a string column; an array column is already normalised at the source.
    """
    return F.coalesce(F.from_json(col_of(c), "array<string>"), F.array().cast("array<string>"))
