"""Row predicates (B1-B25). Each returns a boolean Column; combine with ``&``/``|``.

Regex notes: Java patterns get ``(?U)`` where Python's Unicode ``\\w``/``\\b``/``\\s`` matter,
and ``(?d)`` where ``.`` must stop only at ``\\n`` as in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.functions.text import col_of, py_strip, regex_union

__all__ = [
    "is_valid_pull", "is_valid_instance", "has_test_patch", "contains_commit_hash",
    "contains_hyperlinks", "contains_media", "more_than_n_words", "contains_keyword_reference",
    "contains_gitlab_issue", "has_error_message_check", "max_words", "statement_gate",
    "has_import_or_attribute_error", "is_test_path_words", "is_test_path_substring",
    "max_chars", "token_length_between", "is_non_test_asset", "has_nonempty_prediction",
    "valid_patch_format", "patch_defines_gold_test", "HASH40_RE", "MEDIA_RE",
]

HASH40_RE = r"(?U)(?<!/)\b[0-9a-f]{40}\b"
HASH23_RE = r"\[[0-9a-f]{23}\]"
MEDIA_RE = r"(?iU)\b(" + regex_union(K.IMAGE_EXTENSIONS + K.VIDEO_EXTENSIONS) + r")\b"
KEYWORD_REF_RE = r"(?U)(\w+)\s+#(\d+)"


def is_valid_pull(merged_at="merged_at", resolved_issues="resolved_issues") -> Column:
    """B1: merged, with at least one resolved issue."""
    ri = col_of(resolved_issues)
    return col_of(merged_at).isNotNull() & (F.size(F.coalesce(ri, F.array())) > 0)


def is_valid_instance(patch="patch", problem_statement="problem_statement") -> Column:
    """B2: patch and statement neither NULL nor '' (no trimming)."""
    p, s = col_of(patch), col_of(problem_statement)
    return F.coalesce(p.isNotNull() & (p != "") & s.isNotNull() & (s != ""), F.lit(False))


def has_test_patch(test_patch="test_patch") -> Column:
    """Not NULL and not blank after stripping white space."""
    t = col_of(test_patch)
    return F.coalesce(t.isNotNull() & (py_strip(t) != ""), F.lit(False))


def contains_commit_hash(text) -> Column:
    """A 40-hex word not preceded by '/', or a bracketed 23-hex id. A plain 40-hex run is a
    necessary condition of the first form and is tested first (no look-behind, no Unicode
    word boundaries), so most texts skip the exact pattern."""
    t = col_of(text)
    return (t.rlike(r"[0-9a-f]{40}") & t.rlike(HASH40_RE)) | t.rlike(HASH23_RE)


def contains_hyperlinks(text, repo=None, strict: bool = False) -> Column:
    """B5. Without a repo: ``https?://(www.)?\\S+``. With a repo the compatible form counts every
    link (the own-repository exclusion of the original never fires); ``strict=True`` removes
    links into the repository itself before testing."""
    t = col_of(text)
    if repo is None:
        return t.rlike(r"https?://(?:www\.)?\S+")
    if not strict:
        return t.rlike(r"(?d)https?://.+|www\..+")
    own = F.concat(F.lit(r"(?:https?://(?:www\.)?github\.com/|www\.github\.com/)\Q"), col_of(repo), F.lit(r"\E\S*"))
    return F.regexp_replace(t, own, "").rlike(r"(?d)https?://.+|www\..+")


def contains_media(text) -> Column:
    """An image or video extension after a word character, any case. The exact pattern
    only runs when the lower-cased text holds one of the extensions literally."""
    t = col_of(text)
    low = F.lower(t)
    pre = F.lit(False)
    for ext in K.IMAGE_EXTENSIONS + K.VIDEO_EXTENSIONS:
        pre = pre | low.contains(ext)
    return pre & t.rlike(MEDIA_RE)


def contains_keyword_reference(text) -> Column:
    """B7(a): some ``<word> #<n>`` whose word is a closing keyword (any case)."""
    kws = F.array(*[F.lit(k) for k in K.CLOSING_KEYWORDS])
    t = col_of(text)
    found = F.regexp_extract_all(t, F.lit(KEYWORD_REF_RE), 1)
    # a reference needs a '#': texts without one skip the pattern
    return t.contains("#") & F.exists(found, lambda w: F.array_contains(kws, F.lower(w)))


def contains_gitlab_issue(text) -> Column:
    """B7(b): a GitLab issue link."""
    return col_of(text).rlike(r"(?d)https?://gitlab.com/(.*)/issues")


def has_error_message_check(test_patch) -> Column:
    """Pytest raise/warn markers present -> 'match' must occur; else a Django marker."""
    t = col_of(test_patch)
    any_pytest = F.lit(False)
    for m in K.PYTEST_MESSAGE_MARKERS:
        any_pytest = any_pytest | t.contains(m)
    any_django = F.lit(False)
    for m in K.DJANGO_MESSAGE_MARKERS:
        any_django = any_django | t.contains(m)
    return F.when(any_pytest, t.contains("match")).otherwise(any_django)


def more_than_n_words(text, n: int) -> Column:
    """More than ``n`` white-space separated words, decided by a bounded possessive regex
    (stops after n + 1 words; no word array is built)."""
    return col_of(text).rlike(rf"(?U)^\s*+(?:\S++\s++){{{n}}}\S")


def max_words(text, n: int = 50) -> Column:
    """At most n white-space separated words."""
    return ~more_than_n_words(text, n)


def statement_gate(text, min_words: int = 40) -> Column:
    """Statement part of B14: keep when more than ``min_words`` words and no link, keyword
    reference, GitLab issue, commit hash or media name. Cheap tests come first."""
    t = col_of(text)
    return (~max_words(t, min_words)
            & ~contains_hyperlinks(t)
            & ~contains_keyword_reference(t)
            & ~contains_gitlab_issue(t)
            & ~contains_commit_hash(t)
            & ~contains_media(t))


def has_import_or_attribute_error(log) -> Column:
    """Some line naming attribute/import also holds error/fail (lower case)."""
    lines = F.split(F.lower(col_of(log)), "\n")
    return F.exists(lines, lambda l: (l.contains("attribute") | l.contains("import"))
                    & (l.contains("error") | l.contains("fail")))


def is_test_path_words(path) -> Column:
    """Lower-cased path split on blank, '_', '/', '.' holds test/tests/testing."""
    parts = F.split(F.lower(col_of(path)), r"[ _/.]")
    return F.arrays_overlap(parts, F.array(*[F.lit(w) for w in K.TEST_PATH_WORDS]))


def is_test_path_substring(path) -> Column:
    """test/tests/e2e/testing as a substring (``latest.py`` counts)."""
    return col_of(path).rlike(regex_union(K.TEST_PATH_SUBSTRINGS))


def max_chars(text, n: int = 5_000_000) -> Column:
    """B18."""
    return F.length(col_of(text)) <= n


def token_length_between(ids, lo: int, hi: int) -> Column:
    """Lo <= len < hi."""
    s = F.size(col_of(ids))
    return (s >= lo) & (s < hi)


def is_non_test_asset(path) -> Column:
    """Ends with one of the non-test suffixes ('csv' without a dot)."""
    return col_of(path).rlike("(" + regex_union(K.NON_TEST_EXTS) + ")$")


def has_nonempty_prediction(model_patch="model_patch") -> Column:
    """B22."""
    p = col_of(model_patch)
    return F.coalesce(p.isNotNull() & (p != ""), F.lit(False))


def valid_patch_format(patch) -> Column:
    """A line starting with each of the four diff markers."""
    p = col_of(patch)
    return (p.rlike(r"(?m)^diff --git") & p.rlike(r"(?m)^--- a/")
            & p.rlike(r"(?m)^\+\+\+ b/") & p.rlike(r"(?m)^@@ "))


def patch_defines_gold_test(fail_to_pass, test_patch) -> Column:
    """Some FAIL_TO_PASS file (text before '::') has a ``diff --git a/<file>`` in the
    test patch. ``fail_to_pass`` is an array<string> column."""
    tp = col_of(test_patch)
    return F.coalesce(F.exists(col_of(fail_to_pass), lambda t: tp.contains(
        F.concat(F.lit("diff --git a/"), F.substring_index(t, "::", 1)))), F.lit(False))
