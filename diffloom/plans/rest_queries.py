"""Registered queries: edits-only code, docstrings, issue statements and references, package ranks, document splits
(B7(c), C2b, C19, C21, G4, J2, L1), with their DuckDB SQL from the structured rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diffloom.operators.files import doc_docstrings, edits_only_text
from diffloom.operators.issues import live_statement, with_issue_reference
from diffloom.operators.joins import dealt
from diffloom.operators.reports import package_rank
from diffloom.operators.sampling import train_valid_split
from diffloom.plans.common import t

REST_ORACLES: dict[str, str] = {}


def edit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a file of numbered lines, its lines are the hunks of a diff. MD5 of the code text around the hunks,
    with negative starts clamped and as Python slices them. One shuffle, of the hunks."""
    n = (20 + F.col("l_orderkey") % 50).cast("int")
    row = F.struct("l_linenumber", (1 + F.col("l_partkey") % 60).cast("int").alias("old_start"),
                   (F.col("l_suppkey") % 9).cast("int").alias("old_len"))
    files = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("hunks"))
    lines = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("line "), i.cast("string"), F.lit(" of "), F.col("l_orderkey").cast("string")))
    files = files.withColumn("content", F.array_join(lines, "\n"))
    return files.select("l_orderkey", F.size("hunks").cast("long").alias("n_hunks"),
                        F.md5(edits_only_text(F.col("content"), F.col("hunks"))).alias("clamped_md5"),
                        F.md5(edits_only_text(F.col("content"), F.col("hunks"), compat=True)).alias("compat_md5"))


REST_ORACLES["edit_windows"] = r"""
WITH h AS (
  SELECT l_orderkey AS k, l_linenumber AS pos, 1 + l_partkey % 60 AS s, l_suppkey % 9 AS len, 20 + l_orderkey % 50 AS n,
         1 + l_partkey % 60 - 15 AS a, 1 + l_partkey % 60 + l_suppkey % 9 AS b
  FROM lineitem),
w AS (
  SELECT *, greatest(a, 0) AS lo1, least(b, n) AS hi1, CASE WHEN a < 0 THEN greatest(n + a, 0) ELSE least(a, n) END AS lo2,
         least(b, n) AS hi2, CASE WHEN a > 0 THEN '...' || chr(10) ELSE '' END AS head, CASE WHEN b < n THEN '...' || chr(10) ELSE '' END AS tail
  FROM h),
p AS (
  SELECT k, pos, s, len,
    head || array_to_string(list_transform(range(lo1 + 1, greatest(hi1, lo1) + 1), lambda i: i || ' line ' || i || ' of ' || k), chr(10)) || chr(10) || tail AS one,
    head || array_to_string(list_transform(range(lo2 + 1, greatest(hi2, lo2) + 1), lambda i: i || ' line ' || i || ' of ' || k), chr(10)) || chr(10) || tail AS two
  FROM w)
SELECT k AS l_orderkey, count(*) AS n_hunks, md5(trim(string_agg(one, '' ORDER BY pos, s, len), chr(10))) AS clamped_md5,
       md5(trim(string_agg(two, '' ORDER BY pos, s, len), chr(10))) AS compat_md5
FROM p GROUP BY k"""


def issue_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 complete and C2b: the statement of an issue for each order line, and whether it refers to an issue: by keyword,
    by a link, or by the number of one that its repository has (suppliers in credit are the known issues)."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    number = F.col("l_suppkey").cast("string")
    kind = F.col("l_partkey") % 5
    body = (F.when(kind == 0, F.concat(F.lit("Like #"), number)).when(kind == 1, F.concat(F.lit("This fixes #"), number, F.lit(".")))
            .when(kind == 2, F.lit("See https://gitlab.com/group/project/-/issues/7")).when(kind == 3, F.concat(F.lit("Room "), number)))
    issues = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("instance_id"),
        F.concat(F.lit("owner/r"), (F.col("l_linenumber") % 3).cast("string")).alias("repo"),
        live_statement(F.concat(F.lit("Part "), F.col("l_partkey").cast("string")), body,
                       F.filter(F.array("l_returnflag", "l_linestatus"), lambda c: c != "N")).alias("statement"))
    known = t(spark, sf_dir, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("owner/r"), (F.col("s_suppkey") % 3).cast("string")).alias("repo"), F.col("s_suppkey").alias("issue_number"))
    return with_issue_reference(issues, "statement", "repo", known)


REST_ORACLES["issue_statements"] = r"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS instance_id, 'owner/r' || (l_linenumber % 3) AS repo,
  'Part ' || l_partkey || chr(10) ||
  CASE l_partkey % 5 WHEN 0 THEN 'Like #' || l_suppkey WHEN 1 THEN 'This fixes #' || l_suppkey || '.'
    WHEN 2 THEN 'See https://gitlab.com/group/project/-/issues/7' WHEN 3 THEN 'Room ' || l_suppkey ELSE '' END || chr(10) ||
  array_to_string(list_transform(list_filter([l_returnflag, l_linestatus], lambda c: c <> 'N'), lambda c: 'Comment: ' || c), chr(10)) AS statement,
  l_partkey % 5 IN (1, 2) OR (l_partkey % 5 = 0 AND l_linenumber % 3 = l_suppkey % 3 AND
    EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)) AS has_issue_reference
FROM lineitem"""


def package_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C21 + L1: parts as packages, order lines as their links, suppliers as repositories; packages of size 1 are written already."""
    name = lambda key: F.concat(F.lit("package-"), F.col(key).cast("string"))
    site = lambda key: F.concat(F.lit("https://github.com/owner/s"), F.col(key).cast("string"))
    part = t(spark, sf_dir, "part")
    packages = part.select(F.col("p_partkey").alias("rank"), name("p_partkey").alias("name"), F.col("p_type").alias("url"))
    label = F.element_at(F.array(*[F.lit(x) for x in ("Source Code", "Homepage", "Issues", "Download")]), (1 + F.col("l_linenumber") % 4).cast("int"))
    links = t(spark, sf_dir, "lineitem").select(
        name("l_partkey").alias("name"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("pos"), label.alias("label"),
        F.when(F.col("l_returnflag") == "R", F.lit("https://example.org")).otherwise(site("l_suppkey")).alias("href"))
    stats = t(spark, sf_dir, "supplier").select(site("s_suppkey").alias("github"), F.col("s_nationkey").cast("long").alias("stars"),
                                                F.length("s_name").cast("long").alias("pulls"))
    written = part.where("p_size = 1").select(name("p_partkey").alias("name"))
    return package_rank(packages, links, stats, written).select("rank", "name", "url", "github", "stars", "pulls")


REST_ORACLES["package_ranks"] = r"""
WITH first AS (
  SELECT l_partkey, arg_min('https://github.com/owner/s' || l_suppkey, (l_orderkey, l_linenumber, l_suppkey)) AS github,
         arg_min(l_suppkey, (l_orderkey, l_linenumber, l_suppkey)) AS supp
  FROM lineitem WHERE l_linenumber % 4 IN (0, 1) AND l_returnflag <> 'R' GROUP BY 1)
SELECT p_partkey AS rank, 'package-' || p_partkey AS name, p_type AS url, f.github, CAST(s_nationkey AS BIGINT) AS stars,
       CAST(length(s_name) AS BIGINT) AS pulls
FROM part LEFT JOIN first f ON f.l_partkey = p_partkey LEFT JOIN supplier ON s_suppkey = f.supp
WHERE p_size <> 1"""


def document_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of two splits, by the hash of its id: no shuffle, the same after any rerun."""
    return train_valid_split(t(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", ratio=0.1)


REST_ORACLES["document_splits"] = r"""
SELECT doc_id, source, CASE WHEN CAST('0x' || substr(md5(doc_id || '|42'), 1, 8) AS BIGINT) < 429496729 THEN 'validation' ELSE 'train' END AS split
FROM documents"""


def docstring_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python file for each part, with definitions inside strings and comments, nested ones, signatures over several
    lines, and, for every fifth part, a syntax error. MD5 of the encoded text. Only the parts' columns are shuffled: a part's
    few bytes are much work, so they are dealt to more tasks than the table's files would make."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    p = dealt(p, p, PART_BYTES, "p_partkey", "p_name")
    module = F.when(F.col("p_partkey") % 3 != 0, '"""Part {name}."""\n').otherwise("# no docstring\n")
    broken = F.when(F.col("p_partkey") % 5 == 0, "def (:\n").otherwise("")
    body = F.lit(PART_SOURCE)
    for mark, column in (("{key}", "p_partkey"), ("{brand}", "p_brand"), ("{size}", "p_size")):
        body = F.replace(body, F.lit(mark), F.col(column).cast("string"))
    path = F.concat(F.lit("pkg/part_"), F.col("p_partkey").cast("string"), F.lit(".py"))
    files = p.select(F.col("p_partkey").alias("corpus_id"), path.alias("path"),
                     F.concat(F.replace(module, F.lit("{name}"), F.col("p_name")), body, broken).alias("content"))
    return doc_docstrings(files).select("corpus_id", "path", F.md5("text").alias("text_md5"))


#: Bytes of the parts' table whose files one task parses.
PART_BYTES = 32 << 10

PART_SOURCE = '''TEMPLATE = """
def fake():
    "of a string"
"""

class C{key}:
    """Brand {brand}.

      Size {size}.
    End.
    """

    def inner(self, a={"x:": (1, 2)}):  # def hidden(): "no"
        r"""Inner {key}"""
        return 1

async def outer(
    a,
    b=")",
):
    "Outer {size}"

def silent():
    return "no docstring"
'''

REST_ORACLES["docstring_texts"] = r"""
WITH f AS (
  SELECT p_partkey, 'pkg/part_' || p_partkey || '.py' AS path,
    CASE WHEN p_partkey % 3 <> 0 THEN 'Part ' || p_name || '.' ELSE '' END AS doc, chr(10) AS nl, p_brand, p_size, p_name,
    replace(replace(replace('""" + PART_SOURCE.replace("'", "''") + r"""', '{key}', CAST(p_partkey AS VARCHAR)), '{brand}', p_brand),
            '{size}', CAST(p_size AS VARCHAR)) AS body
  FROM part)
SELECT p_partkey AS corpus_id, path, md5(path || nl || CASE WHEN p_partkey % 5 = 0 THEN
    CASE WHEN p_partkey % 3 <> 0 THEN repeat('"', 3) || 'Part ' || p_name || '.' || repeat('"', 3) ELSE '# no docstring' END || nl || body || 'def (:' || nl
  ELSE doc || nl || nl || 'C' || p_partkey || nl || 'Brand ' || p_brand || '.' || nl || nl || '  Size ' || p_size || '.' || nl || 'End.' ||
    nl || nl || 'outer' || nl || 'Outer ' || p_size || nl || nl || 'inner' || nl || 'Inner ' || p_partkey END) AS text_md5
FROM f"""
