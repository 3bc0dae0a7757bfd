"""Repository-file operators (C16, C18, C19, J2) over snapshot tables
``(corpus_id, path, content)``."""

from __future__ import annotations

import ast
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.functions.text import as_string_array, bind, col_of
from diffloom.operators.joins import dealt, merged
from diffloom.session import materialize, ship_package


def parse_test_ids(instances: DataFrame, snapshot: DataFrame | None = None, id_col: str = "instance_id") -> DataFrame:
    """Gold test ids -> (instance_id, test_file, test_case, test_type).

    ``file::case`` splits at the first ``::``; ``name (module.Class)`` becomes
    ``module/path.py`` + ``Class.name``; other forms are skipped. With a snapshot
    (``corpus_id, path``) the file must exist; for the second form ``tests/<file>`` is tried
    too, but the first form is returned, as the original does."""
    parts = []
    for cat in (K.FAIL_TO_PASS, K.PASS_TO_PASS):
        t = instances.schema[cat].dataType.simpleString()
        arr = F.col(cat) if t.startswith("array") else as_string_array(cat)
        cols = [id_col] + (["corpus_id"] if "corpus_id" in instances.columns else [])
        parts.append(instances.select(*cols, F.explode(arr).alias("t"), F.lit(cat).alias("test_type")))
    x = parts[0].unionByName(parts[1])
    t = F.col("t")
    colon = t.contains("::")
    uni_pat = r"^(.*?) \((.*)\)$"
    inner = F.regexp_extract(t, uni_pat, 2)
    uni = ~colon & t.contains(" (") & t.endswith(")") & inner.contains(".")
    module = F.regexp_extract(inner, r"^(.*)\.([^.]*)$", 1)
    klass = F.regexp_extract(inner, r"^(.*)\.([^.]*)$", 2)
    out = x.select("*", colon.alias("__colon"),
                   F.when(colon, F.substring_index(t, "::", 1))
                    .when(uni, F.concat(F.replace(module, F.lit("."), F.lit("/")), F.lit(".py"))).alias("test_file"),
                   F.when(colon, F.substring(t, F.instr(t, "::") + 2, 1 << 30))
                    .when(uni, F.concat(klass, F.lit("."), F.regexp_extract(t, uni_pat, 1))).alias("test_case"))
    out = out.where(F.col("test_file").isNotNull())
    keep = [id_col, "test_file", "test_case", "test_type"]
    if snapshot is None:
        return out.select(*keep)
    paths = snapshot.select("corpus_id", F.col("path").alias("test_file"))
    direct = out.join(paths, ["corpus_id", "test_file"], "left_semi")
    alt = (out.where(~F.col("__colon")).withColumn("__alt", F.concat(F.lit("tests/"), F.col("test_file")))
           .join(paths.withColumnRenamed("test_file", "__alt"), ["corpus_id", "__alt"], "left_semi"))
    alt = alt.join(direct.select(id_col, "test_file", "test_case"), [id_col, "test_file", "test_case"], "left_anti")
    return direct.select(*keep).unionByName(alt.select(*keep))


# fixed value: import statements of Python source
_IMPORT_RE = r"(?m)^\s*(?:from\s+(\.*)([\w.]*)\s+import\s|import\s+([\w.]+))"


#: Bytes of the files' table whose directory suffixes one task sorts.
SUFFIX_BYTES = 1 << 20


def import_lines(content) -> Column:
    """The import statements of a content, each once, as written."""
    return F.array_distinct(F.regexp_extract_all(col_of(content), F.lit(_IMPORT_RE), F.lit(0)))


def import_edges(snapshot: DataFrame, file: str = "path") -> DataFrame:
    """Module references per file: (corpus_id, ``file``, level, module) from the import lines of the column ``imports``, or
    of ``content`` where the snapshot has no such column."""
    lines = F.col("imports") if "imports" in snapshot.columns else import_lines("content")
    e = snapshot.select("corpus_id", file, F.explode(lines).alias("line"))
    dots, from_mod, imp_mod = (F.regexp_extract("line", _IMPORT_RE, k) for k in (1, 2, 3))
    return e.select("corpus_id", file, F.length(dots).alias("level"), F.when(imp_mod != "", imp_mod).otherwise(from_mod).alias("module"))


def resolve_edges(snapshot: DataFrame, file: str = "path") -> DataFrame:
    """C18 edges file -> file: (corpus_id, src, dst), each once, where the column ``file`` names a file. The module path is
    ``module.split('.')`` minus its last ``level`` parts (relative imports), joined by '/'; it resolves to the ``.py`` files of the
    first directory whose path (as a string, from the root) ends with it — first = shallowest,
    then by name. "Ends with" becomes an equi-join on every string suffix of the (few)
    directory paths. The suffixes are many times the files: they are dealt to as many tasks as the files have
    bytes, and sorted once, for the aggregate and the join."""
    e = import_edges(snapshot, file)
    parts = F.split("module", r"\.")
    kept = F.when(F.col("level") > 0, F.slice(parts, 1, F.greatest(F.size(parts) - F.col("level"), F.lit(0)))).otherwise(parts)
    e = e.select("corpus_id", F.col(file).alias("src"),
                 F.when(F.col("module") == "", F.lit("")).otherwise(F.array_join(kept, "/")).alias("suffix"))
    name = F.substring_index("path", "/", -1)
    dir_of = F.concat(F.lit("/"), F.substr("path", F.lit(1), F.length("path") - F.length(name) - 1))
    dirs = snapshot.select("corpus_id", dir_of.alias("dir")).distinct().withColumn("depth", F.size(F.split("dir", "/")))
    suff = dirs.select("corpus_id", "dir", "depth", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("dir") + 1), lambda i: F.substring("dir", i, 1 << 20))).alias("suffix"))
    suff = suff.union(dirs.select("corpus_id", "dir", "depth", F.lit("").alias("suffix")))
    # one directory for each suffix before the join: an import meets one row, not every directory
    suff = dealt(suff, snapshot, SUFFIX_BYTES, "corpus_id", "suffix").groupBy("corpus_id", "suffix").agg(
        F.min(F.struct("depth", "dir")).alias("first"))
    first = e.join(merged(suff), ["corpus_id", "suffix"]).select("corpus_id", "src", "first.dir")
    files = snapshot.where(F.col("path").endswith(".py")).select("corpus_id", F.col(file).alias("dst"), dir_of.alias("dir"))
    return first.join(merged(files), ["corpus_id", "dir"]).select("corpus_id", "src", "dst").distinct()


def _numbered(snapshot: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows of the snapshot (``listed``) and of the targets with the number ``file`` of their ``(corpus_id, path)``, the
    same in all its rows; ``first`` marks one of them, ``root`` those of a target. Contents are left behind before the
    shuffle, but for their import lines; a file without a path has none."""
    key = ["corpus_id", "path"]
    lines = F.when(F.col("path").isNotNull(), import_lines("content"))
    rows = snapshot.select(*key, lines.alias("imports"), F.lit(True).alias("listed")).union(
        targets.select(*key, F.lit(None).cast("array<string>"), F.lit(False)))
    rows = rows.repartition(*key).withColumn("row", F.monotonically_increasing_id())
    same = Window.partitionBy(*key)
    rows = rows.select(*key, "imports", "listed", "row", F.min("row").over(same).alias("file"), F.max(~F.col("listed")).over(same).alias("root"))
    return rows.withColumn("first", F.col("row") == F.col("file")).drop("row")


def _fresh(rows: DataFrame, known: DataFrame, *key: str) -> DataFrame:
    """The rows that are not among the known, each once, in one shuffle of both."""
    both = rows.select(*key, F.lit(False).alias("old")).union(known.select(*key, F.lit(True)))
    return both.groupBy(*key).agg(F.max("old").alias("old")).where(~F.col("old")).select(*key)


def import_closure(snapshot: DataFrame, targets: DataFrame) -> DataFrame:
    """Files reachable from each target ``(corpus_id, path)`` through imports.

    Path doubling: round k knows what is within 2**k - 1 imports of the targets, and jumps of 2**k imports; the
    jumps lead on to what is within 2**(k + 1) - 1, and are joined with themselves to jumps twice as long. A
    jump that one of the last round covers is dropped, and, in a round with more jumps than the last, one that any shorter
    one covers: a shortest path is made of shortest jumps. Rounds grow with
    the logarithm of the longest chain, all repositories together, and end when one finds nothing new (distances have no gaps),
    so the closure is complete; a repository where a round finds nothing new takes no part in later ones. A round writes its
    new pairs and new jumps only, to the shared checkpoint folder (it survives executor loss and cuts the lineage). The rounds
    work on numbers of files, names come back at the end. All joins shuffle both sides: the tables are as large as the
    snapshot, and their files are a small part of what they are in memory."""
    pair = ["corpus", "src", "dst"]
    files = materialize(_numbered(snapshot, targets), "import-files")
    corpus = F.xxhash64("corpus_id").alias("corpus")  # only to leave out repositories that are done
    edges = resolve_edges(files.where("listed").select("corpus_id", "path", "imports", "file"), "file")
    jumps = materialize(edges.where("src <> dst").select(corpus, "src", "dst"), "import-jumps")
    shorter, n = None, jumps.count()
    reached = materialize(files.where("first and root").select(corpus, F.col("file").alias("root"), "file"), "import-reached")
    while n:
        onward = reached.join(merged(jumps.select(F.col("src").alias("file"), "dst")), "file").select("corpus", "root", F.col("dst").alias("file"))
        new = materialize(_fresh(onward, reached, "corpus", "root", "file"), "import-reached")
        if new.isEmpty():
            break
        reached = reached.union(new)
        active = jumps.join(merged(new.select("corpus").distinct()), "corpus", "left_semi")
        twice = active.select("corpus", "src", F.col("dst").alias("via")).join(merged(jumps.select(F.col("src").alias("via"), "dst")), "via")
        longer = materialize(_fresh(twice.where("src <> dst"), jumps, *pair), "import-jumps")
        last, n = n, longer.count()
        if n > last and shorter is not None:
            longer = materialize(_fresh(longer, shorter, *pair), "import-fewer-jumps")
            n = longer.count()
        shorter = jumps if shorter is None else shorter.union(jumps)
        jumps = longer
    names = files.where("first")
    found = reached.select("root", "file").join(merged(names.select("file", "corpus_id", F.col("path").alias("name"))), "file")
    roots = names.where("root").select(F.col("file").alias("root"), F.col("path").alias("root_name"))
    return found.join(merged(roots), "root").select("corpus_id", F.col("root_name").alias("root"), F.col("name").alias("file"))


def doc_contents(path, content) -> Column:
    """C19 ``contents`` encoding: ``path\\ncontent``."""
    return F.concat_ws("\n", col_of(path), col_of(content))


def documented(source: str) -> str | None:
    """The docstring of a Python file's module, then, level by level, the name and docstring of every class and function
    that has one; None for a file that does not parse."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError, MemoryError):  # what ast raises for text that is no Python
        return None
    definitions = (n for n in ast.walk(tree) if isinstance(n, (ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)))
    named = ((n.name, ast.get_docstring(n)) for n in definitions)
    return "\n\n".join([ast.get_docstring(tree) or "", *(f"{name}\n{doc}" for name, doc in named if doc)])


def doc_docstrings(snapshot: DataFrame) -> DataFrame:
    """C19 ``docstrings`` encoding: the path, then the docstrings of the file's parse tree (``documented``), or the content
    of a file that does not parse. Row by row in Arrow batches, no shuffle; a null content is empty."""
    ship_package(snapshot.sparkSession)

    @F.pandas_udf("string")
    def docs(contents: pd.Series) -> pd.Series:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # of odd escapes in the files' own strings
            return contents.map(documented)

    content = F.coalesce("content", F.lit(""))
    return snapshot.select("corpus_id", "path", F.concat(col_of("path"), F.lit("\n"), F.coalesce(docs(content), content)).alias("text"))


ENCODINGS = {"contents": lambda df: df.select("corpus_id", "path", doc_contents("path", "content").alias("text")),
             "docstrings": doc_docstrings}


def register_encoding(name: str, fn) -> None:
    """M3: snapshot DataFrame -> (corpus_id, path, text)."""
    ENCODINGS[name] = fn


def edits_only_text(content, hunks, context: int = 15, compat: bool = False) -> Column:
    """J2 for one file: numbered lines around each hunk. start = old_start - context,
    end = start + old_len + context (the end follows the moved start, as in the original);
    ``...`` marks cut text; windows follow hunk order. A negative start is clamped to 0, or
    with ``compat=True`` counts from the end of the file as Python slicing does.

    ``hunks`` = array<struct<old_start, old_len>>."""
    def piece(file, h):
        n = file["n"]
        start = h["old_start"] - context
        end = start + h["old_len"] + context
        if compat:
            lo = F.when(start < 0, F.greatest(n + start, F.lit(0))).otherwise(F.least(start, n))
            hi = F.when(end < 0, F.greatest(n + end, F.lit(0))).otherwise(F.least(end, n))
        else:
            lo = F.greatest(start, F.lit(0))
            hi = F.least(end, n)
        body = bind(lo, lambda low: F.array_join(F.slice(file["numbered"], low + 1, F.greatest(hi - low, F.lit(0))), "\n"))
        return F.concat(F.when(start > 0, F.lit("...\n")).otherwise(F.lit("")), body, F.lit("\n"),
                        F.when(end < n, F.lit("...\n")).otherwise(F.lit("")))

    # the file is split and its lines numbered once, not again for each hunk
    def pieces_of(lines):
        numbered = F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(" "), x))
        return bind(F.struct(F.size(lines).alias("n"), numbered.alias("numbered")), lambda file: F.transform(col_of(hunks), lambda h: piece(file, h)))

    pieces = bind(F.split(col_of(content), "\n"), pieces_of)
    return F.regexp_replace(F.array_join(pieces, ""), r"^\n+|\n+$", "")
