"""DuckDB SQL for ``dialect_queries`` and ``view_queries``, from the structured rows: not from the text
that those queries build and read back."""

from __future__ import annotations

from diffloom.operators.prompts import EXCERPTS, INTRO, PATCH_INSTRUCTION
from diffloom.plans.common import EVENTS_PER_RUN, TIMEOUT_VALUE

VIEW_ORACLES: dict[str, str] = {}

VIEW_ORACLES["grade_dialects"] = f"""
WITH ev AS (
  SELECT 'run-' || CAST(event_id // {EVENTS_PER_RUN} AS VARCHAR) AS run_id, 'inst-' || CAST(user_id AS VARCHAR) AS instance_id,
         user_id % 12 AS d, ts, event_id, event_type AS k, value,
         CASE WHEN value < 40 THEN 'PASSED' WHEN value < 80 THEN 'FAILED' WHEN value < 100 THEN 'ERROR'
              WHEN value < 130 THEN 'XFAIL' ELSE 'SKIPPED' END AS s
  FROM events),
runs AS (SELECT run_id, instance_id, max(d) AS d, max(value) < {TIMEOUT_VALUE} AS applied FROM ev GROUP BY 1, 2),
seen AS (
  SELECT *, CASE d WHEN 0 THEN 't.py::' || k WHEN 1 THEN 't.py::' || k || '[/' || k || ']' WHEN 2 THEN 't.py::' || k
       WHEN 3 THEN 't.py::' || k WHEN 4 THEN 't.py::' || k || '[1]' WHEN 5 THEN 'test_' || k WHEN 6 THEN 'test_' || k || ' (m.T)'
       WHEN 7 THEN k || ' works ' WHEN 8 THEN k || ' renders' WHEN 9 THEN 'tests/' || k || '.test.js'
       WHEN 10 THEN 'suite - does ' || k END AS test
  FROM ev
  WHERE CASE d WHEN 3 THEN s IN ('PASSED', 'FAILED') WHEN 5 THEN s IN ('PASSED', 'FAILED', 'ERROR') WHEN 6 THEN s <> 'XFAIL'
       WHEN 7 THEN s = 'FAILED' WHEN 8 THEN s = 'FAILED' WHEN 9 THEN s IN ('PASSED', 'FAILED') WHEN 10 THEN s IN ('PASSED', 'FAILED')
       WHEN 11 THEN false ELSE true END),
last AS (SELECT run_id, instance_id, test, arg_max(s, (ts, event_id)) AS status FROM seen GROUP BY 1, 2, 3)
SELECT r.run_id, r.instance_id, r.applied, CASE WHEN r.d = 11 THEN 'unknown dialect' END AS reject_reason, l.test, l.status
FROM runs r LEFT JOIN last l ON r.applied AND l.run_id = r.run_id AND l.instance_id = r.instance_id"""

VIEW_ORACLES["text_gates"] = """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey % 15 AS k, l_suppkey % 6 AS p, l_returnflag AS rf,
         length(CAST(l_partkey AS VARCHAR)) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber,
  rf = 'R' AS valid_pull, k < 13 AS valid_instance, k < 12 AS test_patch, k = 4 AS commit_hash, k IN (0, 3) AS link,
  k IN (0, 3) AS link_repo, k = 1 AS media, k = 2 AS keyword, k = 3 AS gitlab, k IN (5, 7) AS message_check,
  k NOT IN (10, 14) AS short, k IN (9, 10) AS gate, k = 8 AS import_error, p IN (1, 2, 5) AS test_words,
  p IN (0, 1, 2, 5) AS test_substring, k NOT IN (4, 10, 14) AS few_chars,
  k IN (0, 3, 4, 5, 6, 8, 9, 11, 12) AS length_between, p IN (3, 4, 5) AS asset, k < 13 AS prediction
FROM x"""

VIEW_ORACLES["patch_views"] = """
WITH li AS (
  SELECT l_orderkey AS o, l_linenumber AS ln, l_suppkey % 4 AS fid, CAST(floor(l_quantity) AS INTEGER) AS q, l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem),
h AS (
  SELECT *, 1 + q % 2 AS n_ctx, CASE rf WHEN 'R' THEN 1 + q % 3 WHEN 'N' THEN 1 ELSE 0 END AS n_rem,
         CASE rf WHEN 'A' THEN 1 + q % 3 WHEN 'N' THEN 1 + q % 2 ELSE 0 END AS n_add, ln * 10 AS st FROM li),
hh AS (
  SELECT *, n_ctx + n_rem AS ol, n_ctx + n_add AS nl,
         CASE WHEN rf = 'A' AND ls = 'F' THEN '\\ No newline at end of file' || chr(10) ELSE '' END AS tail FROM h),
hunk AS (
  SELECT *, '@@ -' || st || CASE WHEN ol = 1 THEN '' ELSE ',' || ol END || ' +' || st || CASE WHEN nl = 1 THEN '' ELSE ',' || nl END
            || ' @@ def f' || ln || '():' || chr(10) || ' ctx' || chr(10) || repeat('--- old' || chr(10), n_rem)
            || repeat('+new' || chr(10), n_add) || repeat(' ctx' || chr(10), n_ctx - 1) || tail AS text,
         n_rem + n_add AS changes FROM hh),
hunks AS (SELECT *, row_number() OVER (PARTITION BY o, fid ORDER BY ln, rf, ls, text) AS pos FROM hunk),
fl AS (
  SELECT o, fid, CASE WHEN fid % 2 = 0 THEN 'tests/test_mod_' ELSE 'pkg/mod_' END || fid || '.py' AS path,
         max(CASE WHEN pos = 1 AND rf = 'A' AND ls = 'O' THEN 1 ELSE 0 END) AS added,
         max(CASE WHEN pos = 1 AND rf = 'R' AND ls = 'F' THEN 1 ELSE 0 END) AS removed,
         string_agg(text, '' ORDER BY pos) AS body FROM hunks GROUP BY 1, 2),
ft AS (
  SELECT *, 'diff --git a/' || path || ' b/' || path || chr(10)
       || CASE WHEN added = 1 THEN 'new file mode 100644' || chr(10) WHEN removed = 1 THEN 'deleted file mode 100644' || chr(10) ELSE '' END
       || 'index 1a2b3c4..5d6e7f8 100644' || chr(10)
       || '--- ' || CASE WHEN added = 1 THEN '/dev/null' ELSE 'a/' || path END || chr(10)
       || '+++ ' || CASE WHEN removed = 1 THEN '/dev/null' ELSE 'b/' || path END || chr(10) || body AS text FROM fl),
-- minimal hunks: the changes and one line more (an empty line reads as one blank)
mh AS (
  SELECT k.*, CASE WHEN n_ctx = 2 THEN ' ctx' WHEN tail <> '' THEN '\\ No newline at end of file' ELSE ' ' END AS extra FROM hunks k),
strict(flag) AS (VALUES (false), (true)),
mn AS (
  SELECT o, fid, flag, pos, st + 1 AS s, n_rem + 1 AS a, n_add + 1 AS b, repeat('--- old' || chr(10), n_rem) || repeat('+new' || chr(10), n_add) || extra || chr(10) AS t,
         coalesce(sum(n_add - n_rem) OVER (PARTITION BY o, fid, flag ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS moved
  FROM mh, strict WHERE NOT flag OR ol > 1 AND nl > 1),
mf AS (
  SELECT fl.o, fl.fid, strict.flag, '--- a/' || path || chr(10) || '+++ b/' || path || chr(10)
         || coalesce(string_agg('@@ -' || s || ',' || a || ' +' || CAST(s + moved AS BIGINT) || ',' || b || ' @@' || chr(10) || t, '' ORDER BY pos), '') AS text
  FROM fl CROSS JOIN strict LEFT JOIN mn ON mn.o = fl.o AND mn.fid = fl.fid AND mn.flag = strict.flag
  WHERE added = 0 AND removed = 0 GROUP BY fl.o, fl.fid, strict.flag, path),
mo AS (SELECT o, string_agg(text, '' ORDER BY fid) FILTER (WHERE NOT flag) AS m, string_agg(text, '' ORDER BY fid) FILTER (WHERE flag) AS ms FROM mf GROUP BY 1),
po AS (
  SELECT o, string_agg(text, '' ORDER BY fid) AS patch, coalesce(string_agg(text, '' ORDER BY fid) FILTER (WHERE fid % 2 = 1), '') AS code,
         coalesce(string_agg(text, '' ORDER BY fid) FILTER (WHERE fid % 2 = 0), '') AS test,
         coalesce(string_agg(path, ',' ORDER BY fid) FILTER (WHERE added = 0), '') AS sources,
         coalesce(string_agg(path, ',' ORDER BY fid) FILTER (WHERE fid % 2 = 0), '') AS directives,
         coalesce(string_agg('test_mod_' || fid, ',' ORDER BY fid) FILTER (WHERE fid % 2 = 0), '') AS modules,
         bool_or(fid = 0) AS has0, max(CASE WHEN added = 0 THEN 1 ELSE 0 END) = 1 AS some_old, max(CASE WHEN removed = 0 THEN 1 ELSE 0 END) = 1 AS some_new
  FROM ft GROUP BY 1)
SELECT po.o AS order_key, md5(code) AS code_md5, md5(test) AS test_md5, md5(test) AS tests_md5,
       md5(CASE po.o % 4 WHEN 0 THEN chr(10) || patch WHEN 1 THEN patch WHEN 2 THEN patch ELSE '<none>' END) AS diff_md5,
       md5(coalesce(mo.m, '')) AS minimal_md5, md5(coalesce(mo.ms, '')) AS minimal_strict_md5, sources, sources AS a_files, directives, modules,
       has0 AS defines_gold, po.o % 2 = 1 AND some_old AND some_new AS valid_cut, 'own__rep-' || po.o AS instance_id
FROM po LEFT JOIN mo ON mo.o = po.o"""

VIEW_ORACLES["join_views"] = """
WITH o AS (SELECT o_orderkey AS instance_id, o_orderstatus AS st, o_orderpriority AS pr, o_custkey AS c FROM orders)
SELECT 'with_outputs' AS kind, instance_id FROM o WHERE st <> 'P' AND instance_id % 3 <> 0
UNION ALL SELECT 'kept', instance_id FROM o WHERE c % 5 <> 1
UNION ALL SELECT 'rejected', instance_id FROM o WHERE c % 5 = 1
UNION ALL SELECT 'spec', instance_id FROM o WHERE pr <> '5-LOW'
UNION ALL SELECT 'no_spec', instance_id FROM o WHERE pr = '5-LOW'
UNION ALL SELECT 'unresolved', instance_id FROM o WHERE instance_id % 4 = 0
UNION ALL SELECT 'located', instance_id FROM o WHERE st <> 'P'"""

VIEW_ORACLES["order_hits"] = """
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS k FROM lineitem)
SELECT o_orderkey AS instance_id, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY k), '') AS hits
FROM orders LEFT JOIN r ON l_orderkey = o_orderkey AND k <= 3 GROUP BY 1"""

_IDS = r"list_transform(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'), lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT))"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_HEAD = f"'{INTRO}' || chr(10)"
_MID = "'<issue>' || chr(10) || text || chr(10) || '</issue>' || chr(10) || '<code>' || chr(10)"
_CODE = "code || chr(10) || '</code>' || chr(10)"

VIEW_ORACLES["prompt_forms"] = rf"""
WITH c AS (SELECT conv_id, turn, text, '[start of a.py]' || chr(10) || text || chr(10) || '[end of a.py]' || chr(10) || '[start of b.py]' AS code FROM conversations)
SELECT conv_id, turn,
  md5({_HEAD} || {_MID} || chr(10) || {_CODE} || '{PATCH_INSTRUCTION}') AS style_2_md5,
  md5({_HEAD} || '{EXCERPTS}' || chr(10) || {_MID} || chr(10) || {_CODE} || '{PATCH_INSTRUCTION}') AS style_2_edits_only_md5,
  md5({_HEAD} || {_MID} || chr(10) || {_CODE} || 'A patch has this form:' || chr(10) || '<patch>' || chr(10) || '</patch>' || chr(10)
      || '{PATCH_INSTRUCTION}') AS style_3_md5,
  md5({_HEAD} || {_MID} || {_CODE} || 'Rewrite the complete files that need changes.') AS full_file_gen_md5,
  md5(array_to_string({_IDS.format(_STRIP.format("text") + " || chr(10)")}, ',')) AS input_md5,
  md5(array_to_string(list_append({_IDS.format(_STRIP.format("split_part(text, chr(10), 1)"))}, 2), ',')) AS labels_md5,
  'be brief' AS system, md5(text) AS user_md5, CASE WHEN turn % 2 = 0 THEN CAST(conv_id AS BIGINT) END AS issue,
  md5(chr(27) || '-' || text) AS plain_md5, md5(regexp_replace(text, '(^|\n)[ \t]+(\n|$)', '\1\2', 'g') || chr(10) || chr(10) || 'z' || chr(10)) AS lines_md5, 'a.py' AS files
FROM c"""

VIEW_ORACLES["order_views"] = """
WITH o AS (SELECT o_orderkey AS id, o_orderpriority AS p, o_orderdate AS d FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS k, count(*) OVER () AS n,
             row_number() OVER (PARTITION BY p ORDER BY d DESC, id DESC) AS newest,
             max(CASE WHEN d < TIMESTAMP '2000-06-15' THEN epoch_us(d) END) OVER (PARTITION BY p) AS last_old FROM o),
b AS (SELECT p, max(id) AS bid FROM r WHERE epoch_us(d) = last_old GROUP BY p)
SELECT 'shard' AS kind, id AS instance_id FROM r WHERE
  CASE WHEN k < (n // 4 + 1) * (n % 4) THEN k // (n // 4 + 1) ELSE n % 4 + (k - (n // 4 + 1) * (n % 4)) // greatest(n // 4, 1) END = 1
UNION ALL (SELECT 'sample', id FROM o ORDER BY md5(CAST(id AS VARCHAR) || '|7'), id LIMIT 25)
UNION ALL SELECT 'from_id', id FROM r WHERE k BETWEEN (SELECT k FROM r WHERE id = 700) AND (SELECT k FROM r WHERE id = 700) + 39
UNION ALL SELECT 'cutoff', id FROM r LEFT JOIN b USING (p)
  WHERE last_old IS NULL OR epoch_us(d) > last_old OR epoch_us(d) = last_old AND id >= bid
UNION ALL SELECT 'newest', id FROM r WHERE newest <= 4
UNION ALL SELECT 'union', id FROM o WHERE id % 3 = 0 OR id % 5 = 0"""

VIEW_ORACLES["context_fit"] = """
SELECT doc_id, lang FROM documents JOIN (VALUES ('en', 400), ('de', 300), ('fr', 200)) AS v(lang, m) USING (lang) WHERE length(text) <= m"""

VIEW_ORACLES["file_views"] = """
SELECT 'version' AS kind, p_partkey AS instance_id, p_size || CASE WHEN p_partkey % 3 <> 0 THEN '.2' ELSE '.7' END AS value FROM part
UNION ALL SELECT 'test', p_partkey, 't.py|' || p_name || '|FAIL_TO_PASS' FROM part
UNION ALL SELECT 'test', p_partkey, 'a/b.py|Case.test_' || p_partkey || '|PASS_TO_PASS' FROM part
UNION ALL SELECT 'readme', p_partkey, md5('README.md' || chr(10) || p_name) FROM part
UNION ALL SELECT 'file', p_partkey, f FROM part, (VALUES ('pkg/__init__.py'), ('setup.py'), ('README.md'), ('docs/README.md')) AS v(f)"""

VIEW_ORACLES["release_dates"] = """
SELECT DISTINCT o_custkey AS repo, (o_orderkey % 5) || '.' || (o_orderkey % 7) AS version, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE o_orderkey % 3 <> 2"""

VIEW_ORACLES["early_hints"] = """
SELECT l_orderkey AS pull_number, 'note ' || l_partkey AS text, l_linenumber = 7 AS time_error
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 7 OR l_partkey % 60 < 30"""

_RUN = """
WITH b AS (SELECT d.doc_id AS instance_id, CASE WHEN l.doc_id IS NULL THEN 'incomplete' WHEN l.quality <> 1 THEN 'empty_patch'
             WHEN d.lang NOT IN ('en', 'fr') THEN 'error' WHEN l.toxic = 0 THEN 'resolved' ELSE 'unresolved' END AS bucket
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

VIEW_ORACLES["run_report_totals"] = _RUN + """
SELECT count(*) AS total_instances, count(*) FILTER (WHERE bucket IN ('resolved', 'unresolved')) AS completed_instances,
  count(*) FILTER (WHERE bucket = 'resolved') AS resolved_instances, count(*) FILTER (WHERE bucket = 'unresolved') AS unresolved_instances,
  count(*) FILTER (WHERE bucket = 'empty_patch') AS empty_patch_instances, count(*) FILTER (WHERE bucket = 'error') AS error_instances,
  count(*) FILTER (WHERE bucket = 'incomplete') AS incomplete_instances, (SELECT count(DISTINCT doc_id) FROM labels) AS submitted_instances,
  2 AS schema_version FROM b"""

VIEW_ORACLES["run_report_ids"] = _RUN + """
SELECT 'completed_ids' AS list, instance_id FROM b WHERE bucket IN ('resolved', 'unresolved')
UNION ALL SELECT bucket || '_ids', instance_id FROM b
UNION ALL SELECT DISTINCT 'submitted_ids', doc_id FROM labels"""

VIEW_ORACLES["collection_totals"] = """
SELECT count(*) AS total_pulls, count(*) FILTER (WHERE o_orderstatus <> 'P') AS completed,
  count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0) AS with_tests,
  count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 7 = 0) AS skipped FROM orders"""

VIEW_ORACLES["import_reach"] = """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, 'm' || k || '/f.py' AS file
FROM part, unnest(range(CASE WHEN p_partkey % 40 = 0 THEN p_size * 8 ELSE p_size % 6 END + 1)) AS r(k)"""
