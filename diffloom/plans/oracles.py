"""DuckDB oracle SQL per registered query, computed from the structured rows directly."""

_EV = """
ev AS (
  SELECT 'run-' || CAST(event_id // 8192 AS VARCHAR) AS run_id,
         'inst-' || CAST(user_id AS VARCHAR) AS instance_id, user_id, ts, event_id, value, event_type,
         'tests/test_' || event_type || '.py::test_' || event_type AS test,
         CASE WHEN value < 40 THEN 'PASSED' WHEN value < 80 THEN 'FAILED' WHEN value < 100 THEN 'ERROR'
              WHEN value < 130 THEN 'XFAIL' ELSE 'SKIPPED' END AS status
  FROM events),
runs AS (
  SELECT run_id, instance_id, (max(value) < 300 AND arg_min(value, (ts, event_id)) >= 1.0) AS applied
  FROM ev GROUP BY run_id, instance_id),
st AS (SELECT run_id, instance_id, test, arg_max(status, (ts, event_id)) AS status FROM ev GROUP BY 1, 2, 3),
gold AS (
  SELECT DISTINCT 'inst-' || CAST(user_id AS VARCHAR) AS instance_id,
         CASE WHEN event_type IN ('error', 'signup') THEN 'FAIL_TO_PASS' ELSE 'PASS_TO_PASS' END AS category,
         'tests/test_' || event_type || '.py::test_' || event_type AS test
  FROM events)"""


def _grade_sql(mode_expr: str) -> str:
    return f"""
WITH {_EV},
g AS (
  SELECT r.run_id, r.instance_id, gold.category,
         CASE WHEN {mode_expr} = 'fail_only' THEN
                CASE WHEN st.status = 'FAILED' THEN 'failure' ELSE 'success' END
              WHEN st.status IN ('PASSED', 'XFAIL') THEN 'success'
              WHEN st.status IS NULL OR st.status IN ('FAILED', 'ERROR') THEN 'failure' END AS outcome
  FROM runs r JOIN gold ON r.instance_id = gold.instance_id
  LEFT JOIN st ON st.run_id = r.run_id AND st.instance_id = r.instance_id AND st.test = gold.test
  WHERE r.applied),
c AS (
  SELECT run_id, instance_id,
         count(*) FILTER (WHERE category = 'FAIL_TO_PASS' AND outcome = 'success') AS f2p_success,
         count(*) FILTER (WHERE category = 'FAIL_TO_PASS' AND outcome = 'failure') AS f2p_failure,
         count(*) FILTER (WHERE category = 'PASS_TO_PASS' AND outcome = 'success') AS p2p_success,
         count(*) FILTER (WHERE category = 'PASS_TO_PASS' AND outcome = 'failure') AS p2p_failure
  FROM g GROUP BY 1, 2),
x AS (
  SELECT r.run_id, r.instance_id, r.applied,
         CASE WHEN r.applied THEN coalesce(c.f2p_success, 0) END AS f2p_success,
         CASE WHEN r.applied THEN coalesce(c.f2p_failure, 0) END AS f2p_failure,
         CASE WHEN r.applied THEN coalesce(c.p2p_success, 0) END AS p2p_success,
         CASE WHEN r.applied THEN coalesce(c.p2p_failure, 0) END AS p2p_failure
  FROM runs r LEFT JOIN c ON c.run_id = r.run_id AND c.instance_id = r.instance_id)
SELECT run_id, instance_id, applied, f2p_success, f2p_failure, p2p_success, p2p_failure,
       round(CASE WHEN f2p_success + f2p_failure = 0 THEN 1.0
                  ELSE CAST(f2p_success AS DOUBLE) / (f2p_success + f2p_failure) END, 6) AS f2p_rate,
       round(CASE WHEN p2p_success + p2p_failure = 0 THEN 1.0
                  ELSE CAST(p2p_success AS DOUBLE) / (p2p_success + p2p_failure) END, 6) AS p2p_rate,
       CASE WHEN NOT applied THEN 'RESOLVED_NO'
            WHEN f2p_failure = 0 AND p2p_failure = 0 THEN 'RESOLVED_FULL'
            WHEN f2p_success > 0 AND f2p_failure > 0 AND p2p_failure = 0 THEN 'RESOLVED_PARTIAL'
            ELSE 'RESOLVED_NO' END AS resolution
FROM x"""


ORACLES: dict[str, str] = {
    "grade_runs": _grade_sql("'pass_and_fail'"),
    "regrade_modes": _grade_sql("CASE WHEN CAST(substr(r.instance_id, 6) AS BIGINT) % 2 = 1 "
                                "THEN 'fail_only' ELSE 'pass_and_fail' END"),
}

_PATCH = """
li AS (
  SELECT l_orderkey AS order_key, l_linenumber, l_suppkey % 4 AS file_id,
         CAST(floor(l_quantity) AS INTEGER) AS q, l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem),
h AS (
  SELECT *, CASE rf WHEN 'R' THEN 1 + q % 3 WHEN 'N' THEN 1 ELSE 0 END AS n_rem,
            CASE rf WHEN 'A' THEN 1 + q % 3 WHEN 'N' THEN 1 + q % 2 ELSE 0 END AS n_add
  FROM li),
f AS (
  SELECT order_key, file_id, count(*) AS n_hunks, sum(n_add) AS added, sum(n_rem) AS removed,
         arg_min(rf || ls, (l_linenumber, rf, ls)) = 'AO' AS is_added,
         arg_min(rf || ls, (l_linenumber, rf, ls)) = 'RF' AS is_removed
  FROM h GROUP BY 1, 2),
o AS (
  SELECT order_key, count(*) AS n_files,
         count(*) FILTER (WHERE is_added) AS n_added_files,
         count(*) FILTER (WHERE is_removed) AS n_removed_files,
         count(*) FILTER (WHERE NOT is_added AND NOT is_removed) AS n_modified_files,
         sum(n_hunks) AS n_hunks,
         coalesce(sum(n_hunks) FILTER (WHERE NOT is_added AND NOT is_removed), 0) AS n_modified_hunks,
         sum(added) AS added, sum(removed) AS removed
  FROM f GROUP BY 1)"""

ORACLES["patch_stats"] = f"""
WITH {_PATCH}
SELECT order_key, n_files, n_added_files, n_removed_files, n_modified_files,
       CAST(n_hunks AS BIGINT) AS n_hunks, CAST(added AS BIGINT) AS added,
       CAST(removed AS BIGINT) AS removed, true AS parseable,
       n_files > n_added_files AND n_files > n_removed_files AND n_hunks > 0 AS valid_format
FROM o"""

ORACLES["patch_gates"] = f"""
WITH {_PATCH}
SELECT order_key, n_added_files + n_removed_files > 0 AS adds_or_removes,
       added + removed <= 25 AS le_25_lines, n_modified_files <= 1 AS le_1_file,
       n_modified_hunks > 0 AND n_modified_hunks <= 3 AS hunks_1_to_3,
       n_added_files + n_removed_files = 0 AND n_modified_files <= 1
         AND n_modified_hunks > 0 AND n_modified_hunks <= 3 AS passes
FROM o"""

ORACLES["split_patches"] = f"""
WITH {_PATCH}
SELECT order_key,
       count(*) FILTER (WHERE file_id % 2 = 1) AS code_files,
       CAST(coalesce(sum(added) FILTER (WHERE file_id % 2 = 1), 0) AS BIGINT) AS code_added,
       CAST(coalesce(sum(removed) FILTER (WHERE file_id % 2 = 1), 0) AS BIGINT) AS code_removed,
       count(*) FILTER (WHERE file_id % 2 = 0) AS test_files,
       CAST(coalesce(sum(added) FILTER (WHERE file_id % 2 = 0), 0) AS BIGINT) AS test_added,
       CAST(coalesce(sum(removed) FILTER (WHERE file_id % 2 = 0), 0) AS BIGINT) AS test_removed,
       count(*) FILTER (WHERE NOT is_added) AS n_modified_paths,
       coalesce('pkg/mod_' || CAST(min(file_id) FILTER (WHERE file_id % 2 = 1) AS VARCHAR) || '.py',
                'tests/test_mod_' || CAST(min(file_id) FILTER (WHERE file_id % 2 = 0) AS VARCHAR) || '.py') AS target_file
FROM f GROUP BY order_key"""

_W = r"[\pL\pN_]"
ORACLES["statement_funnel"] = rf"""
WITH d AS (
  SELECT lang, text,
         len(regexp_extract_all(text, '\S+')) > 40 AS g1,
         regexp_matches(text, 'https?://(www\.)?\S+') AS has_link,
         regexp_matches(text, '(?i)(^|[^\pL\pN_])(close|closes|closed|fix|fixes|fixed|resolve|resolves|resolved)\s+#\d')
           OR regexp_matches(text, 'https?://gitlab.com/(.*)/issues') AS has_ref,
         regexp_matches(text, '(^|[^/\pL\pN_])[0-9a-f]{{40}}($|[^\pL\pN_])') OR regexp_matches(text, '\[[0-9a-f]{{23}}\]') AS has_hash,
         regexp_matches(text, '(?i){_W}\.(png|jpg|jpeg|gif|bmp|tiff|svg|webp|ico|heif|bpg|avif|mp4|avi|mkv|mov|wmv|flv|webm|mpeg)($|[^\pL\pN_])') AS has_media
  FROM documents)
SELECT lang, count(*) AS n_total, count(*) FILTER (WHERE g1) AS n_words_ok,
       count(*) FILTER (WHERE g1 AND NOT has_link) AS n_no_links,
       count(*) FILTER (WHERE g1 AND NOT has_link AND NOT has_ref) AS n_no_refs,
       count(*) FILTER (WHERE g1 AND NOT has_link AND NOT has_ref AND NOT has_hash) AS n_no_hash,
       count(*) FILTER (WHERE g1 AND NOT has_link AND NOT has_ref AND NOT has_hash AND NOT has_media) AS n_kept,
       count(*) FILTER (WHERE has_hash) AS n_with_hash
FROM d GROUP BY lang"""

ORACLES["resolved_refs"] = """
WITH li AS (
  SELECT l_orderkey AS order_key, l_linenumber, l_partkey, l_suppkey, l_linestatus,
         CASE l_returnflag WHEN 'R' THEN 'fixes' WHEN 'A' THEN 'Closes' ELSE 'refs' END AS word
  FROM lineitem),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, word) AS p
  FROM li WHERE l_linestatus = 'O'),
per_word AS (
  SELECT order_key, word, min(p) AS first_p, arg_max(l_partkey, p) AS num
  FROM pos WHERE word IN ('fixes', 'Closes') GROUP BY 1, 2),
agg AS (
  SELECT order_key, count(*) AS n_resolved, string_agg(CAST(num AS VARCHAR), ',' ORDER BY first_p) AS resolved
  FROM per_word GROUP BY 1)
SELECT o.o_orderkey AS order_key, coalesce(agg.n_resolved, 0) AS n_resolved, coalesce(agg.resolved, '') AS resolved
FROM orders o LEFT JOIN agg ON agg.order_key = o.o_orderkey"""

ORACLES["hints_prefix"] = """
WITH c AS (SELECT * FROM conversations),
fc AS (SELECT conv_id, min(turn) AS first_commit_at FROM c WHERE role = 'assistant' GROUP BY 1),
x AS (
  SELECT c.conv_id, c.turn, c.text,
         min(CASE WHEN length(c.text) <= 300 AND c.turn < fc.first_commit_at THEN 1 ELSE 0 END)
           OVER (PARTITION BY c.conv_id ORDER BY c.turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok
  FROM c JOIN fc ON c.conv_id = fc.conv_id)
SELECT conv_id, count(*) AS n_hints, md5(string_agg(text, chr(10) ORDER BY turn)) AS hints_md5,
       CAST(length(string_agg(text, chr(10) ORDER BY turn)) AS BIGINT) AS hints_chars
FROM x WHERE ok = 1 GROUP BY conv_id"""

ORACLES["repetition_filter"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(list_distinct(w[greatest(len(w) - 99, 1):])) AS BIGINT) AS n_distinct_tail,
       len(w) >= 100 AND len(list_distinct(w[greatest(len(w) - 99, 1):])) <= 10 AS repetitive
FROM d"""

ORACLES["release_pages"] = r"""
WITH p AS (
  SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
         regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
         regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links
  FROM pages),
pg AS (SELECT host, lang, count(*) AS n_pages FROM p GROUP BY 1, 2),
lk AS (SELECT host, lang, count(DISTINCT href) AS n_distinct_links
       FROM (SELECT host, lang, unnest(links) AS href FROM p) GROUP BY 1, 2)
SELECT pg.host, pg.lang, pg.n_pages, coalesce(lk.n_distinct_links, 0) AS n_distinct_links
FROM pg LEFT JOIN lk ON pg.host = lk.host AND pg.lang = lk.lang"""

ORACLES["runnable"] = """
SELECT d.doc_id AS instance_id, d.lang, l.toxic
FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1"""

ORACLES["completed_anti"] = """
SELECT doc_id AS instance_id, 'pending' AS kind FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT DISTINCT doc_id AS instance_id, 'unknown' AS kind FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)"""

ORACLES["decontam_exact"] = """
WITH ev AS (SELECT d.text FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels))
SELECT d.doc_id AS instance_id FROM documents d
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels) AND d.text NOT IN (SELECT text FROM ev)"""

ORACLES["decontam_group"] = """
WITH ev AS (SELECT DISTINCT d.source FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1)
SELECT d.doc_id AS instance_id, d.source FROM documents d
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels) AND d.source NOT IN (SELECT source FROM ev)"""

ORACLES["sample_groups"] = """
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id) AS rn
  FROM documents) WHERE rn <= 10"""

ORACLES["split_orders"] = """
SELECT o_orderkey, CAST(ntile(4) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS part FROM orders"""

ORACLES["budget_stop"] = r"""
WITH c AS (
  SELECT conv_id, turn, length(text) AS n_chars,
         len(regexp_extract_all(text, '\S+')) * CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 3 WHEN 'assistant' THEN 15 END AS cost
  FROM conversations),
w AS (
  SELECT *, coalesce(sum(cost) OVER (PARTITION BY conv_id ORDER BY n_chars, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cost_before,
         row_number() OVER (PARTITION BY conv_id ORDER BY n_chars, turn) AS rn
  FROM c)
SELECT conv_id, turn, CAST(cost AS BIGINT) AS cost, CAST(cost_before AS BIGINT) AS cost_before
FROM w WHERE cost_before < 3000 OR rn = 1"""

ORACLES["latest_orders"] = """
WITH b AS (
  SELECT o_orderstatus, o_orderpriority, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey
  FROM orders GROUP BY 1, 2)
SELECT b.o_orderstatus, b.o_orderpriority, b.o_orderkey, o.o_custkey, c.c_name
FROM b JOIN orders o ON o.o_orderkey = b.o_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""

ORACLES["run_report_buckets"] = """
WITH b AS (
  SELECT d.doc_id,
         CASE WHEN l.doc_id IS NULL THEN 'incomplete'
              WHEN l.quality <> 1 THEN 'empty_patch'
              WHEN d.lang IN ('en', 'fr') THEN CASE WHEN l.toxic = 0 THEN 'resolved' ELSE 'unresolved' END
              ELSE 'error' END AS bucket
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT bucket, count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id, CAST(sum(doc_id) AS BIGINT) AS sum_id
FROM b GROUP BY bucket"""

ORACLES["fingerprints"] = """
SELECT substr(sha256('{"brand":"' || p_brand || '","size":' || CAST(p_size AS VARCHAR) || ',"type":"' || p_type || '"}'), 1, 22) AS env_key,
       count(*) AS n_parts, min(p_partkey) AS first_partkey
FROM part GROUP BY 1"""

ORACLES["resume_union"] = """
SELECT doc_id AS instance_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 2 END AS run
FROM documents"""

_REL = """
o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority AS repo, o_orderdate FROM orders),
rel AS (SELECT repo, o_orderdate AS date,
               CAST(year(o_orderdate) - 1990 AS VARCHAR) || '.' || CAST(month(o_orderdate) AS VARCHAR) AS version
        FROM o WHERE o_orderstatus = 'F'),
inst AS (SELECT o_orderkey AS instance_id, repo, o_orderdate AS created_at FROM o WHERE o_orderstatus <> 'F')"""

ORACLES["asof_release"] = f"""
WITH {_REL},
r AS (SELECT repo, date, max(version) AS version FROM rel GROUP BY 1, 2)
SELECT i.instance_id, i.repo, r.version
FROM inst i ASOF LEFT JOIN r ON i.repo = r.repo AND i.created_at > r.date"""

ORACLES["asof_version_order"] = f"""
WITH {_REL},
cut AS (SELECT repo, version, max(date) AS cutoff FROM rel GROUP BY 1, 2)
SELECT i.instance_id, i.repo,
       coalesce(max(c.version) FILTER (WHERE c.cutoff < i.created_at), min(c.version)) AS version
FROM inst i LEFT JOIN cut c ON c.repo = i.repo
GROUP BY i.instance_id, i.repo"""

_BM25 = r"""
dt AS (SELECT lang AS corpus_id, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS toks FROM documents),
dlen AS (SELECT corpus_id, doc_id, len(toks) AS dl FROM dt),
post AS (SELECT corpus_id, term, doc_id, count(*) AS tf
         FROM (SELECT corpus_id, doc_id, unnest(toks) AS term FROM dt) GROUP BY ALL),
dfq AS (SELECT corpus_id, term, count(*) AS df FROM post GROUP BY ALL),
st AS (SELECT corpus_id, count(*) AS n_docs, avg(dl) AS avgdl FROM dlen GROUP BY 1),
q AS (SELECT item_id, term, count(*) AS qtf
      FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM benchmark) GROUP BY ALL),
sc AS (
  SELECT q.item_id AS query_id, p.corpus_id, p.doc_id,
         round(sum(q.qtf * ln(1 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * p.tf * (0.9 + 1)
                   / (p.tf + 0.9 * (1 - 0.4 + 0.4 * l.dl / s.avgdl))), 6) AS score
  FROM q JOIN dfq d ON d.term = q.term JOIN st s ON s.corpus_id = d.corpus_id
  JOIN post p ON p.corpus_id = d.corpus_id AND p.term = q.term
  JOIN dlen l ON l.corpus_id = p.corpus_id AND l.doc_id = p.doc_id
  GROUP BY 1, 2, 3),
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, corpus_id ORDER BY score DESC, doc_id) AS rank FROM sc)
  WHERE rank <= 20)"""

ORACLES["bm25_top20"] = f"""
WITH {_BM25}
SELECT query_id, corpus_id, rank, doc_id, score FROM hits"""

ORACLES["recall"] = f"""
WITH {_BM25},
gold AS (SELECT DISTINCT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON length(b.text) > 0 AND instr(d.text, b.text) > 0),
ret AS (SELECT DISTINCT query_id AS item_id, doc_id FROM hits),
ng AS (SELECT item_id, count(*) AS n_gold FROM gold GROUP BY 1),
nr AS (SELECT item_id, count(*) AS n_retrieved FROM ret GROUP BY 1),
nh AS (SELECT g.item_id, count(*) AS n_hit FROM gold g JOIN ret r ON r.item_id = g.item_id AND r.doc_id = g.doc_id GROUP BY 1)
SELECT ng.item_id, ng.n_gold, nr.n_retrieved, coalesce(nh.n_hit, 0) AS n_hit,
       round(CAST(coalesce(nh.n_hit, 0) AS DOUBLE) / ng.n_gold, 6) AS recall
FROM ng JOIN nr ON nr.item_id = ng.item_id LEFT JOIN nh ON nh.item_id = ng.item_id"""

ORACLES["recall_means"] = f"""
SELECT round(avg(CAST(n_hit AS DOUBLE) / n_gold) * 100, 2) AS avg_recall, round(avg(CAST(n_hit > 0 AS DOUBLE)) * 100, 2) AS any_recall,
       round(avg(CAST(n_hit = n_gold AS DOUBLE)) * 100, 2) AS full_recall, count(*) AS n_instances
FROM ({ORACLES["recall"]}) AS r"""

_PACK = r"""
h2 AS (SELECT h.query_id, h.corpus_id, h.rank, h.doc_id, len(regexp_extract_all(d.text, '\S+')) AS tokens
       FROM hits h JOIN documents d ON d.doc_id = h.doc_id),
base AS (SELECT item_id AS query_id, len(regexp_extract_all(text, '\S+')) AS base FROM benchmark),
pk(query_id, corpus_id, rank, used, taken, n) AS (
  SELECT DISTINCT h2.query_id, h2.corpus_id, 0, CAST(base.base AS BIGINT), '', 0
  FROM h2 JOIN base ON base.query_id = h2.query_id
  UNION ALL
  SELECT pk.query_id, pk.corpus_id, pk.rank + 1,
         CASE WHEN pk.used + h2.tokens < 6000 THEN pk.used + h2.tokens ELSE pk.used END,
         CASE WHEN pk.used + h2.tokens < 6000
              THEN CASE WHEN pk.taken = '' THEN '' ELSE pk.taken || ',' END || CAST(h2.doc_id AS VARCHAR)
              ELSE pk.taken END,
         pk.n + CASE WHEN pk.used + h2.tokens < 6000 THEN 1 ELSE 0 END
  FROM pk JOIN h2 ON h2.query_id = pk.query_id AND h2.corpus_id = pk.corpus_id AND h2.rank = pk.rank + 1),
fin AS (SELECT * FROM pk WHERE (query_id, corpus_id, rank) IN (SELECT (query_id, corpus_id, max(rank)) FROM h2 GROUP BY query_id, corpus_id))"""

ORACLES["pack_context"] = f"""
WITH RECURSIVE {_BM25}, {_PACK}
SELECT query_id, corpus_id, CAST(n AS BIGINT) AS n_taken, used, taken FROM fin"""

ORACLES["code_text"] = f"""
WITH RECURSIVE {_BM25}, {_PACK},
taken AS (SELECT fin.query_id, fin.corpus_id, CAST(unnest(string_split(fin.taken, ',')) AS BIGINT) AS doc_id FROM fin WHERE fin.taken <> ''),
f AS (SELECT t.query_id, t.corpus_id, 'doc_' || CAST(t.doc_id AS VARCHAR) || '.txt' AS path, d.text AS content
      FROM taken t JOIN documents d ON d.doc_id = t.doc_id),
code AS (
  SELECT query_id, corpus_id, count(*) AS n_files,
         regexp_replace(string_agg('[start of ' || path || ']' || chr(10) || content || chr(10) || '[end of ' || path || ']', chr(10) ORDER BY path),
                        '^\\n+|\\n+$', '', 'g') AS code
  FROM f GROUP BY 1, 2),
pr AS (
  SELECT c.query_id, c.corpus_id, c.n_files,
         concat_ws(chr(10), 'Below are an issue report and the source files it concerns.',
                   '<issue>', b.text, '</issue>', '<code>', '', c.code, '</code>',
                   'Produce a patch file that resolves the issue, in unified diff format.') AS prompt
  FROM code c JOIN benchmark b ON b.item_id = c.query_id),
tx AS (SELECT query_id, corpus_id, n_files, regexp_replace(prompt, '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) AS text FROM pr)
SELECT query_id, corpus_id, n_files, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS text_chars FROM tx"""

_IDS = r"list_transform(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'), lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT))"

ORACLES["train_tokens"] = rf"""
WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM conversations),
p AS (SELECT u.conv_id, u.turn, {_IDS.format("u.text || chr(10)")} AS ids, CASE WHEN a.text IS NOT NULL THEN list_append({_IDS.format("a.text")}, 2) END AS lab
      FROM c u LEFT JOIN c a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
      WHERE u.role = 'user'),
x AS (SELECT conv_id, turn,
             CASE WHEN lab IS NULL OR len(ids) = 0 THEN [] ELSE list_concat(ids, lab[1:len(lab) - 1]) END AS inputs,
             CASE WHEN lab IS NULL OR len(ids) = 0 THEN []
                  ELSE list_concat(list_transform(range(len(ids) - 1), lambda i: -100::BIGINT), lab) END AS labels
      FROM p)
SELECT conv_id, turn, CAST(len(inputs) AS BIGINT) AS n_input_ids, md5(coalesce(array_to_string(inputs, ','), '')) AS input_md5,
       md5(coalesce(array_to_string(labels, ','), '')) AS labels_md5
FROM x"""

_RES = """
u AS (SELECT DISTINCT user_id, 'proj' || CAST(user_id % 5 AS VARCHAR) || '__app-' || CAST(user_id AS VARCHAR) AS instance_id FROM events),
r AS (SELECT user_id, CASE WHEN event_type IN ('error', 'signup') THEN 'FAIL_TO_PASS' ELSE 'PASS_TO_PASS' END AS test_type,
             CASE WHEN value < 60 THEN 0 WHEN value < 200 THEN 1 ELSE 4 END AS exit_code
      FROM events WHERE user_id % 7 <> 3),
per AS (
  SELECT u.instance_id, split_part(u.instance_id, '-', 1) AS repo_key,
         count(r.exit_code) AS total_tests,
         count(*) FILTER (WHERE r.exit_code = 0) AS passed_tests,
         count(*) FILTER (WHERE r.test_type = 'FAIL_TO_PASS' AND r.exit_code = 0) AS fail_to_pass,
         count(*) FILTER (WHERE r.test_type = 'PASS_TO_PASS' AND r.exit_code = 0) AS pass_to_pass,
         coalesce(bool_or(r.exit_code NOT IN (0, 1)), false) AS has_warning,
         count(*) FILTER (WHERE r.exit_code = 1) AS n_exit_1,
         count(*) FILTER (WHERE r.exit_code NOT IN (0, 1)) AS n_exit_other
  FROM u LEFT JOIN r ON r.user_id = u.user_id GROUP BY 1, 2),
per2 AS (SELECT *, passed_tests = total_tests AS passed_compat, passed_tests = total_tests AND total_tests > 0 AS passed_strict FROM per)"""

ORACLES["suite_results"] = f"""
WITH {_RES}
SELECT * FROM per2"""

ORACLES["suite_summary"] = f"""
WITH {_RES}
SELECT repo_key, count(*) AS instances, count(*) FILTER (WHERE passed_compat) AS passed_compat,
       count(*) FILTER (WHERE passed_strict) AS passed_strict, count(*) FILTER (WHERE has_warning) AS warnings,
       CAST(sum(fail_to_pass) AS BIGINT) AS fail_to_pass, CAST(sum(pass_to_pass) AS BIGINT) AS pass_to_pass,
       CAST(sum(total_tests) AS BIGINT) AS tests
FROM per2 GROUP BY GROUPING SETS ((repo_key), ())"""

_FRESH = f"""
WITH {_EV},
fs AS (SELECT CAST(least(floor((day(ts) - 1) / 8), 3) AS INTEGER) AS config, instance_id, test,
              arg_max(status, (ts, event_id)) AS status
       FROM ev GROUP BY 1, 2, 3),
tg AS (SELECT fs.*, status = 'PASSED' AS passed, g.category AS old
       FROM fs LEFT JOIN gold g ON g.instance_id = fs.instance_id AND g.test = fs.test),
per AS (
  SELECT config, instance_id, count(*) FILTER (WHERE passed AND old = 'FAIL_TO_PASS') AS new_f2p,
         count(*) FILTER (WHERE passed AND old IS DISTINCT FROM 'FAIL_TO_PASS') AS new_p2p,
         count(*) FILTER (WHERE passed AND old = 'PASS_TO_PASS') AS p2p_kept
  FROM tg GROUP BY 1, 2),
pairs AS (SELECT DISTINCT 'inst-' || CAST(user_id AS VARCHAR) AS instance_id, CAST(c AS INTEGER) AS config
          FROM events, unnest(range(4)) AS r(c)),
sizes AS (SELECT instance_id, count(*) FILTER (WHERE category = 'FAIL_TO_PASS') AS old_f2p,
                 count(*) FILTER (WHERE category = 'PASS_TO_PASS') AS old_p2p FROM gold GROUP BY 1),
rf AS (
  SELECT config, instance_id, coalesce(new_f2p, 0) AS new_f2p, coalesce(new_p2p, 0) AS new_p2p, coalesce(old_f2p, 0) AS old_f2p,
         coalesce(old_p2p, 0) AS old_p2p, new_f2p IS NULL AS no_log, coalesce(new_f2p, 0) > 0 AS reproduced,
         new_f2p IS NOT NULL AND new_f2p = 0 AS not_reproduced,
         coalesce(new_f2p, 0) <> coalesce(old_f2p, 0) AS f2p_changed,
         coalesce(new_p2p, 0) <> coalesce(old_p2p, 0) OR coalesce(p2p_kept, 0) <> coalesce(old_p2p, 0) AS p2p_changed
  FROM pairs LEFT JOIN per USING (config, instance_id) LEFT JOIN sizes USING (instance_id))"""

ORACLES["refresh_gold"] = _FRESH + """
SELECT * FROM rf"""

ORACLES["refresh_lists"] = _FRESH + """
SELECT config, instance_id, CASE WHEN old = 'FAIL_TO_PASS' THEN old ELSE 'PASS_TO_PASS' END AS category, test FROM tg WHERE passed"""

ORACLES["refresh_ids"] = _FRESH + """
SELECT config, 'no_log' AS list, instance_id FROM rf WHERE no_log
UNION ALL SELECT config, 'not_reproduced', instance_id FROM rf WHERE not_reproduced
UNION ALL SELECT config, 'f2p_changed', instance_id FROM rf WHERE f2p_changed AND NOT no_log
UNION ALL SELECT config, 'p2p_changed', instance_id FROM rf WHERE p2p_changed AND NOT no_log"""

ORACLES["best_config"] = _FRESH + """,
cnt AS (SELECT CAST(CAST(substr(instance_id, 6) AS BIGINT) % 3 AS INTEGER) AS grp, config, count(*) AS n_reproduced
        FROM rf WHERE reproduced GROUP BY 1, 2)
SELECT grp, arg_max(config, (n_reproduced, -config)) AS config, max(n_reproduced) AS n_reproduced FROM cnt GROUP BY grp"""

ORACLES["problem_statements"] = """
WITH li AS (
  SELECT l_orderkey AS order_key, l_linenumber, l_partkey, l_suppkey, l_linestatus,
         CASE l_returnflag WHEN 'R' THEN 'fixes' WHEN 'A' THEN 'Closes' ELSE 'refs' END AS word
  FROM lineitem),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus, word) AS p
  FROM li WHERE l_linestatus = 'O'),
per_word AS (
  SELECT order_key, word, min(p) AS first_p, arg_max(l_partkey, p) AS num
  FROM pos WHERE word IN ('fixes', 'Closes') GROUP BY 1, 2),
st AS (
  SELECT w.order_key, string_agg(coalesce(pt.p_name, '') || chr(10) || coalesce(pt.p_type, '') || chr(10), '' ORDER BY w.first_p) AS s
  FROM per_word w JOIN part pt ON pt.p_partkey = w.num GROUP BY 1),
o AS (SELECT o_orderkey AS order_key FROM orders)
SELECT o.order_key, md5(coalesce(st.s, '')) AS statement_md5, CAST(length(coalesce(st.s, '')) AS BIGINT) AS statement_chars
FROM o LEFT JOIN st ON st.order_key = o.order_key"""

ORACLES["instance_reports"] = f"""
WITH gr AS ({_grade_sql("'pass_and_fail'")}), u AS (SELECT *, CAST(substr(instance_id, 6) AS BIGINT) % 4 AS m FROM gr)
SELECT run_id, instance_id, m = 0 AS "patch_is_None", m <> 0 AS patch_exists, m <> 0 AND applied AS patch_successfully_applied,
       m <> 0 AND resolution = 'RESOLVED_FULL' AS resolved FROM u"""

ORACLES["streamed_grades"] = ORACLES["grade_runs"]
ORACLES["regraded"] = _grade_sql("CASE WHEN CAST(substr(r.run_id, 5) AS BIGINT) % 2 = 0 THEN 'fail_only' ELSE 'pass_and_fail' END")

ORACLES["collected_pulls"] = """
SELECT 'own__rep-' || o_orderkey AS instance_id, CAST(o_orderkey AS BIGINT) AS pull_number, md5(CAST(o_orderkey AS VARCHAR)) AS base_commit,
       CAST(o_orderkey AS VARCHAR) AS issues, md5('Order ' || o_orderkey || chr(10) || 'fixes #' || o_orderkey) AS statement_md5,
       bool_or(l_suppkey % 2 = 0) AS in_tests
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderkey % 4 <> 0
GROUP BY o_orderkey HAVING bool_or(l_suppkey % 2 = 1)"""
