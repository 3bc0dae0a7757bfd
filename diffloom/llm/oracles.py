"""DuckDB SQL for the queries that SQL can express."""

from diffloom.llm import mixing as M
from diffloom.llm.warc import MIN_REVISIT


def _weight(column: str, table) -> str:
    named = " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in table.items() if k != M.OTHER)
    return f"CASE {named} ELSE {table.get(M.OTHER, 1)} END" if named else str(table.get(M.OTHER, 1))


def _level(depth: int) -> str:
    """The budgets of the nodes of one level from those of the level above (``b{depth}``)."""
    path = ", ".join(M.LEVELS[:depth + 1])
    above = ", ".join(M.LEVELS[:depth])
    part = f"PARTITION BY {above}" if above else ""
    join = f"USING ({above})" if above else "ON TRUE"
    level = M.LEVELS[depth]
    return f"""
n{depth} AS (SELECT {path}, sum(have * {M.MAX_EPOCHS})::HUGEINT AS cap, {_weight(level, M.WEIGHTS[level])} AS w
             FROM leaves GROUP BY {path}),
s{depth} AS (SELECT n.*, b.budget AS above,
               b.budget - coalesce(sum(cap) OVER ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
               sum(w) OVER ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
             FROM n{depth} n JOIN b{depth} b {join} WHERE w > 0),
f{depth} AS (SELECT *, cap * open <= room * w AS is_full FROM s{depth}),
b{depth + 1} AS (SELECT {path}, CASE WHEN is_full THEN cap ELSE
               (above - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0)) * w
               // sum(CASE WHEN NOT is_full THEN w END) OVER ({part}) END::HUGEINT AS budget FROM f{depth})"""


_LEVELS = ", ".join(M.LEVELS)
_KEY = f"md5('{M.SEED}:' || (budget // have)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null'))"

MIXING = f"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, lang AS lang0, source AS source0,
    CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '4' THEN 'a' WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'b'
         WHEN substr(md5(coalesce(source, '')), 1, 1) < 'c' THEN 'c' ELSE 'd' END AS domain,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT {_LEVELS}, sum(n_tokens)::HUGEINT AS have FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0),
b0 AS (SELECT sum(have) * {M.PERCENT} // 100 AS budget FROM leaves),
{",".join(_level(d) for d in range(len(M.LEVELS)))},
keyed AS (SELECT docs.*, budget // have AS epochs, budget % have AS rest, {_KEY} AS k
          FROM docs JOIN leaves USING ({_LEVELS}) JOIN b{len(M.LEVELS)} USING ({_LEVELS})),
until AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {_LEVELS} ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u
          FROM keyed),
taken AS (SELECT *, epochs + CASE WHEN rest > 0 AND u <= rest THEN 1 ELSE 0 END AS copies FROM until)
SELECT doc_id, domain, lang0 AS lang, source0 AS source, n_tokens, e::INTEGER AS epoch
FROM taken, unnest(range(copies::BIGINT)) AS t(e)
"""

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> owner THEN owner END AS refers_to
FROM o
"""


def crc32(text: str) -> str:
    """The unsigned crc32 of the UTF-8 bytes of a text, bit by bit."""
    byte = "('0x' || substr(hex(encode(t)), 2 * b + 1, 2))::INTEGER"
    bits = f"flatten(list_transform(range(octet_length(encode(t))), lambda b: list_transform(range(8), lambda k: (({byte} >> k::INTEGER) & 1)::BIGINT)))"
    step = "lambda c, bit: CASE WHEN (c & 1) = bit THEN c >> 1 ELSE xor(c >> 1, 3988292384) END"
    return f"(SELECT xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295) FROM (SELECT {text} AS t))"


def _edit(state: str, cost: str, letter: str) -> str:
    """A value is its cost in nine digits and its audit, so that values compare as strings."""
    return f"(lpad((substr({state}, 1, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}')"


def _step(then: str) -> dict[str, str]:
    """The states after one more row, from those before it (v0, vs, vu, va) without insertions behind it."""
    free, more = "fault NOT IN ('b', 'd')", "CASE WHEN fault = 't' THEN 5 ELSE 0 END"
    kept = lambda state, x: f"CASE WHEN {free} AND initial = '{x}' THEN {_edit(state, more, 'K')} END"
    made = lambda state: f"CASE WHEN {free} THEN {_edit(state, f'(1 + {more})', 'R')} END"
    to_u = ", ".join(f"{kept(s, 'u')}, {made(s)}" for s in ("v0", "vs", "va"))
    return {"v0": _edit("v0", "2", "D"), "vs": f"least({_edit('vs', '2', 'D')}, {kept('v0', 's')})",
            "vu": f"least({_edit('vu', '2', 'D')}, {to_u})", "va": f"least({_edit('va', '2', 'D')}, {kept('vu', 'a')}, {made('vu')})"}[then]


_TO_U = f"least(wu, {_edit('w0', '5', 'I')}, {_edit('ws', '5', 'I')}, {_edit('wa', '5', 'I')})"
_WITH_INSERTS = f"w0 AS v0, ws AS vs, {_TO_U} AS vu, least(wa, {_edit(_TO_U, '5', 'I')}) AS va"

CONVERSATIONS = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS r(copy) WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k,
    CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE '-' END AS initial,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_char FROM damaged),
rows_ AS (SELECT *, CASE WHEN last_char = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
    WHEN last_char NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair FROM placed),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM rows_ GROUP BY conv_id),
states AS (
  SELECT conv_id, 0::BIGINT AS k, '000000000' AS v0, NULL::VARCHAR AS vs, '000000005I' AS vu, '000000010II' AS va FROM facts
  UNION ALL
  SELECT conv_id, k, {_WITH_INSERTS} FROM (
    SELECT s.conv_id, r.k, {_step('v0')} AS w0, {_step('vs')} AS ws, {_step('vu')} AS wu, {_step('va')} AS wa
    FROM states s JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.k = s.k + 1)),
best AS (SELECT f.*, least(v0, va) AS v FROM states s JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND s.k = f.n),
audits AS (SELECT * EXCLUDE (v), substr(v, 1, 9)::BIGINT AS cost, substr(v, 10) AS audit, length(replace(substr(v, 10), 'D', '')) % 2 AS odd FROM best),
letters AS (SELECT conv_id, odd, i, substr(audit, i::INTEGER, 1) AS e, length(replace(substr(audit, 1, i::INTEGER), 'I', '')) AS k,
    length(replace(substr(audit, 1, i::INTEGER), 'D', '')) - odd AS place FROM audits, unnest(range(1, length(audit) + 1)) AS t(i)),
texts AS (SELECT l.conv_id, string_agg(CASE WHEN e = 'K' THEN r.role || ':' || r.text
      ELSE CASE WHEN place % 2 = 1 THEN 'user:' ELSE 'assistant:' END || CASE WHEN e = 'R' THEN r.text ELSE '' END END, chr(10) ORDER BY i) AS t
  FROM letters l LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.k = l.k AND l.e <> 'I' WHERE e <> 'D' GROUP BY l.conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""

SPELLING = f"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM less a JOIN words w ON a.v = w.word
  UNION SELECT w.word, w.n, a.word, a.n FROM less a JOIN words w ON a.v = w.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM near),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
    CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL),
roots AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots USING (word)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) END AS shingles FROM w),
classes AS (SELECT shingles, len(shingles) AS n, min(r) AS c FROM s WHERE len(shingles) > 0 GROUP BY shingles),
t AS (SELECT c, n, unnest(shingles) AS shingle FROM classes),
met AS (SELECT a.c AS a, b.c AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS k FROM t a
  JOIN t b ON a.shingle = b.shingle AND a.c <> b.c AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY a.c, b.c),
links AS (SELECT a, b FROM met WHERE 100 * k >= 90 * (an + bn - k)),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
ids AS (SELECT c, min(doc_id) AS least_id FROM s JOIN classes USING (shingles) GROUP BY c),
found AS (SELECT reach.a AS c, min(least_id) AS component_id FROM reach JOIN ids ON ids.c = reach.b GROUP BY reach.a)
SELECT doc_id, len(s.shingles)::BIGINT AS n_shingles, CASE WHEN len(s.shingles) = 0 THEN doc_id ELSE component_id END AS component_id
FROM s LEFT JOIN classes USING (shingles) LEFT JOIN found USING (c)
"""

ORACLES: dict[str, str] = {"op4_mixing": MIXING, "op9_warc": WARC, "op11_conversation_repair": CONVERSATIONS,
                            "op12_spelling_variants": SPELLING, "op13_ngram_join": NGRAM_JOIN}
