"""DuckDB SQL with the rows of those ``opN_*`` queries that SQL can express."""

from . import chat_format

ORACLES: dict[str, str] = {
    "op2_url_filter": r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
    "op3_hyperminhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM l),
x AS (SELECT doc_id, unnest(s) AS s FROM l),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
k AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id, n.doc_id = min(r) AS kept FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY n.doc_id, n.n
""",
    "op7_block_search": """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op9_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, x.i, x.r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(i, r)),
e AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
    length(regexp_replace(role, '@CONTROL@', '\1\\\2', 'g')) AS role_chars,
    length(regexp_replace(text, '@CONTROL@', '\1\\\2', 'g')) AS text_chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + CASE WHEN opens THEN role_chars + length('<|start|><|text|><|end|>') ELSE length('<|next|>') END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""".replace("@CONTROL@", rf"([<\[])(\\*(?:{chat_format._RESTS}))"),
}
