"""DuckDB SQL for the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, {LOWER} AS norm FROM documents),
r AS (SELECT *, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op3_suffix_dedup": """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (SELECT row, doc_id, p, substr(x, 2 * p + 1, 100) AS s FROM (SELECT row, doc_id, x, unnest(range(0, greatest(len(x) // 2 - 49, 0))) AS p FROM d)),
least AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
hit AS (SELECT row, p, p > lag(p, 1, -99) OVER (PARTITION BY row ORDER BY p) + 50 AS opens FROM g JOIN least USING (s) WHERE first < doc_id),
span AS (SELECT row, min(p) AS a, max(p) + 50 AS b FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY row ORDER BY p) AS k FROM hit) GROUP BY row, k),
edge AS (SELECT row, a, b FROM span UNION ALL SELECT row, len(x) // 2, len(x) // 2 FROM d),
piece AS (SELECT row, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a, b) AS lo, a AS hi FROM edge),
kept AS (SELECT row, string_agg(substr(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi) AS x FROM piece JOIN d USING (row) GROUP BY row)
SELECT d.doc_id, len(d.x) // 2 AS n_bytes, coalesce((SELECT sum(b - a) FROM span WHERE span.row = d.row), 0)::BIGINT AS n_removed,
  (SELECT count(*) FROM span WHERE span.row = d.row) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256 FROM d JOIN kept USING (row)""",
    "op7_near_dedup": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT DISTINCT row, concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3]) AS x FROM (SELECT row, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
      UNION ALL SELECT row, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
s AS (SELECT row, doc_id, coalesce(n, 0) AS n FROM d LEFT JOIN (SELECT row, count(*) AS n FROM x GROUP BY row) USING (row)),
e AS (SELECT row, n, x FROM x JOIN s USING (row)),
links AS (SELECT a.row AS a, b.row AS b FROM e a JOIN e b ON a.x = b.x AND a.row < b.row GROUP BY a.row, b.row
      HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT row, row FROM s UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
c AS (SELECT r.a AS row, min(s.doc_id) AS component_id FROM reach r JOIN s ON s.row = r.b GROUP BY r.a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (row)""",
    "op4_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length(text) + len(regexp_extract_all(text, '(<|\[)(\\*)(/?s>|/?INST\])')) AS body FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(role) END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n, any_value(total) AS total FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT x.lang, x.source, coalesce(s.n, 0)::HUGEINT AS group_n, l.v, l.lang_n FROM (SELECT DISTINCT lang, source FROM d) x
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source) s USING (lang, source) LEFT JOIN langs l USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (group_n + 2 * v) AS p,
        1 + (1000000000::HUGEINT * (k.total + 2)) // (lang_n + 2 * v) AS q
      FROM g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
      WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms)
WHERE rank <= 10""",
}
