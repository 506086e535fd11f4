"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '###', '\\###'), '</turn>', '\\</turn>')"

SQL: dict[str, str] = {
    "op7_chat_formatting": f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED.format("text")}) + length(replace({_ESCAPED.format("role")}, ':', '\\:')) + 14) AS BIGINT)
    AS formatted_chars
FROM said GROUP BY conv_id""",
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM worded
), sized AS (
  SELECT doc_id, s, len(s) AS n, md5(array_to_string(list_sort(s), chr(1))) AS k FROM sets
), reps AS (
  SELECT k, min(doc_id) AS r, any_value(s) AS s, any_value(n) AS n FROM sized WHERE n > 0 GROUP BY k
), grams AS (
  SELECT r, n, unnest(s) AS g FROM reps
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM grams a JOIN grams b ON a.g = b.g AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT r AS node, r AS root FROM reps
  UNION SELECT e.b, reach.root FROM reach JOIN edges e ON e.a = reach.node
), roots AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT sized.doc_id, CAST(sized.n AS BIGINT) AS n_shingles,
  CASE WHEN sized.n = 0 THEN sized.doc_id ELSE roots.root END AS component_id
FROM sized LEFT JOIN reps ON reps.k = sized.k AND sized.n > 0 LEFT JOIN roots ON roots.node = reps.r""",
    "op11_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS f
  FROM (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts) texts
  LEFT JOIN marks ON marks.doc_id = texts.doc_id
), masks AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f
), letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT filter_order, s AS step, substr(filter_order, s, 1) AS l, substr(filter_order, 1, s - 1) AS earlier
  FROM orders, range(1, 6) r(s)
), counted AS (
  SELECT part, filter_order, step, l,
    sum(n) FILTER (translate(earlier || l, f, '') = earlier || l) AS kept,
    sum(n) FILTER (contains(f, l) AND translate(earlier, f, '') = earlier) AS removed,
    sum(n) FILTER (contains(f, l) AND translate(earlier, f, '') <> earlier) AS redundant,
    sum(n) FILTER (f = l) AS unique_fails,
    sum(good) FILTER (contains(f, l) AND translate(earlier, f, '') = earlier) AS good_lost,
    sum(toxic) FILTER (contains(f, l) AND translate(earlier, f, '') = earlier) AS toxic_lost
  FROM steps, masks GROUP BY part, filter_order, step, l
)
SELECT part, filter_order, CAST(step AS INT) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted""",
    "op12_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut
), formed AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
    array_to_string(u[1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS pm FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(pm) - length(p) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || p || '<S>' || substr(t, length(pm) + 1) || '<M>' || substr(pm, length(p) + 1)
    ELSE '<S>' || substr(t, length(pm) + 1) || '<P>' || p || '<M>' || substr(pm, length(p) + 1) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM formed""",
    "op13_warc": r"""
WITH held AS (
  SELECT page_id, coalesce(html, '') AS t FROM pages
), grouped AS (
  SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha256(t) AS payload_digest,
    CASE WHEN strlen(t) >= 100 THEN min(page_id) OVER (PARTITION BY t) END AS holder FROM held
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM grouped""",
}
