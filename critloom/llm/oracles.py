r"""DuckDB SQL of the queries that SQL can express, written from the contracts.

Not expressed: op1 (added spans need the corpus statistics of the operator), op3 (address joining and
components), op4, op7, op8 (trained models), op10 (XXH64). Tests hold those against brute force."""

WORD = r"'[^\x20\x09-\x0D]+'"

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sizes AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS body,
    length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS head FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + head + 1 + body + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {WORD}) AS ws FROM d),
grams AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
keyed AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g FROM grams),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM keyed),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n FROM lines WHERE regexp_matches(x, {WORD}) GROUP BY r),
s AS (
  SELECT doc_id, t, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(dup.n_lines, 0) AS n_lines, coalesce(hit.n, 0) AS n_repeat_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN hit USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 4 > n_words
    OR (n_lines > 3 AND n_dup_lines * 10 > n_lines * 3) OR word_chars < n_words * 2 OR word_chars > n_words * 20
    OR length(regexp_replace(t, '[^A-Z]+', '', 'g')) * 2 > length(regexp_replace(t, '[^A-Za-z]+', '', 'g'))
    OR length(regexp_replace(t, '[^0-9]+', '', 'g')) * 2 > word_chars
    OR length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) * 2 < word_chars) AS kept
FROM s
"""

OP6 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {WORD})) AS BIGINT) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM d GROUP BY source),
ranked AS (
  SELECT *, 3 * size AS cap, sum(size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(3 * size) OVER before, 0) AS caps_before, coalesce(sum(weight) OVER before, 0) AS weights_before,
    row_number() OVER (ORDER BY 3.0 * size / weight, source IS NULL, source) AS k
  FROM totals WINDOW before AS (ORDER BY 3.0 * size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT CAST(total - caps_before AS DOUBLE) / CAST(weights - weights_before AS DOUBLE) AS height
  FROM ranked WHERE CAST(total - caps_before AS DOUBLE) / CAST(weights - weights_before AS DOUBLE) * weight <= cap ORDER BY k LIMIT 1),
targets AS (SELECT source, size, least(CAST(cap AS DOUBLE), height * weight) AS target FROM ranked, level),
plan AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(least(floor(target / size), 3) AS BIGINT) ELSE 0 END AS whole FROM targets),
ordered AS (
  SELECT d.doc_id, d.size, p.size AS source_size, p.target, p.whole, p.target - p.whole * p.size AS need,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN need > 0 AND upto - own / 2.0 < need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT item_id, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i, ws FROM b WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM bw),
lengths AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT r, l.n, unnest(range(1, len(ws) - l.n + 2)) AS i, ws FROM d, lengths l WHERE len(ws) >= l.n),
hits AS (
  SELECT dw.r, dw.i, dw.n, w.item_id FROM (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM dw) dw
  JOIN windows w ON w.n = dw.n AND w.g = dw.g),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLES: dict[str, str] = {
    "op2_chat_formatting": OP2, "op5_quality_rules": OP5, "op6_mixing": OP6, "op9_benchmark_decontamination": OP9,
}
