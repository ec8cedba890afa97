"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Sets of shingles, links through an inverted index, and the closure of the links.
JACCARD = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 75 * (n + m - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.low, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least l ON l.a = s.doc_id
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Base measures from exploded words and windows; line rules from exploded lines.
LINE_CLEANING = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
windows AS (
  SELECT r, i, w[i : i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c >= 2),
covered AS (
  SELECT r, CAST(count(DISTINCT p) AS BIGINT) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
lines AS (
  SELECT * FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE translate(line, {_SPACES}, '') <> ''),
counted AS (
  SELECT r, line, length(line) AS n, length(translate(line, {_SPACES}, '')) AS chars,
    len({_WORDS.format("line")}) AS words,
    length(line) - length(translate(line, '|>', '')) AS links,
    length(line) - length(translate(line, '!', '')) AS exclaimed,
    length(line) - length(translate(line, '#*$%&|<>', '')) AS symbols
  FROM lines),
judged AS (
  SELECT *, regexp_matches(lower(line),
      'cookie|privacy policy|terms of use|terms of service|all rights reserved|copyright|licensed under|enable javascript|subscribe to our|newsletter|click here|read more|sign up|sign in|share this')
    OR (links >= 3 AND links * 4 >= words)
    OR NOT regexp_matches(line, '[.!?:;)"''\]…»”’。！？][ 	-
]*$') OR exclaimed * 2 > words OR symbols * 10 > n AS fails
  FROM counted),
of_lines AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (NOT fails) AS n_kept_lines, coalesce(sum(chars) FILTER (NOT fails), 0) AS kept_chars,
    count(*) - count(DISTINCT line) AS n_dup_lines
  FROM judged GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(text, {_SPACES}, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_kept_lines, 0) AS BIGINT) AS n_kept_lines,
    CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM base LEFT JOIN covered USING (r) LEFT JOIN of_lines USING (r)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND 2 * kept_chars >= word_chars AS kept FROM failed
"""

#: Rules by prefix and suffix tests, classes by the closure of canonical forms and links.
REDIRECTS = r"""
WITH RECURSIVE rules(host, path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
links AS (
  SELECT DISTINCT a, b FROM (
    SELECT url AS a, regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS b FROM pages
    UNION ALL
    SELECT url, regexp_extract(html, '(?is)<link\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)["'']?[^>]*\brel\s*=\s*["'']?canonical\b', 1) FROM pages
    UNION ALL
    SELECT url, regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM pages)
  WHERE contains(b, '://') AND a IS NOT NULL),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM links UNION SELECT b FROM links),
parts AS (
  SELECT url, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '(^|&)(utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '', 'g'), '^&', '') AS query
  FROM urls),
forms AS (
  SELECT url, host, path, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE url END AS form
  FROM parts),
fits AS (
  SELECT f.url, r.host || r.path AS rule, r.action,
    row_number() OVER (PARTITION BY f.url ORDER BY length(r.host || r.path) DESC, r.action) AS n
  FROM forms f JOIN rules r ON (f.host = r.host OR ends_with(f.host, '.' || r.host)) AND starts_with(f.path, r.path)),
ways AS (
  SELECT 'a:' || url AS a, 'f:' || form AS b FROM forms UNION SELECT 'f:' || form, 'a:' || url FROM forms
  UNION SELECT 'a:' || a, 'a:' || b FROM links UNION SELECT 'a:' || b, 'a:' || a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
spread AS (
  SELECT substr(r.a, 3) AS url, min(f.action) AS lowest FROM reach r JOIN fits f ON r.b = 'a:' || f.url AND f.n = 1
  WHERE r.a LIKE 'a:%' GROUP BY ALL)
SELECT p.page_id, coalesce(f.host, '') AS host, coalesce(f.path, '') AS path, t.rule, coalesce(t.action, s.lowest, 'allow') AS verdict
FROM pages p LEFT JOIN forms f ON f.url = p.url LEFT JOIN fits t ON t.url = p.url AND t.n = 1 LEFT JOIN spread s ON s.url = p.url
"""

#: Windows of 13 words as text, the least document of each, and the words that later windows cover.
REPEATED_WORDS = rf"""
WITH base AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM base WHERE len(w) >= 13)),
least AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(range(i, i + 13)) AS p FROM windows JOIN least USING (g) WHERE low < doc_id)),
removed AS (SELECT r, list(p) AS gone FROM covered GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM base LEFT JOIN removed USING (r)
"""

#: Counts of one, two and three words from windows of each length, all cuts in HUGEINT.
COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT lang, phrase, f, c, array_to_string(w[1 : c], ' ') AS x, array_to_string(w[c + 1 : k], ' ') AS y
  FROM candidates, (VALUES (1), (2)) AS places(c) WHERE c < k),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.f AS a, c, l.f AS l, r.f AS r,
    (CAST(1000000 AS HUGEINT) * cuts.f * cuts.f) // (l.f * r.f) AS score
  FROM cuts JOIN counts l ON l.lang = cuts.lang AND l.phrase = x JOIN counts r ON r.lang = cuts.lang AND r.phrase = y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, f FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
  WHERE inside.f IS NULL OR 100 * inside.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

#: Units as a list, cuts and forms from the hash's first four groups.
FILL_IN_MIDDLE = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
numbers AS (
  SELECT *, len(u) AS n, [CAST('0x' || h[8 * k + 1 : 8 * k + 8] AS BIGINT) for k in [0, 1, 2, 3]] AS g FROM base),
cut AS (
  SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS x, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 90 THEN 'plain'
      WHEN g[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1 : x], '') AS p, array_to_string(u[x + 1 : y], '') AS m,
    array_to_string(u[y + 1 :], '') AS s
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""

REFERENCE_SQL: dict[str, str] = {
    "op7_redirect_equivalence": REDIRECTS, "op8_line_cleaning": LINE_CLEANING, "op10_jaccard_join": JACCARD,
    "op11_fm_index": REPEATED_WORDS, "op12_rollup_collocations": COLLOCATIONS, "op13_fill_in_middle": FILL_IN_MIDDLE}
