"""The same questions in SQL, for those that SQL can ask."""

SQL: dict[str, str] = {}

SQL["op7_line_rules"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
w AS (
  SELECT doc_id, k, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
win AS (
  SELECT k, i, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
again AS (
  SELECT k, unnest(range(i, i + 5)) AS p
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
reps AS (SELECT k, count(DISTINCT p) AS n FROM again GROUP BY k),
lines AS (
  SELECT k, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    length(line) - length(replace(line, '|', '')) AS bars,
    length(line) - length(regexp_replace(line, '[#*$%&|<>!?]', '', 'g')) AS noise
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM t)),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY k, line ORDER BY pos) > 1 AS dup,
    NOT regexp_matches(line, '[.!?"'':;)”’…»。！？][\x20\x09-\x0D]*$')
      AND (n < 10 OR NOT regexp_matches(line, '[.!?][\x20\x09-\x0D]'))
    OR noise >= 4 AND 2 * noise > n
    OR bars >= 3 OR bars >= 1 AND 4 * bars >= n
    OR regexp_matches(lower(line), 'all rights reserved|licensed under|terms of use|privacy policy|use of cookies|accept cookies|enable javascript|lorem ipsum|click here|subscribe to our') AS bad
  FROM lines WHERE n > 0),
per AS (
  SELECT k, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS dups, sum(CASE WHEN bad THEN n ELSE 0 END) AS lost
  FROM judged GROUP BY k),
base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(reps.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(lost, 0) AS lost
  FROM w LEFT JOIN reps USING (k) LEFT JOIN per USING (k)),
verdict AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= 50 * n_words AS kept
FROM verdict
"""

SQL["op10_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    row_number() OVER () AS k
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT k, h || p AS rule, v,
    row_number() OVER (PARTITION BY k ORDER BY length(h || p) DESC, v DESC, h || p DESC) AS place
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (k)
"""

SQL["op5_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS g
  FROM w),
t AS (SELECT doc_id, unnest(g) AS token, len(g) AS n FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM t a JOIN t b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id
"""

SQL["op8_suffix_dedup"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k, encode(coalesce(text, '')) AS b FROM documents),
p AS (
  SELECT k, doc_id, i, hex(b[i:i]) AS byte, CASE WHEN i + 49 <= octet_length(b) THEN b[i:i + 49] END AS string
  FROM (SELECT k, doc_id, b, unnest(range(1, octet_length(b) + 1)) AS i FROM d)),
least AS (SELECT string, min(doc_id) AS first_doc FROM p WHERE string IS NOT NULL GROUP BY string),
m AS (
  SELECT k, i, byte, CASE WHEN first_doc < doc_id THEN 1 ELSE 0 END AS repeated
  FROM p LEFT JOIN least ON p.string = least.string),
c AS (
  SELECT k, i, byte, max(repeated) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM m),
s AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY k ORDER BY i) AS before FROM c),
r AS (
  SELECT k, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans,
    coalesce(string_agg(byte, '' ORDER BY i) FILTER (gone = 0), '') AS kept
  FROM s GROUP BY k)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (k)
"""

SQL["op12_spelling"] = r"""
WITH RECURSIVE crc(steps) AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)]
      ELSE [CAST(192 | (ord(c) >> 6) AS BIGINT), CAST(128 | (ord(c) & 63) AS BIGINT)] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, x: xor(c >> 8, steps[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) AS h FROM bytes, crc),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (
  SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b
    ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocabulary v ON v.word = h.head || h.tail
  UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocabulary v ON v.word = h.head || h.tail),
near AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, form := other)) AS best FROM pairs GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 10 * n THEN best.form END AS form,
    CASE WHEN -best.m >= 10 * n THEN -best.m END AS form_n
  FROM vocabulary LEFT JOIN near USING (word)),
ways AS (
  SELECT word, word AS reached, form AS next FROM judged
  UNION ALL SELECT ways.word, j.word, j.form FROM ways JOIN judged j ON j.word = ways.next)
SELECT word, form, reached AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM judged JOIN (SELECT word, reached FROM ways WHERE next IS NULL) USING (word)
"""

SQL["op13_lexical_search"] = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM t WHERE len(terms) > 0),
p AS (
  SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM t)
  WHERE term IN (SELECT term FROM q) GROUP BY k, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
m AS (SELECT k, doc_id, 100 - 50 + (50 * len(terms) * docs) // total AS m FROM t, c WHERE len(terms) > 0),
s AS (
  SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY item_id, k, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""
