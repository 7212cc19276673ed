"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
"""

OP2 = f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT page_id, host, path,
  (SELECT rhost || rpath FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
   ORDER BY length(rhost || rpath) DESC LIMIT 1) AS rule,
  coalesce((SELECT action FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
   ORDER BY length(rhost || rpath) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""

WORDS7 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS7}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS7}') AS w FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM pat),
win AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, win.n, item_id FROM win JOIN pat ON win.win = pat.win AND win.n = pat.n),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM inter JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.other) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n.n
"""

OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM win JOIN again USING (win)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


OP11 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*(s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\]|ROLE\]|/ROLE\])')) AS body,
    length(role) + len(regexp_extract_all(role, '<\\*(s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\]|ROLE\]|/ROLE\])')) AS named FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(body + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4 ELSE 17 + named END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

WORDS12 = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS12}') AS w FROM documents),
t AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_count FROM t GROUP BY lang, term HAVING count(*) >= 30),
counts AS (SELECT lang, source, term, sum(n) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v, sum(lang_count) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5)) // (CAST(totals.total AS HUGEINT) + 5 * v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (lang_count + 5)) // (CAST(sizes.total AS HUGEINT) + 5 * v) AS q
  FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS INTEGER) AS rank FROM rows)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

WORDS13 = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS13}') AS w FROM documents),
n AS (SELECT rid, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n) AS terms FROM n),
q AS (SELECT DISTINCT item_id, term FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS13}')) AS term FROM benchmark)),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
m AS (SELECT rid, doc_id, 10 + CAST((90 * n * docs) // terms AS BIGINT) AS m FROM n, total),
score AS (
  SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score) WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": OP1, "op2_url_filter": OP2, "op6_ngram_join": OP6, "op7_decontamination": OP7, "op8_substring_dedup": OP8,
    "op11_chat_format": OP11, "op12_source_divergence": OP12, "op13_lexical_search": OP13,
}
