"""SQL (DuckDB) that gives the rows of the queries it can express; written apart from the operators."""

BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{BLANK}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (k) WHERE doc_id > m),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM gone)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_PHRASES = "lorem ipsum|enable javascript|javascript is disabled|javascript is required|this site uses cookies|this website uses cookies"
_SHORT_PHRASES = "cookie policy|uses cookies|use of cookies|privacy policy|terms of use|javascript|click here|sign in|log in"

LINE_QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLANK}') AS w FROM documents),
line AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '{BLANK}')) AS n, length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars,
    length(l) - length(regexp_replace(l, '[|»›•·→]', '', 'g')) AS bars, len(regexp_extract_all(l, '(?i)(^|[\\x20\\x09-\\x0D])(https?://|www\\.)')) AS links,
    length(l) - length(regexp_replace(l, '[\\x{{3000}}-\\x{{D7FF}}]', '', 'g')) AS wide, length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g')) AS symbols,
    length(l) - length(regexp_replace(l, '[A-Z]', '', 'g')) AS upper, length(l) - length(regexp_replace(l, '[A-Za-z]', '', 'g')) AS letters,
    regexp_matches(l, '[.!?:;"'')\\]…“”’»›。！？：；」』）।؟][\\x20\\x09-\\x0D]*$') AS closed,
    regexp_matches(l, '(?i)(^|[^A-Za-z0-9])({_PHRASES})([^A-Za-z0-9]|$)') AS phrase, regexp_matches(l, '(?i)(^|[^A-Za-z0-9])({_SHORT_PHRASES})([^A-Za-z0-9]|$)') AS short_phrase
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{BLANK}')),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS dup,
    coalesce(sum(chars) FILTER (WHERE 100 * bars >= 30 * n OR 100 * links >= 50 * n OR 100 * symbols >= 50 * n OR (n >= 4 AND letters > 0 AND 100 * upper >= 80 * letters) OR (NOT closed AND 2 * n + wide < 10) OR phrase OR (short_phrase AND n < 8)), 0) AS lost
  FROM line GROUP BY doc_id),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, k FROM tri GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_rep FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri JOIN twice USING (doc_id, k)) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(n_rep, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 50 * word_chars AS kept
FROM base
"""

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
full_lines AS (SELECT doc_id, list(struct_pack(pos := pos, l := l) ORDER BY pos) AS ls FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (
  SELECT doc_id, ls[i].pos AS pos, list_transform(ls[i:i + 2], lambda x: x.pos) AS lines, list_transform(ls[i:i + 2], lambda x: x.l) AS k
  FROM (SELECT doc_id, ls, unnest(range(1, greatest(len(ls) - 2, 1) + 1)) AS i FROM full_lines)
  UNION ALL SELECT doc_id, pos, [pos], [l] FROM line WHERE (length(l) >= 200 OR len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 50) AND regexp_matches(l, '[^\x20\x09-\x0D]')
  UNION ALL SELECT doc_id, a.pos, [a.pos, b.pos], [a.l, b.l] FROM (SELECT doc_id, unnest(ls[:-2]) AS a, unnest(ls[2:]) AS b FROM full_lines WHERE len(ls) >= 2)
    WHERE len(regexp_extract_all(a.l || ' ' || b.l, '[^\x20\x09-\x0D]+')) >= 50),
firsts AS (SELECT k, min(struct_pack(doc_id := doc_id, pos := pos)) AS f FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(lines) AS pos FROM win JOIN firsts USING (k) WHERE struct_pack(doc_id := doc_id, pos := pos) > f),
kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY pos) AS t FROM line ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(len(ls), 0)::BIGINT END AS n_lines, CASE WHEN d.text IS NOT NULL THEN coalesce(n, 0)::BIGINT END AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM documents d LEFT JOIN full_lines USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(text, '{BLANK}') AS w FROM documents WHERE regexp_matches(text, '{BLANK}')),
gram AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) < 5),
sets AS (SELECT doc_id, list(g ORDER BY g) AS s, count(*) AS size FROM gram GROUP BY doc_id),
copies AS (SELECT min(doc_id) AS copy_of, s, count(*) AS n_copies, any_value(size) AS size FROM sets GROUP BY s),
own AS (SELECT gram.* FROM gram JOIN copies ON doc_id = copy_of),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM own x JOIN own y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN copies ca ON a = ca.copy_of JOIN copies cb ON b = cb.copy_of WHERE shared >= 0.8 * (ca.size + cb.size - shared)),
ends AS (SELECT a AS x, b AS y FROM link UNION ALL SELECT b, a FROM link),
reach(x, y) AS (SELECT x, y FROM ends UNION SELECT r.x, e.y FROM reach r JOIN ends e ON r.y = e.x),
class AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM ends GROUP BY x)
SELECT t.doc_id, coalesce(c, k.copy_of, t.doc_id) AS class_id, coalesce(k.copy_of, t.doc_id) AS copy_of, coalesce(n_copies, 1)::BIGINT AS n_copies, coalesce(degree.n, 0)::BIGINT AS n_links
FROM documents t LEFT JOIN sets USING (doc_id) LEFT JOIN copies k ON sets.s = k.s LEFT JOIN class ON k.copy_of = class.x LEFT JOIN degree ON k.copy_of = degree.x
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{ALNUM}') AS w FROM benchmark),
own AS (
  SELECT item_id, 13 AS size, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)
  UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 12),
sizes AS (SELECT DISTINCT size FROM own),
win AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, i, win.size FROM win JOIN own ON win.k = own.k AND win.size = own.size),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(places.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(places.n, 0) > 0 AND 20 * coalesce(places.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

URL_FILTER = r"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
r(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS v
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN fit USING (page_id)
"""

#: CRC-32 of a text's ASCII codes, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}) + 1), lambda i: unicode({0}[i]))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda s, z: xor(s >> 1, (s & 1) * 3988292384))), 4294967295)"""

CONVERSATION_TRIE = f"""
WITH turn AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, length(coalesce(text, '')), role, text) AS k FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, list(x ORDER BY k) AS xs FROM turn GROUP BY conv_id),
head AS (SELECT conv_id, xs, ({_CRC.format("(conv_id::VARCHAR)")} % 6)::INT AS h FROM conv),
rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.xs[1:a.h], []), coalesce(a.xs[a.h + 1:], [])) AS xs FROM head a LEFT JOIN conv b ON b.conv_id = a.conv_id - a.conv_id % 100),
step AS (SELECT conv_id, d, xs[1:d] AS p, len(xs) = d AS ends FROM (SELECT conv_id, xs, unnest(range(0, len(xs) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT min(conv_id) AS conv_id, d, p, count(*) AS n, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS e,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(p[d].t) END AS s
  FROM step GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
up AS (SELECT node.d AS own_d, unnest(range(0, node.d + 1)) AS d, node.p AS own_p, s, n_children IS NULL AS leaf FROM node LEFT JOIN kids ON node.d = kids.d AND node.p = kids.p),
sub AS (SELECT d, own_p[1:d] AS p, sum(s) AS saved, count(*) FILTER (WHERE leaf) AS leaves FROM up GROUP BY ALL)
SELECT node.conv_id, node.d::BIGINT AS depth, above.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(node.e) AS ends_sha256
FROM node JOIN sub ON node.d = sub.d AND node.p = sub.p LEFT JOIN kids ON node.d = kids.d AND node.p = kids.p
LEFT JOIN node above ON above.d = node.d - 1 AND above.p = node.p[1:node.d - 1]
"""
