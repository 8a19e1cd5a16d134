"""SQL statements of the operators that SQL can express, each over the whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Equal stretches by their digest; removed bytes are counted from the windows that begin before and end behind them.
SUFFIX_DEDUP = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS MATERIALIZED (SELECT r, i, md5(substr(x, 2*i + 1, 800)) AS k FROM d, unnest(range(0, n - 399)) t(i)),
hit AS MATERIALIZED (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
span AS (SELECT r, i, i - 400 > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -401) AS starts FROM hit),
run AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(starts::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM span) x GROUP BY r, g),
edge AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM run),
part AS (SELECT r, a, b, before, substr(x, 2*before + 1, 2*(a - before)) AS kept FROM edge JOIN d USING (r)),
per AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(kept, '' ORDER BY a) AS kept, max(b) AS behind FROM part GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2*coalesce(behind, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN per USING (r)"""

SUBSTRING_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS MATERIALIZED (SELECT r, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k FROM d, unnest(range(1, len(w) - 48)) t(i) WHERE doc_id IS NOT NULL),
hit AS (SELECT r, i FROM k JOIN (SELECT k, min(doc_id) AS first FROM k GROUP BY k) m USING (k) WHERE first < doc_id),
gone AS (SELECT r, list(DISTINCT i + j) AS lost FROM hit, unnest(range(0, 50)) t(j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(lost), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN lost IS NULL THEN w ELSE list_filter(list_transform(range(1, len(w) + 1), lambda p: CASE WHEN list_contains(lost, p) THEN NULL ELSE w[p] END), lambda x: x IS NOT NULL) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)"""

DECONTAMINATE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, w[i : i + 9] AS p FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) t(i) WHERE len(w) > 0),
size AS (SELECT DISTINCT len(p) AS n FROM win),
hit AS MATERIALIZED (SELECT DISTINCT r, s, n, item_id FROM (SELECT r, s, n, w[s : s + n - 1] AS p FROM d, size, unnest(range(1, len(w) - n + 2)) t(s)) x JOIN win USING (p)),
cover AS (SELECT r, count(DISTINCT s + j) AS n_hit FROM hit, unnest(range(0, n)) t(j) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) x GROUP BY r),
tok AS MATERIALIZED (SELECT r, pos, w[pos] AS term FROM d, unnest(range(1, len(w) + 1)) t(pos)),
phrase AS MATERIALIZED (SELECT DISTINCT p FROM win),
place AS (SELECT p, off, p[off] AS term FROM phrase, unnest(range(1, len(p) + 1)) t(off)),
freq AS (SELECT term, count(*) AS n FROM tok GROUP BY term),
rare AS MATERIALIZED (SELECT p, off, term, row_number() OVER (PARTITION BY p ORDER BY n, off) AS k, min(n) OVER (PARTITION BY p) AS least FROM (SELECT p, off, term, coalesce(n, 0) AS n FROM place LEFT JOIN freq USING (term)) x),
one AS (SELECT r, p, pos - off AS s FROM rare JOIN tok USING (term) WHERE k = 1 AND least > 0),
two AS (SELECT r, p, pos - off AS s2 FROM rare JOIN tok USING (term) WHERE k = 2 AND least > 0),
near AS (SELECT r, p FROM (SELECT r, p, s, min(abs(s - s2)) AS gap FROM one JOIN two USING (r, p) WHERE abs(s - s2) <= 5 GROUP BY r, p, s) x JOIN d USING (r) WHERE gap > 0 OR s < 0 OR w[s + 1 : s + len(p)] IS DISTINCT FROM p),
close AS (SELECT r, count(DISTINCT item_id) AS n_near FROM near JOIN win USING (p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near FROM d LEFT JOIN cover USING (r) LEFT JOIN listed USING (r) LEFT JOIN close USING (r)"""

#: The same edits as shortest ways through the grammar's four places, row by row.
CONVERSATION = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)), lambda a, b:
  list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 20 AS way FROM c),
dam AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role, CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM h, unnest(range(0, CASE WHEN way = 3 THEN 2 ELSE 1 END)) t(i) WHERE way <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, left(role, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
  regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended FROM dam),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
f AS MATERIALIZED (SELECT *, is_blank OR again AS dead, CASE WHEN is_blank OR again OR ended THEN 0 ELSE 1 END AS cut, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM r),
ins(a, b, letters, fee) AS (VALUES ('0', '0', '', 0), ('0', 'u', 'I', 5), ('0', 'a', 'II', 10), ('s', 's', '', 0), ('s', 'u', 'I', 5), ('s', 'a', 'II', 10), ('a', 'a', '', 0), ('a', 'u', 'I', 5), ('u', 'u', '', 0), ('u', 'a', 'I', 5)),
ways(conv_id, i, place, cost, audit) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '0', 0, '' FROM conversations
  UNION ALL
  SELECT conv_id, i, place, cost, audit FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, place ORDER BY cost, audit) AS best FROM (
    SELECT w.conv_id, f.i, CASE WHEN e.edit = 'D' THEN ins.b WHEN e.edit = 'K' THEN f.ini WHEN ins.b = 'u' THEN 'a' ELSE 'u' END AS place,
      w.cost + ins.fee + CASE e.edit WHEN 'D' THEN 2 WHEN 'K' THEN 5 * f.cut ELSE 1 + 5 * f.cut END AS cost, w.audit || ins.letters || e.edit AS audit
    FROM ways w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins ON ins.a = w.place, (VALUES ('D'), ('K'), ('R')) e(edit)
    WHERE e.edit = 'D' OR NOT f.dead AND (e.edit = 'R' OR f.ini = 's' AND ins.b = '0' OR f.ini = 'u' AND ins.b <> 'u' OR f.ini = 'a' AND ins.b = 'u')) x) y WHERE best = 1),
last AS (SELECT conv_id, max(i) AS n FROM ways GROUP BY conv_id),
done AS (SELECT conv_id, cost, audit FROM (SELECT w.conv_id, w.cost + ins.fee AS cost, w.audit || ins.letters AS audit, row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + ins.fee, w.audit || ins.letters) AS best
  FROM ways w JOIN last ON last.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = last.n JOIN ins ON ins.a = w.place WHERE ins.b = 'a' OR ins.b = '0') x WHERE best = 1),
letter AS (SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM done, unnest(range(1, length(audit) + 1)) t(p)),
kept AS (SELECT l.conv_id, l.p, l.edit, f.role, f.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.p) AS k, max(CASE WHEN l.edit = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS sys
  FROM letter l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE l.edit <> 'D'),
text AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role WHEN 'R' THEN CASE WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END ELSE CASE WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS fixed FROM kept GROUP BY conv_id),
stat AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (again AND NOT is_blank) AS duplicate, sum(cut) AS truncated,
  count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(fixed, '')) AS repaired_sha256
FROM done d LEFT JOIN stat s ON s.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN text t ON t.conv_id IS NOT DISTINCT FROM d.conv_id"""

LINE_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (SELECT r, doc_id, p, lines[p] AS line, translate(trim(lines[p], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM d, unnest(range(1, len(lines) + 1)) t(p)),
shared AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 5),
j AS (SELECT r, p, line, top IS NOT NULL AND doc_id IS DISTINCT FROM top AS gone FROM l LEFT JOIN shared ON l.k = shared.k),
per AS (SELECT r, count(*) AS n, count(*) FILTER (gone) AS lost, string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone) AS kept FROM j GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_lines, CAST(lost AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM per JOIN d USING (r)"""

LEXICAL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
q AS MATERIALIZED (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM b) x GROUP BY ALL),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) x WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS wt FROM tf, g GROUP BY term, g.n),
x AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * g.n) // g.l)) AS x FROM tf JOIN d USING (r), g),
s AS (SELECT i, item_id, r, doc_id, sum(times * wt * x)::BIGINT AS score FROM q JOIN wt USING (term) JOIN x USING (term) GROUP BY ALL HAVING sum(times * wt * x) > 0)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank FROM s) y WHERE rank <= 10"""
