"""DuckDB SQL of the corpus operators that SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (SELECT *, {LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

URL_FILTER = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(action, rule, rhost, rpath) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.action, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (page_id)
"""

DECONTAMINATE = rf"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
found AS (SELECT g.doc_id, g.i, g.n, w.item FROM grams g JOIN windows w USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN least_of l ON l.a = w.doc_id
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE sound AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach(a, b) AS (SELECT DISTINCT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(m, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least_of l ON l.a = v.vec_id
"""

IMPORTANCE = rf"""
WITH bits AS (SELECT range AS b, list_reduce(list_prepend(range, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256)),
table_of AS (SELECT list(crc ORDER BY b) AS t FROM bits),
words AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
features AS (
  SELECT side, r, array_to_string(w[i:i + n - 1], ' ') AS f, count(*) AS c
  FROM words, range(1, 4) AS s(n), unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bytes AS (SELECT f, list_transform(range(1, length(h), 2), lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1) AS b FROM hexed),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, b::BIGINT[]), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, table_of),
counted AS (SELECT side, r, bucket, sum(c)::BIGINT AS c FROM features JOIN hashed USING (f) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(c) FILTER (side = 'd'), 0) AS s, coalesce(sum(c) FILTER (side = 'b'), 0) AS t FROM counted GROUP BY bucket),
alls AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM sums),
gains AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM sums, alls),
weights AS (SELECT r, sum(c * gain)::BIGINT AS weight FROM counted JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, len(w) AS n, (len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 'd'),
placed AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n >= 20) OVER () AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n >= 20 AND place <= 5 * fit // 100 THEN place END AS rank FROM placed
"""


def _nearest(k: int) -> str:
    """Every part's nearest entry of the k-th codebooks."""
    return f"""near{k} AS (
  SELECT r, p, any_value(x) AS x, arg_min(e, d * 256 + e) AS e, min(d) AS d
  FROM (SELECT r, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts JOIN book{k} USING (p))
  GROUP BY r, p)"""


def _refitted(k: int) -> str:
    """The codebooks after the k-th assignment."""
    return f"""book{k + 1} AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
    SELECT p, e, list(floor_of ORDER BY i) AS c FROM (
      SELECT p, e, i, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_of
      FROM (SELECT p, e, unnest(x) AS v, unnest(range(len(x))) AS i FROM near{k}) GROUP BY p, e, i)
    GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, q[p * (len(q) // 16) + 1:(p + 1) * (len(q) // 16)] AS x FROM kept, range(16) AS t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
{_nearest(0)},
{_refitted(0)},
{_nearest(1)},
{_refitted(1)},
{_nearest(2)},
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), books
"""
