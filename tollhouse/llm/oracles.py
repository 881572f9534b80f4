"""SQL for DuckDB with the results of the queries that SQL can express, written apart from the operators."""

OP1 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

# the text's words, its 8-word windows by their place, and the words that repeated windows cover
OP2 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM repeated) GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_same
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 10 * n_bangs > 3 * n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_same > 2 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""

OP6 = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(best.verdict, CASE WHEN regexp_matches(host, '(^|[.-])(ads|adserver|adult|casino|cheap-pills|free-bets|malware|phishing|porn|spam|tracker|xxx)([-.:]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best USING (page_id)
"""

# one level above another until one node remains in each tree; tree 0 holds the subroots, trees 1.. the languages.
# crc32 is worked off bit by bit, as DuckDB has no such function
OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
    'x' || coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen("text") || ':' || "text", '-') AS tail,
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)) AS crc
  FROM documents),
h AS (
  SELECT r, doc_id, lang, sha256(substr(head, 2) || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN sha256(substr(head, 2) || strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1) || tail) END AS tampered
  FROM d),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
up AS (
  SELECT 0 AS l, tree, i, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT l + 1, tree, i // 2, sha256(string_agg(node, '' ORDER BY i)), count(*) OVER (PARTITION BY tree) FROM up WHERE n > 1 GROUP BY l, tree, i // 2),
top AS (
  SELECT 0 AS l, tree - 1 AS i, node, count(*) OVER () AS n FROM up WHERE n = 1
  UNION ALL
  SELECT l + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), count(*) OVER () FROM top WHERE n > 1 GROUP BY l, i // 2),
deep AS (SELECT tree, max(l) AS depth FROM up GROUP BY tree),
nodes AS (SELECT l, tree, i, node FROM up WHERE n > 1 UNION ALL SELECT depth + top.l, deep.tree, -1 - top.i, node FROM top, deep WHERE top.n > 1),
steps AS (
  SELECT r, l, i >> l AS at, xor(i >> l, 1) AS other, tree FROM leaves JOIN deep USING (tree), range(0, 64) t(l) WHERE l < depth
  UNION ALL
  SELECT r, depth + l, (tree - 1) >> l, -1 - xor((tree - 1) >> l, 1), tree FROM leaves JOIN deep USING (tree), range(0, 64) t(l) WHERE l < (SELECT max(l) FROM top)),
proof AS (
  SELECT r, list(coalesce(node, '') ORDER BY steps.l) AS beside, list(steps.at & 1 ORDER BY steps.l) AS sides
  FROM steps LEFT JOIN nodes ON nodes.l = steps.l AND nodes.tree = steps.tree AND nodes.i = steps.other GROUP BY r),
f AS (
  SELECT doc_id, leaf, up.node AS subroot, (SELECT node FROM top WHERE n = 1) AS root, coalesce(array_to_string(beside, ''), '') AS beside_text,
    list_reduce(list_prepend(coalesce(tampered, leaf), list_transform(range(1, coalesce(len(beside), 0) + 1), lambda k: sides[k] || beside[k])),
      lambda node, x: CASE WHEN x[1] = '1' THEN sha256(substr(x, 2) || node) ELSE sha256(node || substr(x, 2)) END) AS folded_root
  FROM leaves JOIN up ON up.tree = leaves.tree AND up.n = 1 LEFT JOIN proof USING (r))
SELECT doc_id, leaf, subroot, root, sha256(beside_text) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""

ORACLES = {"op1_exact_dedup": OP1, "op2_quality_rules": OP2, "op6_url_filter": OP6, "op13_merkle": OP13}
