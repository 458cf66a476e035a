"""DuckDB SQL for the registered queries that SQL can state."""

from __future__ import annotations

# Explicit rules alone: the given pages hold no canonical or redirect edge but
# dropped fragments, whose two sides always fit the same rule.
OP1 = r"""
WITH u AS (
  SELECT page_id,
         coalesce(lower(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1)), '') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
hit AS (
  SELECT u.page_id, u.host, u.path, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k
  FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hit WHERE k = 1
"""

# A conversation is escaped if one of its texts or roles holds something that
# reads as a control string; every such place then takes one character more.
OP3 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, len(regexp_extract_all(role || '
' || text, '<\\*/?s>|\[\\*/?INST\]')) AS marks FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + marks + 17) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# Brute force over the pairs that share a shingle, then reachability.
OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2
      THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
      WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM w)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * i >= 80 * (x.n + y.n - i)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT a, b FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
low AS (SELECT doc_id, least(doc_id, min(other)) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN low USING (doc_id)
"""

OP8 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT doc_id, list(i) AS starts FROM win JOIN low USING (s) WHERE m < doc_id GROUP BY doc_id),
word AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w),
cover AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k
  FROM (SELECT doc_id, unnest(starts) AS i FROM hit)),
kept AS (
  SELECT a.doc_id, string_agg(a.w[a.k], ' ' ORDER BY a.k) AS t, count(*) AS n
  FROM word a ANTI JOIN cover c ON a.doc_id = c.doc_id AND a.k = c.k GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

# crc32 bit by bit over the digits of the key; the trees by one recursion over
# their levels; a proof is folded by a reduction over its siblings.
OP11 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS crc,
    concat_ws('',
      coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM documents),
leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN xor(crc, 4294967295) % 3 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS changed
  FROM d),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM leaf),
node(level, lang, pos, n, h) AS (
  SELECT 0, lang, pos, n, h FROM placed
  UNION ALL
  SELECT level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM node WHERE n > 1 GROUP BY level, lang, pos // 8, n),
sub AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM node WHERE n = 1),
crown(level, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM crown WHERE n > 1 GROUP BY level, pos // 8, n),
step AS (
  SELECT p.lang, p.pos, b.level,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < p.pos // CAST(pow(8, b.level) AS BIGINT)), '') AS pre,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > p.pos // CAST(pow(8, b.level) AS BIGINT)), '') AS post
  FROM placed p JOIN node b ON p.lang IS NOT DISTINCT FROM b.lang AND b.n > 1
    AND b.pos // 8 = p.pos // CAST(pow(8, b.level + 1) AS BIGINT)
  GROUP BY ALL
  UNION ALL
  SELECT p.lang, p.pos, 100 + b.level,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < s.pos // CAST(pow(8, b.level) AS BIGINT)), ''),
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > s.pos // CAST(pow(8, b.level) AS BIGINT)), '')
  FROM placed p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang
    JOIN crown b ON b.n > 1 AND b.pos // 8 = s.pos // CAST(pow(8, b.level + 1) AS BIGINT)
  GROUP BY ALL),
proof AS (
  SELECT lang, pos, string_agg(pre || post, '' ORDER BY level) AS siblings,
         list(pre || '|' || post ORDER BY level) AS steps
  FROM step GROUP BY lang, pos),
folded AS (
  SELECT p.doc_id, p.h AS leaf, s.subroot, (SELECT h FROM crown WHERE n = 1) AS root,
    sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(p.changed, coalesce(steps, [])), lambda h, x:
      sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN proof f ON p.lang IS NOT DISTINCT FROM f.lang AND p.pos = f.pos)
SELECT *, folded_root = root AS verified FROM folded
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
         CAST(list_dot_product(a.x, o.x) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
WHERE rank <= 5
"""

SQL = {
    "op1_url_filters": OP1,
    "op3_chat_format": OP3,
    "op5_top_k": OP5,
    "op7_near_dedup": OP7,
    "op8_substrings": OP8,
    "op11_merkle_manifest": OP11,
    "op12_hard_negatives": OP12,
}
