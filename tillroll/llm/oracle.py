"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Base32 of a SHA-1: 40 hex digits are 4 runs of 10, each of which is 8 characters of 5 bits.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(sha, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)), '')"""

OP5 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS sha FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS kept FROM d)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to,
  CASE WHEN page_id = kept THEN upper(sha) END AS read_sha1
FROM g"""

_WORDS = f"regexp_extract_all({_ASCII_LOWER.format('coalesce(text, \'\')')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, size, list_slice(w, s, s + size - 1) AS win
       FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, s, size, list_slice(w, s, s + size - 1) AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT doc_id, item_id, s, dw.size FROM dw JOIN iw USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM m) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""

OP8 = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, length(text) + length(role) + 15 + (length(text) - length(replace(text, '\', '')))
        + (length(text) - length(replace(text, '<turn', ''))) // 5 + (length(text) - length(replace(text, '</turn', ''))) // 6 AS width FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(width)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(list_slice(w, k, k + 4), ' ')) END) AS x FROM d),
c AS (SELECT x, min(doc_id) AS node, len(x) AS n FROM (SELECT doc_id, list_sort(x) AS x FROM s WHERE len(x) > 0) GROUP BY x),
e AS (SELECT node, n, unnest(x) AS g FROM c),
p AS (SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.node < b.node GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * k >= 85 * (na + nb - k)),
two AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reach) AS (SELECT node, node FROM c UNION SELECT r.node, two.b FROM r JOIN two ON r.reach = two.a),
root AS (SELECT node, min(reach) AS root FROM r GROUP BY node),
o AS (SELECT s.doc_id, len(s.x)::BIGINT AS n_shingles, coalesce(root.root, s.doc_id) AS component_id
      FROM s LEFT JOIN c ON list_sort(s.x) = c.x LEFT JOIN root ON root.node = c.node)
SELECT *, doc_id = component_id AS kept FROM o"""


# Damage by CRC-32, then a table of cheapest edits that grows by one turn a step (of each conversation
# and grammar state the cheapest, ASCII-least one), with the repaired turns beside the edits.
OP11 = r"""
WITH RECURSIVE crc AS (SELECT list(t ORDER BY b) AS tab FROM (SELECT b, list_reduce(list_concat([b::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(b))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
m AS (SELECT k.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM m WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS before FROM d),
t AS MATERIALIZED (SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd'
        WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN '-' ELSE 't' END AS f FROM n),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
        count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
        count(*) FILTER (n > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS turns FROM t GROUP BY conv_id),
ins(g, to_g, cost, a, o) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
        (1, 1, 0, '', []::VARCHAR[]), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []::VARCHAR[]),
        (2, 3, 3, 'I', ['assistant:']), (3, 3, 0, '', []::VARCHAR[]), (3, 2, 3, 'I', ['user:'])),
keep(g, r, to_g) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
put(g, role, to_g) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
p(conv_id, n, g, best) AS (
  SELECT conv_id, 0::BIGINT, 0, struct_pack(cost := 0, audit := '', texts := []::VARCHAR[]) FROM stats
  UNION ALL
  SELECT conv_id, n, g, min(best) FROM (
    SELECT p.conv_id, t.n, e.to_g AS g, struct_pack(cost := p.best.cost + i.cost + e.cost, audit := p.best.audit || i.a || e.a,
           texts := list_concat(list_concat(p.best.texts, i.o), CASE WHEN e.a = 'D' THEN []::VARCHAR[] ELSE [e.role || ':' || t.text] END)) AS best
    FROM p JOIN ins i ON i.g = p.g JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.n = p.n + 1
    JOIN LATERAL (SELECT 'D' AS a, 4 AS cost, i.to_g AS to_g, '' AS role
      UNION ALL SELECT 'K', CASE WHEN t.f = 't' THEN 3 ELSE 0 END, keep.to_g, t.role FROM keep WHERE keep.g = i.to_g AND keep.r = t.r AND t.f IN ('-', 't')
      UNION ALL SELECT 'R', CASE WHEN t.f = 't' THEN 6 ELSE 3 END, put.to_g, put.role FROM put WHERE put.g = i.to_g AND t.f IN ('-', 't')) e ON true)
  GROUP BY conv_id, n, g),
z AS (SELECT p.conv_id, min(struct_pack(cost := best.cost + i.cost, audit := best.audit || i.a, texts := list_concat(best.texts, i.o))) AS best
      FROM p JOIN stats s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.turns = p.n JOIN ins i ON i.g = p.g WHERE i.to_g IN (0, 3) GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.best.cost, 0)::BIGINT AS cost,
  coalesce(z.best.audit, '') AS audit, sha256(coalesce(array_to_string(z.best.texts, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""

_OP12_START = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
e AS MATERIALIZED (SELECT r, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
s AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c, x FROM v
      QUALIFY row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) <= 40),
m0 AS MATERIALIZED (SELECT c, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM s)"""

_OP12_ASSIGN = """,
a{k} AS MATERIALIZED (
  SELECT r, arg_min(c, struct_pack(d := d, c := c)) AS c, min(d) AS d FROM (
    SELECT e.r, m.c, sum((e.x - m.x) * (e.x - m.x)) AS d FROM e JOIN m{k} m USING (i) GROUP BY e.r, m.c) GROUP BY r)"""

_OP12_MOVE = """,
n{k} AS (SELECT c, i, sum(x) AS total, count(*) AS n FROM a{k} JOIN e USING (r) GROUP BY c, i),
m{next} AS MATERIALIZED (
  SELECT c, i, coalesce((total - ((total % n) + n) % n) // n, x)::BIGINT AS x FROM m{k} LEFT JOIN n{k} USING (c, i))"""

_OP12_END = """
SELECT v.vec_id, a5.c::INTEGER AS cluster, a5.d::BIGINT AS distance, (sum(a5.d) OVER (PARTITION BY a5.c))::BIGINT AS cluster_inertia,
  (sum(a5.d) OVER ())::BIGINT AS inertia, h.sha AS centroid_sha256
FROM a5 JOIN v USING (r) JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS sha FROM m5 GROUP BY c) h ON h.c = a5.c"""

OP12 = _OP12_START + "".join(_OP12_ASSIGN.format(k=k) + _OP12_MOVE.format(k=k, next=k + 1) for k in range(5)) + _OP12_ASSIGN.format(k=5) + _OP12_END


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5, "op6_decontaminate": OP6, "op8_chat": OP8, "op9_near_dedup": OP9, "op11_repair": OP11, "op12_clusters": OP12}
