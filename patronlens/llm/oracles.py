"""DuckDB SQL for the operators that SQL can express."""

# Water-filling in closed form: sources in the order in which they clamp, the level with those ahead
# clamped; it rises up to the level that is feasible and falls after it.
OP3 = r"""
WITH rows AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS draw
  FROM documents
), sizes AS (
  SELECT k, sum(size)::BIGINT AS source_size FROM rows GROUP BY k
), ranked AS (
  SELECT k, source_size, source_size * 2.0::DOUBLE AS cap,
    CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM sizes
), ordered AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER before, 0)::DOUBLE AS held,
    (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS free
  FROM ranked
  WINDOW before AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max((budget - held) / free) AS level FROM ordered
), plan AS (
  SELECT k, source_size, least(cap, weight * level) AS target,
    CASE WHEN source_size > 0 THEN floor(least(cap, weight * level) / source_size) ELSE 0 END::BIGINT AS whole
  FROM ranked, level
), drawn AS (
  SELECT r.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
    coalesce(sum(r.size) OVER (PARTITION BY r.k ORDER BY r.draw, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN plan p USING (k)
), marked AS (
  SELECT *, max(draw) FILTER (before + size / 2.0 <= rest) OVER (PARTITION BY k) AS last FROM drawn
)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN draw <= last THEN 1 ELSE 0 END))::BIGINT AS taken FROM marked
"""

OP6 = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, payload, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS hex,
    max(page_id) OVER (PARTITION BY payload) AS keeper
  FROM rows
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM hashed
"""

# CRC-32 of a number written in decimal, bit by bit.
CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

# A node is the list of its turns' digests; subtree sums go from every node to the beginnings of the
# way of its smallest member.
OP11 = r"""
WITH turns AS (
  SELECT conv_id, length(coalesce(text, ''))::BIGINT AS chars,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS r
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS side, t.r, t.digest, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.r < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.r, t.digest, t.chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.r >= c.h
), placed AS (
  SELECT *, row_number() OVER w AS depth, list(digest) OVER w AS key, count(*) OVER (PARTITION BY conv_id) AS len
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY side, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), way AS (
  SELECT conv_id, depth, md5(array_to_string(key, ',')) AS key, chars, len FROM placed
  UNION ALL
  SELECT conv_id, 0, '', 0, (SELECT count(*) FROM rebuilt b WHERE b.conv_id = c.conv_id) FROM convs c
), nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = depth), '') AS ends
  FROM way GROUP BY depth, key
), parents AS (
  SELECT n.depth, n.key, n.conv_id, n.n_convs, n.chars, p.key AS parent_key
  FROM nodes n LEFT JOIN way p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), families AS (
  SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f USING (depth, key)
), subtrees AS (
  SELECT a.depth, a.key, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.chars) AS saved_tokens
  FROM own o JOIN way a ON a.conv_id = o.conv_id AND a.depth <= o.depth GROUP BY a.depth, a.key
)
SELECT o.conv_id, o.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, o.n_convs::BIGINT AS n_convs, o.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN parents p USING (depth, key) JOIN subtrees s USING (depth, key)
LEFT JOIN nodes u ON u.depth = o.depth - 1 AND u.key = p.parent_key
""".replace("{crc}", CRC.format("conv_id"))

# Masks as bits 1 (A) to 16 (E); every order and step against every mask of the part.
OP13 = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), masked AS (
  SELECT words.doc_id, part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM words
), counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masked LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, b)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b | b.b | c.b | d.b | e.b = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS ahead
  FROM orders, range(1, 6) s(step)
), found AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (ahead | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & (ahead | bit) = bit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit = bit AND mask & ahead > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & (ahead | bit) = bit THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & (ahead | bit) = bit THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""

ORACLES = {"op3_mix": OP3, "op6_warc": OP6, "op11_prefix_trie": OP11, "op13_filter_audit": OP13}
