"""DuckDB SQL of the operators that SQL can express, over the ``documents`` view."""

REPEATS = """
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), part AS (
  SELECT doc_id, n, b, h[2 * b + 1 : 2 * b + 2 * (256 + 49)] AS h FROM (SELECT *, unnest(range(0, n - 49, 256)) AS b FROM raw)
), win AS (
  SELECT doc_id, b + p AS p, h[2 * p + 1 : 2 * p + 100] AS w
  FROM (SELECT doc_id, b, h, unnest(range(0, least(256, n - 49 - b))) AS p FROM part)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY w) AS least FROM win) WHERE least < doc_id
), numbered AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM (
    SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS fresh FROM later
  )
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM numbered GROUP BY doc_id, k
), piece AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM span
), cut AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS done,
    string_agg(h[2 * since + 1 : 2 * a], '' ORDER BY a) AS kept
  FROM piece JOIN raw USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || h[2 * coalesce(done, 0) + 1 :])) AS kept_sha256
FROM raw LEFT JOIN cut USING (doc_id)
"""

VERIFY = """
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
  )) AS crc FROM documents
), field AS (
  SELECT doc_id, source, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS found
  FROM documents JOIN crc USING (doc_id)
), leaf AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS h,
    sha256(head || coalesce(octet_length(encode(found)) || ':' || found, '-')) AS f
  FROM field
), node AS (
  SELECT source, 0 AS lvl, i, h, count(*) OVER (PARTITION BY source) AS n FROM leaf
  UNION ALL
  SELECT source, lvl + 1, i, h, count(*) OVER (PARTITION BY source) FROM (
    SELECT source, lvl, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM node WHERE n > 1 GROUP BY source, lvl, i // 3
  )
), subroot AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM node WHERE n = 1
), above AS (
  SELECT 0 AS lvl, i, h, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT lvl + 1, i, h, count(*) OVER () FROM (
    SELECT lvl, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM above WHERE n > 1 GROUP BY lvl, i // 3
  )
), beside AS (
  SELECT a.source, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM node a JOIN node b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY a.source, a.lvl, a.i
), beside_top AS (
  SELECT a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM above a JOIN above b ON a.lvl = b.lvl AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.lvl, a.i
), fold AS (
  SELECT doc_id, source, 0 AS lvl, i, f, '' AS path FROM leaf
  UNION ALL
  SELECT doc_id, f.source, f.lvl + 1, f.i // 3, sha256(l || f || r), path || l || r
  FROM fold f JOIN beside b ON f.source IS NOT DISTINCT FROM b.source AND f.lvl = b.lvl AND f.i = b.i
), folded AS (
  SELECT doc_id, source, max(lvl) AS lvl, arg_max(f, lvl) AS f, arg_max(path, lvl) AS path FROM fold GROUP BY doc_id, source
), fold_top AS (
  SELECT doc_id, s.h AS subroot, 0 AS lvl, s.i, f, path FROM folded d JOIN subroot s ON d.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT doc_id, subroot, f.lvl + 1, f.i // 3, sha256(l || f || r), path || l || r
  FROM fold_top f JOIN beside_top b ON f.lvl = b.lvl AND f.i = b.i
), done AS (
  SELECT doc_id, any_value(subroot) AS subroot, arg_max(f, lvl) AS folded_root, arg_max(path, lvl) AS path FROM fold_top GROUP BY doc_id
)
SELECT doc_id, leaf.h AS leaf, subroot, above.h AS root, sha256(path) AS proof_sha256, folded_root,
  folded_root = above.h AS verified
FROM done JOIN leaf USING (doc_id), above WHERE above.n = 1
"""

COLLOCATIONS = """
WITH word AS (
  SELECT coalesce(lang, 'und') AS lang, doc, p, regexp_extract_all(piece, '[^ \\t]+') AS w FROM (
    SELECT lang, doc, generate_subscripts(pieces, 1) AS p, unnest(pieces) AS piece FROM (
      SELECT lang, row_number() OVER () AS doc, string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents
    )
  )
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang
), gram AS (
  SELECT lang, w, k, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS w
    FROM word, range(1, 6) AS t(k) WHERE len(w) >= k
  ) GROUP BY lang, w, k HAVING count(*) >= {least}
), split AS (
  SELECT lang, w, f, string_split(w, ' ') AS ws, unnest(range(1, k)) AS k FROM gram WHERE k > 1
), parts AS (
  SELECT lang, w, f AS a, k, array_to_string(ws[:k], ' ') AS wl, array_to_string(ws[k + 1 :], ' ') AS wr FROM split
), cut AS (
  SELECT p.lang, p.w AS phrase, a, p.k, x.f AS l, y.f AS r, n,
    CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM parts p JOIN gram x ON x.lang = p.lang AND x.w = wl JOIN gram y ON y.lang = p.lang AND y.w = wr
  JOIN total t ON t.lang = p.lang
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_part AS (
  SELECT lang, f, unnest([array_to_string(string_split(w, ' ')[2:], ' '), array_to_string(string_split(w, ' ')[:-2], ' ')]) AS w
  FROM gram WHERE k > 2
), inside AS (
  SELECT DISTINCT g.lang, g.w FROM inner_part x JOIN gram g ON x.lang = g.lang AND x.w = g.w WHERE x.f >= g.f
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best b ANTI JOIN inside i ON b.lang = i.lang AND b.phrase = i.w QUALIFY rank <= {top}
"""
