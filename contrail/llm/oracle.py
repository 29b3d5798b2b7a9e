"""DuckDB SQL for the operators whose rows SQL can state.

The others are tested against brute force (tests/llm): the hashes of op3 and op8
and the models of op4, op5 and op6 have no SQL form, and op1 decodes bytes.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r
  FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[0-9a-z\x{80}-\x{10FFFF}]+')")

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(10, len(w)) AS size,
               unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s
        FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s
  FROM d, sizes WHERE len(w) >= size
), met AS (
  SELECT r, s, p.size, item_id FROM places p JOIN windows x
    ON x.size = p.size AND x.phrase = array_to_string(w[s:s + p.size - 1], ' ')
), hits AS (
  SELECT r, count(DISTINCT pos) AS n_hit
  FROM (SELECT r, unnest(generate_series(s, s + size - 1)) AS pos FROM met) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM met GROUP BY r
), bw AS (  -- proximity: the two rarest terms of each window that texts hold
  SELECT item, item_id, size, place - 1 AS place, w[place] AS word
  FROM (SELECT row_number() OVER () AS item, item_id, w, len(w) AS size,
               unnest(generate_series(1, len(w))) AS place FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, pos, w[pos] AS word
  FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS pos FROM d WHERE len(w) > 0)
  WHERE w[pos] IN (SELECT word FROM bw)
), tf AS (SELECT word, count(*) AS n FROM dw GROUP BY word),
ranked AS (
  SELECT item, item_id, least(size, 10) AS n_window, s, place, word,
         row_number() OVER (PARTITION BY item, s ORDER BY n, place) AS k
  FROM (SELECT *, unnest(generate_series(greatest(0, place - least(size, 10) + 1),
                                         least(place, size - least(size, 10)))) AS s
        FROM bw JOIN tf USING (word))
), pairs AS (
  SELECT DISTINCT x.item_id, x.n_window, x.word AS word1, x.place AS place1, y.word AS word2,
         y.place AS place2
  FROM ranked x LEFT JOIN ranked y ON x.item = y.item AND x.s = y.s AND y.k = 2
  WHERE x.k = 1
), near AS (
  SELECT r, item_id FROM pairs JOIN dw ON dw.word = word1 WHERE n_window = 1
  UNION
  SELECT d1.r, item_id FROM pairs JOIN dw d1 ON d1.word = word1
  JOIN dw d2 ON d2.word = word2 AND d2.r = d1.r
  WHERE d2.pos <> d1.pos AND abs(d2.pos - d1.pos - (place2 - place1)) <= 5
), nears AS (SELECT r, count(DISTINCT item_id::VARCHAR) AS n_near FROM near GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r) LEFT JOIN nears USING (r)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (1 + 5 * (i // 4))::INTEGER, 5))::INTEGER
           >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (payload)
"""

LINE_DEDUP = f"""
WITH l AS (
  SELECT r, doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   '{UPPER}', '{LOWER}') AS k
  FROM (SELECT r, doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id,
                     string_split(coalesce(text, ''), chr(10)) AS x FROM documents))
), often AS (
  SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT l.*, o.k IS NOT NULL AS gone FROM l LEFT JOIN often o ON l.k = o.k
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r
"""

ORACLES = {"op2_exact_topk": TOPK, "op7_decontamination": DECONTAMINATION,
           "op9_warc_round_trip": WARC, "op10_line_dedup": LINE_DEDUP}
